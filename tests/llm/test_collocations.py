"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter

import brute
import pytest

from stationlake.llm import collocations as C
from stationlake.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_util import compare, duck


def plain_counts(rows, longest=3):
    """rows: (text, lang) -> {(lang, words): count}, {lang: words}."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.A_Z)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    return f, n


def plain(rows, longest=3, least=10, pct=50, top=2000):
    f, n = plain_counts(rows, longest)
    often = {k: c for k, c in f.items() if c >= least and len(k[1]) > 1}
    by_lang: dict = {}
    for (lang, w), a in often.items():
        if any(100 * b >= pct * a for (other, v), b in often.items()
               if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))):
            continue
        cut = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        by_lang.setdefault(lang, []).append((-cut[0], -a, " ".join(w).encode(), f[lang, w[: cut[1]]], f[lang, w[cut[1] :]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, rows in by_lang.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top]))


def texts(seed, n):
    r = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "city", "é", "日本", "a", "b", "co-op", "x"]
    return [(" ".join(r.choice(vocabulary) + r.choice(["", "", "", ",", ".", "\t", "\x0b", " ", "!?"]) for _ in range(r.randint(0, 60))),
             r.choice(["en", "de", None, "und", ""])) for _ in range(n)]


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("longest, least, pct, top", [(3, 10, 50, 2000), (4, 3, 80, 7), (2, 2, 50, 5)])
def test_matches_plain_version(spark, longest, least, pct, top):
    rows = texts(longest, 200) + [(None, "en"), ("", None), ("x " * 40, "xx"), ("\n\n", "en")]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "text string, lang string, n int, phrase string").repartition(5)
    assert got(C.collocations(C.written(docs, "t"), longest=longest, least=least, inside_pct=pct, top=top)) == plain(rows, longest, least, pct, top)


@pytest.mark.parametrize("bits", [3, 9, 64])
def test_collided_fingerprints_are_counted_from_the_text(spark, bits, monkeypatch):
    monkeypatch.setattr(C, "CHUNK_BYTES", 400)
    rows = texts(50, 120)
    f, n = plain_counts(rows)
    want = sorted([(g, len(w), " ".join(w), c) for (g, w), c in f.items() if c >= 4] + [(g, 0, "", c) for g, c in n.items() if c])
    docs = C.written(spark.createDataFrame(rows, "text string, lang string").repartition(4), "t")
    assert got(C.phrase_counts(docs, least=4, bits=bits)) == want


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000
    one = spark.sql(f"SELECT cast({big} as decimal(15,0)) a, cast({big} as decimal(15,0)) l").selectExpr("(cast(1000000 as decimal(7,0)) * a * a) div (l * l) s")
    assert one.first().s == 1_000_000


def test_empty_table_and_many_copies(spark):
    empty = C.written(spark.createDataFrame([], "text string, lang string"), "t")
    assert got(C.collocations(empty)) == []
    rows = [("to be or not to be. " * 30, "en")] * 50 + [("y " * 30000, "en")]
    docs = C.written(spark.createDataFrame(rows, "text string, lang string").repartition(6), "t")
    assert got(C.collocations(docs)) == plain(rows)


def test_a_changed_input_is_noticed(spark):
    speller = C._speller(3, 64)
    import pyarrow as pa
    from stationlake.llm.packing_io import batch_to_blob
    blob = batch_to_blob(pa.record_batch([pa.array(["a b"]), pa.array(["en"])], names=["text", "lang"]))
    docs = pa.table({"chunk": [1], "mark": [5], "docs": [blob]})
    owned = pa.table({"chunk": [1], "mark": [6], "prints": [b""], "counts": [b""]})
    with pytest.raises(RuntimeError):
        speller((pa.scalar(1),), docs, owned)


def test_registered_query(spark):
    compare(QUERIES["op12_collocations"](spark, SF_SMALL), duck(SF_SMALL), ORACLES["op12_collocations"])
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang").collect()]
    assert got(QUERIES["op12_collocations"](spark, SF_SMALL)) == plain(rows)

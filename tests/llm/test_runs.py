"""Periodic runs against a plain search over all periods."""

import hashlib
import random
from fractions import Fraction

import brute
import numpy as np
import pytest

from stationlake.llm import periodic_runs as P
from tests.conftest import SF_SMALL


def plain_runs(words, least=24, repeats=3):
    """Every maximal stretch of every period, then the smallest period of each stretch."""
    best = {}
    for q in range(1, len(words) // repeats + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            a = i - q
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - a >= max(least, repeats * q):
                best.setdefault((a, i), q)
    return sorted((a, b - a, q) for (a, b), q in best.items())


def plain_row(doc_id, text):
    words = [w.encode() for w in brute.SPACE_WORD.findall(text or "")]
    if doc_id is not None:
        words = P.plant_tail(words, doc_id)
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def _hashes(words):
    return np.array([hash(("w", w)) & (1 << 63) - 1 for w in words], dtype=np.uint64)


@pytest.mark.parametrize("seed", range(60))
def test_random_words_against_all_periods(seed):
    r = random.Random(seed)
    words = []
    while len(words) < 260:
        unit = [r.choice("abc"[: r.randint(1, 3)]) for _ in range(r.randint(1, 30))]
        words += (unit * r.randint(1, 6))[: r.randint(1, 120)]
        words += [r.choice("abcdefgh") for _ in range(r.randint(0, 6))]
    least, repeats = r.choice([(24, 3), (8, 3), (12, 4)])
    assert P.runs_of(_hashes(words), least, repeats) == plain_runs(words, least, repeats)


def test_nested_and_touching_runs():
    for words in (list("ab" * 40), list("a" * 60), (list("aaab") * 12 + list("aaaa") * 7) * 3, list("abcabd" * 9) + list("d" * 30)):
        assert P.runs_of(_hashes(words)) == plain_runs(words)


def test_one_word_long_text_stays_sparse():
    h = np.ones(200_000, dtype=np.uint64)
    assert P.runs_of(h) == [(0, 200_000, 1)]
    assert len(P._earlier(h, 3)[0]) < 200_000


def test_least_match_is_shared_by_every_run():
    assert P.least_match(24, 3) == 16


def test_rows_with_odd_input(spark, odd_docs, odd_rows, no_docs):
    extra = [(100, "a b " * 30), (101, "x " * 23), (102, "x " * 24), (103, "\n".join(["q w e r t y u i o p"] * 3)), (104, "x\x0by " * 12)]
    docs = odd_docs.select("doc_id", "text", "rk", "chunk").union(spark.createDataFrame([(*r, 1, "c") for r in extra], "i long, t string, a int, b string"))
    want = sorted((plain_row(*r) for r in odd_rows + extra if len(r[1] or "") < 50_000), key=repr)  # the plain search is quadratic
    got = sorted(map(tuple, P.digest(docs).collect()), key=repr)
    assert len(got) == len(want) + 2 and [r for r in got if r in set(want)] == want
    assert P.digest(no_docs).collect() == []


def test_library_form_gives_spans_and_text(spark):
    docs = spark.createDataFrame([(1, "start " + "do re mi " * 9 + "end"), (2, None)], "id long, text string")
    got = {r.id: r for r in P.find_runs(docs, "id").collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 27, 3)]
    assert got[1].collapsed == "start do re mi end" and got[1].n_words == 29
    assert (got[2].n_words, got[2].runs, got[2].collapsed) == (0, [], "")
    with pytest.raises(ValueError):
        P.find_runs(docs, "id", min_repeats=2)


def test_registered_query(spark):
    from stationlake.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(plain_row(d, t) for d, t in docs if len(t or "") < 6000)
    short = {r[0] for r in want}
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF_SMALL).collect()]
    assert len(got) == len(docs) and sorted(r for r in got if r[0] in short) == want

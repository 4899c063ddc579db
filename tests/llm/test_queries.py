"""The registered queries over the smallest tables: the SQL, and plain versions where SQL cannot state the result."""

import brute
import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as E
from stationlake.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_util import compare, duck


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()


def rows(spark, name):
    return sorted(map(tuple, QUERIES[name](spark, SF_SMALL).collect()))


def test_all_are_registered():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, len(QUERIES) + 1))
    assert {*QUERIES, "pipeline"} <= set(E.queries())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, key):
    compare(QUERIES[key](spark, SF_SMALL), duck(SF_SMALL), ORACLES[key])


def test_near_duplicates(spark):
    assert rows(spark, "op2_near_dup") == sorted(brute.near_dup(documents(), 3, 85, 100))


def test_contamination(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    want = [(i, n, h, len(x), brute.sha(",".join(x)), h > 0 and 20 * h >= n) for i, n, h, x in brute.contamination(documents(), items, 13)]
    assert rows(spark, "op6_decontaminate") == sorted(want)


def test_pipeline_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dup", "substring_dedup", "decontaminate", "packing"]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = corpus_pipeline.written(stage(spark, docs, SF_SMALL), name)
        if name == "packing":
            assert {r.doc_id for r in docs.collect()} == {i for i, _ in before}
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "quality_rules":
            assert all(len(brute.SPACE_WORD.findall(t)) >= 50 for t in after.values())
        elif name == "near_dup":
            assert set(after) == {r[0] for r in brute.near_dup(before, 5, 8, 10) if r[3]}
        elif name == "substring_dedup":
            assert {i: t.split() for i, t in after.items()} == {r[0]: r[3].split() for r in brute.exact_repeats(before, 35)}
        elif name == "decontaminate":
            assert set(after) == {i for i, n, h, _ in brute.contamination(before, items, 13) if not (h > 0 and 20 * h >= n)}


def test_quality_query_against_plain_statistics(spark):
    from test_quality import plain
    got = {r.doc_id: r for r in QUERIES["op1_quality_rules"](spark, SF_SMALL).collect()}
    assert len(got) == len(documents())
    for i, t in documents():
        n, chars, symbols, lines, repeated = plain(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n) and not (r.base_failed and r.kept)
    assert sum(r.kept for r in got.values()) > len(got) / 3


def test_language_query(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF_SMALL}/documents.parquet'").fetchall())
    got = QUERIES["op3_language_id"](spark, SF_SMALL).collect()
    held = [r for r in got if r.held_out and lang[r.doc_id] and r.lang_pred != "und"]
    assert len(got) == len(lang) and len(held) > 30
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_token_queries_against_the_library(spark):
    import zlib

    import numpy as np
    from test_tokens import BYTE, WORD, library
    byte, word = library(BYTE), library(WORD)
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    docs = sorted(documents())
    ids = {i: byte(t or "") for i, t in docs}
    assert rows(spark, "op8_token_counts") == [(i, len((t or "").encode()), len(ids[i]), len(ids[i]) > 512) for i, t in docs]
    start, want = 0, []
    for i, _ in docs:
        own = [*ids[i], 2]
        want.append((i, start, len(own), crc(own)))
        start += len(own)
    assert rows(spark, "op7_token_files") == want
    pieces: dict = {}
    sequences: dict = {}
    for r in QUERIES["op5_packing"](spark, SF_SMALL).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces.keys() == {i for i, _ in docs}
    total = 0
    for i, t in docs:
        own, at = [*word(t or ""), 1], 0
        total += len(own)
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(own), crc(own[at : at + r.length]))
            at += r.length
        assert at == len(own)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) * 1.02 + 2  # a plain lower bound on the number of sequences


def test_html_query_against_a_plain_version(spark):
    from test_pages import plain_extract
    pages = duckdb.sql(f"SELECT page_id, url, html FROM '{SF_SMALL}/pages.parquet'").fetchall()
    got = sorted((r.page_id, r.text, r.n_chars) for r in QUERIES["op9_html_text"](spark, SF_SMALL).collect())
    assert got == sorted((i, t, len(t)) for i, t in plain_extract(pages))


ODD = [(1, None), (2, ""), (3, "too short"), (None, "clean words " + " ".join(f"w{i}" for i in range(80))), (4, " ".join(f"v{i}" for i in range(90))),
       (5, " ".join(f"v{i}" for i in range(90))), (5, " ".join(f"v{i}" for i in range(90))), (6, "\n".join(f"line {i} of a long text {i * 7}" for i in range(3000)))]


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_nulls_clashing_columns_and_empty_tables(spark, stage):
    extra = "`decontaminate key` string, row int, rk int, `repeat kept` string, `near dup row key` string, class int, salt int"
    schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
    values = ("en", None, 5, "k", 1, 2, "r", "n", 3, 4)
    f = dict(corpus_pipeline.STAGES)[stage]
    full = corpus_pipeline.written(spark.createDataFrame([(*r, *values) for r in ODD], schema).repartition(3), "odd")
    out = f(spark, full, SF_SMALL).collect()
    none = f(spark, corpus_pipeline.written(spark.createDataFrame([], schema), "none"), SF_SMALL)
    assert none.collect() == []
    if stage == "packing":
        assert sorted((str(r.doc_id), r.doc_tokens) for r in out if r.start == 0)[:1] and len({r.doc_id for r in out}) == 7
        return
    assert none.columns == full.columns and all(list(r.asDict()) == full.columns and tuple(r)[2:] [:1] == ("en",) for r in out)
    texts = sorted((str(r.doc_id), r.text or "") for r in out)
    from test_quality import plain
    sound = [n >= 50 and 100 * repeated <= 50 * n for n, _, _, _, repeated in (plain(t) for _, t in ODD)]
    want = {"quality_rules": [r for r, ok in zip(ODD, sound) if ok],
            "near_dup": [r for i, r in enumerate(ODD) if i not in (5, 6)],
            "decontaminate": ODD}.get(stage)
    if want is not None:
        assert texts == sorted((str(i), t or "") for i, t in want)
    else:  # the three equal texts lose all their words
        assert [t for i, t in texts if i in "45"] == ["", "", ""] and len(out) == len(ODD)
        assert all(r.n_chars == (0 if r.doc_id in (4, 5) else 5) for r in out)

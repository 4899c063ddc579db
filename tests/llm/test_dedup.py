"""Near-duplicates, repeated passages and benchmark text against plain versions."""

import brute
import numpy as np
import pytest

from stationlake.llm import decontaminate, near_dup, substring_dedup
from stationlake.llm.packing_io import unsqueeze


def key(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("width,num,den", [(3, 85, 100), (5, 8, 10)])
def test_near_duplicates(odd_docs, odd_rows, width, num, den):
    got = near_dup.near_duplicates(odd_docs, width=width, num=num, den=den).drop("rk").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute.near_dup(odd_rows, width, num, den), key=key)


def test_chains_of_copies_and_a_hub(spark):
    """A chain links ends that are not similar; a hub links copies that are not similar to each other."""
    words = [f"t{i}" for i in range(120)]
    rows, now = [], list(words)
    for i in range(12):
        now[9 * i] = f"new{i}"
        rows.append((100 + i, " ".join(now)))
    hub = [f"h{i}" for i in range(150)]
    rows.append((50, " ".join(hub)))
    rows += [(200 + i, " ".join("edit%d" % i if j in (7 * i % 150, (11 * i + 40) % 150, (23 * i + 90) % 150) else w for j, w in enumerate(hub)))
             for i in range(40)]
    rows += [(300 + i, " ".join(hub[:75] + [f"own{i}x{j}" for j in range(75)])) for i in range(30)]  # half shared, not similar
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, num=85, den=100).drop("rk")
    assert sorted(map(tuple, got.collect())) == sorted(brute.near_dup(rows, 3, 85, 100))


def test_one_of_each_group_stays(odd_docs, odd_rows):
    kept = near_dup.drop_near_duplicates(odd_docs, width=5, num=8, den=10)
    assert kept.columns == odd_docs.columns
    want = {(i, t) for (i, t), r in zip(odd_rows, brute.near_dup(odd_rows, 5, 8, 10)) if r[0] == r[2]}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(want, key=key)


def test_one_of_each_group_stays_without_ids_or_with_equal_ids(spark):
    base = [f"t{i}" for i in range(100)]

    def near(i, of=base):
        return " ".join([*of[:i], "changed", *of[i + 1:]])

    other, third = [f"u{i}" for i in range(100)], [f"v{i}" for i in range(100)]
    rows = [(None, near(i)) for i in (3, 50, 97, 97)] + [(7, near(i, other)) for i in (3, 50, 97)] + [(8, near(60, other))]
    rows += [(None, near(5, third)), (9, near(50, third)), (None, None), (None, ""), (20, " "), (20, " ")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, component string").repartition(3)
    got = [tuple(r) for r in near_dup.drop_near_duplicates(docs, width=5, num=8, den=10).collect()]
    assert set(got) <= {(*r, "z") for r in rows}
    assert sorted(str((i, (t or "")[:1])) for i, t, _ in got) == sorted(map(str, [(None, "t"), (7, "u"), (9, "v"), (None, ""), (None, ""), (20, " ")]))


def test_least_overlap_is_a_safe_bound():
    assert near_dup.least_overlap(10, 64, 85, 100) == 9
    assert 28 <= near_dup.least_overlap(10**6, 64, 85, 100) <= 36


@pytest.mark.parametrize("width", [4, 35])
def test_repeats(odd_docs, odd_rows, width):
    out = substring_dedup.remove_repeats(odd_docs, width=width)
    assert out.columns[: len(odd_docs.columns)] == odd_docs.columns
    got = [(r.doc_id, r["repeat n_words"], r["repeat n_removed"], r["repeat kept"]) for r in out.collect()]
    assert sorted(got, key=key) == sorted(brute.exact_repeats(odd_rows, width), key=key)


def test_repeat_text_keeps_white_space(spark):
    rows = [(1, "  keep\tthis  a b c d  end \n"), (2, "a b c d"), (3, "untouched \n text ")]
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), width=4)
    assert {r.doc_id: r.text for r in out.collect()} == {1: "keep\tthis  end", 2: "", 3: "untouched \n text "}


def test_contamination(spark, odd_docs, odd_rows):
    long = odd_rows[12][1].split()
    items = [(1, " ".join(long[200:230])), (2, "one two"), (3, None), (4, "..."), (5, odd_rows[0][1]), (None, "One-Two"),
             (6, " ".join(long[205:225])), (6, "ünïcode WÖRDS"), (7, "日本語")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontaminate.contamination(odd_docs, bench).collect()]
    assert sorted(got, key=key) == sorted(brute.contamination(odd_rows, items, 13), key=key)
    flags = {r.doc_id: r.contaminated for r in decontaminate.contamination(odd_docs.where("doc_id in (0, 7, 9, 12)"), bench).collect()}
    assert flags == {0: True, 7: False, 9: True, 12: False}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta y gamma"), (2, "alpha x x x x beta gamma"), (3, "gamma beta alpha")], "doc_id long, text string")
    from stationlake.llm import textvec as tv
    import pyarrow as pa
    terms = [h.item() for h in tv.words(pa.array(["beta alpha gamma"]), tv.symbol_separators()).hash.view(np.int64)]
    index = decontaminate.build_index(docs.coalesce(1).sortWithinPartitions("doc_id"))
    got = decontaminate.find(index, spark.createDataFrame([(9, terms)], "query long, terms array<long>"), span=3).collect()
    places = [p for r in got for p in np.frombuffer(unsqueeze(r.places), np.int64).tolist()]
    assert places == [3, 14]  # the word beta of documents 1 and 3, with both others within three words


def test_empty_tables(spark, no_docs, odd_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert near_dup.near_duplicates(no_docs).count() == 0
    assert near_dup.drop_near_duplicates(no_docs).count() == 0
    assert substring_dedup.remove_repeats(no_docs).count() == 0
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert decontaminate.contamination(odd_docs, bench).where("contaminated or n_hit > 0").count() == 0


def test_many_copies_around_the_threshold(spark):
    """Groups whose members differ by a little more or less than the threshold, several groups over one common half."""
    import random
    r = random.Random(11)
    half = [f"c{i}" for i in range(70)]
    rows, n = [], 0
    for g in range(4):
        base = half + [f"g{g}w{i}" for i in range(50 if g % 2 else 20)]
        for edits in (0, 1, 2, 2, 3, 3, 3, 4, 4, 5, 6) * 3:
            words = list(base)
            for i in r.sample(range(len(words)), edits):
                words[i] = r.choice([f"e{n}", "same", f"e{g}"])
            rows.append((n, " ".join(words)))
            n += 1
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), width=3, num=85, den=100).drop("rk")
    want = sorted(brute.near_dup(rows, 3, 85, 100))
    assert 10 < len({w[2] for w in want}) < len(rows)
    assert sorted(map(tuple, got.collect())) == want


def test_clashing_names_pass(spark):
    rows = [(1, "a b c d e f g h", "x", 1.0), (2, "a b c d e f g h", "y", 2.0), (3, None, "z", 3.0), (2, "a b c d e f g h", "y", 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `near dup row key` string, row double")
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `repeat kept` string, `repeat n_words` double")
    out = substring_dedup.remove_repeats(docs, width=4)
    assert out.columns == ["doc_id", "text", "repeat n_words", "repeat n_removed", "repeat kept"]
    assert sorted((r.doc_id, r["repeat n_removed"]) for r in out.collect()) == [(1, 8), (2, 8), (2, 8), (3, 0)]

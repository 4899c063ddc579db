"""Quality statistics against a plain version, and what the rules learn."""

import random
import re
from collections import Counter

import brute
from conftest import prose
from pyspark.sql import functions as F

from stationlake.llm import quality_rules as q


def plain(text):
    t = text or ""
    w = brute.SPACE_WORD.findall(t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if brute.SPACE_WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_statistics(spark, odd_docs, odd_rows):
    extra = [(90, "a b c a b c a b\na b c\n\n \na b c"), (91, "x\x0by\x0cz #*$%&|<> !!"), (92, "a a a a a"), (93, "a b"), (94, "   ")]
    rows = spark.createDataFrame(extra, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    got = q.with_stats(rows).select("doc_id", *[F.col(f"`{q.STATS}`")[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")])
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == sorted((str(i), *plain(t)) for i, t in [*extra, *odd_rows])


def test_rules_are_learned_and_kept_to(spark):
    good = [(i, prose(i, 120)) for i in range(150)]
    bad = [(1000 + i, " ".join(w + "###" for w in prose(i, 120).split(" "))) for i in range(60)]
    docs = spark.createDataFrame([*good, *bad, (5000, "short"), (5001, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _ in [*good, *bad] if i % 3] + [(None, 0, 0), (1, None, 0), (2, 0, 0), (2, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in q.digest(docs, labels).collect()}
    assert all(got[i].kept for i, _ in good)
    assert not any(got[i].kept for i, _ in bad) and all(got[i].rule == 1 for i, _ in bad)
    assert got[5000].base_failed and got[5001].base_failed and not got[5001].kept
    assert q.keep_good(docs, labels).count() == len(good)


def labelled(spark, rows):
    """(id, mean word length, words a line, label) as statistics and labels."""
    stat = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long, n_bangs long"
    stats = spark.createDataFrame([(i, (1000, round(1000 * chars), 0, 0, 0, round(1000 / words), 0, 0)) for i, chars, words, _ in rows],
                                  f"doc_id long, `{q.STATS}` struct<{stat}>")
    return stats, spark.createDataFrame([(i, y) for i, _, _, y in rows], "doc_id long, quality int")


def missed_and_wrong(stats, labels, rules):
    judged = stats.join(labels, "doc_id").withColumn("rule", q.verdict(rules))
    return judged.where("quality = 0 and rule is null").count(), judged.where("quality = 1 and rule is not null").count()


def test_rare_bad_kinds_are_learned(spark):
    r = random.Random(5)
    rows = [(i, r.gauss(5, 0.4), 10, 1) for i in range(8000)]
    rows += [(10_000 + i, r.gauss(9, 0.2), 10, 0) for i in range(45)]  # about half a hundredth
    stats, labels = labelled(spark, rows)
    assert missed_and_wrong(stats, labels, q.learn_rules(stats, labels)) == (0, 0)


def test_more_than_eight_bad_kinds_are_learned(spark):
    r = random.Random(6)
    rows = [(i, 2 * r.randrange(2, 14) + r.uniform(0, 0.9), 10, 1) for i in range(3000)]
    rows += [(10_000 + 100 * k + i, 2 * k + 1 + r.uniform(0.1, 0.8), 10, 0) for k in range(2, 13) for i in range(60)]
    stats, labels = labelled(spark, rows)
    rules = q.learn_rules(stats, labels)
    missed, wrong = missed_and_wrong(stats, labels, rules)
    assert len(rules) > 8 and missed <= 20 and wrong <= 10


def test_noise_gives_no_rules(spark):
    r = random.Random(7)
    stats, labels = labelled(spark, [(i, r.gauss(5, 0.4), r.uniform(5, 20), int(r.random() > 0.1)) for i in range(4000)])
    assert q.learn_rules(stats, labels) == []


def test_columns_with_names_used_inside_pass_unchanged(spark, odd_docs):
    used = [q.STATS, q.ROW, "qs text", "qs words", "qs lines", "qs grams", "qs sorted", "qs again", "quality kept", "quality rule", "quality base_failed", "a.b"]
    docs = spark.createDataFrame([(i, prose(i, 60), *[f"{c} {i}" for c in used]) for i in range(5)],
                                 "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in used))
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality int")
    kept = q.keep_good(docs, labels)
    assert kept.schema == docs.schema and sorted(kept.collect()) == sorted(docs.collect())
    assert {"qs text", "a.b"} <= set(q.judge(docs, labels).columns)
    assert q.keep_good(odd_docs, labels).columns == odd_docs.columns


def test_without_labels_or_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    judged = q.judge(odd_docs.drop(q.STATS), labels)
    assert judged.where("`quality kept` = `quality base_failed`").count() == 0
    assert q.judge(no_docs, labels).count() == 0

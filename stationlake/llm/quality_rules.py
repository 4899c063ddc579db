"""Quality rules learned as a decision list, in DataFrame functions only.

`with_stats` adds a document's statistics (word, symbol and repetition counts)
as one struct column, computed inside the row: no shuffle, no Python.
`learn_rules` runs sequential covering over the labelled statistics. Each rule
is a conjunction of threshold conditions. It is grown on two thirds of the
labelled rows by FOIL gain, one condition at a time: Spark counts a histogram
per feature and bin of the rows still uncovered, and bins that may hold a better
threshold than any found so far are split until none is left. The rule is pruned
on the last third and accepted if it is precise enough there. Rows that it
covers leave, and the next rule is learned, until an attempt gains no more bits
than it takes to name its thresholds. The driver only sees histograms, at most
SPLIT_BINS x BINS rows at a time, whatever the number of documents. `verdict`
turns the list into one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bins per feature at first (by quantiles of the labelled rows), and parts into which a bin is split.
BINS = 48
#: Bins split in one pass over the rows; further passes take the others.
SPLIT_BINS = 128
MAX_CONDITIONS = 4
#: A rule must reject this share of bad rows among the pruning rows that it covers, and so many of them.
MIN_PRECISION = 0.97
MIN_COVERED = 3

_SPACE = r"[\x20\x09-\x0D]+"
STATS = "quality stats"
#: The input row as one struct, so that no input column meets a column made here.
ROW = "quality row"


def _matches(text: Column, chars: str) -> Column:
    """How many characters of a class the text has."""
    return (F.size(F.split(text, chars, -1)) - 1).cast("long")


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with a struct column STATS (in place of one of that name): the counts of the contract and the features of the rules.

    Words are `[^\\x20\\x09-\\x0D]+`; a null text has none. n_dup_lines: lines
    with a word that equal an earlier line. n_repeat_words: words that lie in a
    three-word window found twice or more in the text (64-bit window hashes).
    Work and memory are n log n in the words of one text.
    """
    return _row_stats(docs, text_col).select(*_unpacked(docs, STATS), F.col(f"`{STATS}`"))


def _unpacked(docs: DataFrame, *without: str) -> list[Column]:
    return [F.col(ROW)[c].alias(c) for c in docs.columns if c not in without]


def _row_stats(docs: DataFrame, text_col: str) -> DataFrame:
    """ROW and STATS of each row."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))
    d = d.withColumn("qs text", F.coalesce(F.col(ROW)[text_col].cast("string"), F.lit("")))
    lines = F.filter(F.split("qs text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0)
    d = d.withColumn("qs words", F.array_remove(F.split("qs text", _SPACE, -1), "")).withColumn("qs lines", lines)
    w = F.col("qs words")
    n = F.size(w)
    d = d.withColumn("qs grams", F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
        .otherwise(F.array().cast("array<bigint>")))
    g = F.col("qs grams")
    # windows sorted by hash with their places, for texts with any repeated window
    d = d.withColumn("qs sorted", F.when(F.size(F.array_distinct(g)) < F.size(g), F.sort_array(
        F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("qs sorted")
    again = F.filter(s, lambda t, i: (t["h"] == F.get(s, i - 1)["h"]) | (t["h"] == F.get(s, i + 1)["h"]))
    d = d.withColumn("qs again", F.sort_array(F.transform(again, lambda t: t["i"])))
    a = F.col("qs again")
    m = F.size(a)
    overlap = F.zip_with(F.slice(a, 1, m - 1), F.slice(a, 2, m - 1), lambda x, y: F.greatest(F.lit(0), 3 - (y - x)))
    repeat = F.when(m > 0, 3 * m - F.aggregate(overlap, F.lit(0), lambda x, y: x + y)).otherwise(F.lit(0))
    t = F.col("qs text")
    counts = [n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
              _matches(t, "[#*$%&|<>]").alias("n_symbols"),
              (F.size("qs lines") - F.size(F.array_distinct("qs lines"))).cast("long").alias("n_dup_lines"),
              repeat.cast("long").alias("n_repeat_words"), F.size("qs lines").cast("long").alias("n_lines"),
              _matches(t, "[A-Z]").alias("n_capitals"), _matches(t, "!").alias("n_bangs")]
    return d.select(ROW, F.struct(*counts).alias(STATS))


def _features() -> dict[str, Column]:
    s = F.col(f"`{STATS}`")
    words, chars, lines = (F.greatest(s[c], F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    return {
        "n_words": s["n_words"].cast("double"),
        "mean_word_chars": s["word_chars"] / words,
        "symbols_per_word": s["n_symbols"] / words,
        "dup_line_share": s["n_dup_lines"] / lines,
        "repeat_word_share": s["n_repeat_words"] / words,
        "capital_share": s["n_capitals"] / chars,
        "bangs_per_word": s["n_bangs"] / words,
        "words_per_line": s["n_words"] / lines,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return self._on(_features()[self.feature])

    def on_labelled(self, names: list[str]) -> Column:
        return self._on(F.col("at")[names.index(self.feature)])

    def _on(self, value: Column) -> Column:
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Part:
    """Rows whose value of a feature lies from lo to hi (both occur): bad and other ones; the bin that they lie in."""
    lo: float
    hi: float
    p: int
    n: int
    bin: int


def _bin(name: str, cuts: list[float]) -> Column:
    """How many of the ascending thresholds lie below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(name)))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    if not p:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn_rules(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> list[Rule]:
    """Ordered rules that recognise documents labelled 0, learned from all labelled rows.

    Rows that the base rule rejects anyway take no part.
    stats: rows with id and STATS; labels: id, 0 or 1. Labels that are null or
    that contradict each other for one id are left out; without labels of both
    kinds there are no rules.
    """
    clean = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null")
             .groupBy("id").agg(F.min("y").alias("lo"), F.max("y").alias("hi")).where("lo = hi").select("id", F.col("lo").alias("y")))
    names = list(_features())
    rows = stats.where(~base_failed()).select(F.col(id_col).alias("id"), *[c.alias(n) for n, c in _features().items()]).join(clean, "id")
    rows = written(rows.select(*names, (F.col("y") == 0).cast("int").alias("bad"),
                               (F.pmod(F.xxhash64("id"), F.lit(3)) != 0).alias("grow")), "labelled")
    shares = [i / BINS for i in range(BINS + 1)]
    found = rows.agg(*[F.percentile_approx(n, shares, 10_000).alias(n) for n in names]).first()
    cuts = {n: sorted(set(found[n] or [])) for n in names}
    if not all(cuts.values()):
        return []
    # bin b: thresholds b-1 < value <= b, so `bin <= b` says value <= cuts[b]
    bins = F.array(*[_bin(n, cuts[n]) for n in names])
    rows = written(rows.select("bad", "grow", bins.alias("bins"), F.array(*names).alias("at")), "binned")

    rules: list[Rule] = []
    while grown := _grow(rows, names):
        rule = _prune(rows, names, grown)
        out = _all([c.on_labelled(names) for c in rule or grown])
        if rule:
            rules.append(rule)
        else:  # not precise on the pruning rows: its growing rows are set aside and growing goes on
            out = out & F.col("grow")
        rows = rows.where(~out)
    return rules


def _grow(rows: DataFrame, names: list[str]) -> Rule:
    """A rule for the growing rows, or nothing if no beginning of it gains more bits than naming its thresholds takes."""
    rule: list[Condition] = []
    first, worth = (0, 0), False
    while len(rule) < MAX_CONDITIONS:
        here = rows.where("grow").where(_all([c.on_labelled(names) for c in rule]))
        (p0, n0), best = _best_condition(here, names)
        if not rule:
            first = p0, n0
        if best is None:
            break
        condition, p, n = best
        rule.append(condition)
        worth |= _gain(p, n, *first) > len(rule) * math.log2(2 * len(names) * sum(first))
    return tuple(rule) if worth else ()


def _best_condition(here: DataFrame, names: list[str]) -> tuple[tuple[int, int], tuple[Condition, int, int] | None]:
    """Bad and other rows, and the condition of the highest gain over all thresholds, with the rows that it covers."""
    counts = (here.select("bad", F.posexplode(F.arrays_zip("bins", "at")).alias("feature", "v"))
              .groupBy("feature", F.col("v.bins").alias("bin"))
              .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"),
                   F.min("v.at").alias("lo"), F.max("v.at").alias("hi")).collect())
    parts: dict[int, list[Part]] = {}
    for r in counts:
        parts.setdefault(r["feature"], []).append(Part(r["lo"], r["hi"], r["p"], r["n"], r["bin"]))
    p0, n0 = (sum(x) for x in zip(*((x.p, x.n) for x in parts.get(0, [])))) if parts else (0, 0)
    if not p0 or not n0:
        return (p0, n0), None
    while True:
        best: tuple[float, Condition, int, int] | None = None
        mixed: list[tuple[float, int, Part]] = []
        for f, found in sorted(parts.items()):
            found.sort(key=lambda x: x.lo)
            p = n = 0
            for x, after in zip(found, [*found[1:], None]):
                if x.p and x.n and x.lo < x.hi:  # at best a threshold inside parts its bad rows from all others
                    mixed.append((max(_gain(p + x.p, n, p0, n0), _gain(p0 - p, n0 - n - x.n, p0, n0)), f, x))
                p, n = p + x.p, n + x.n
                if after is None:
                    break
                for above, q, m in ((False, p, n), (True, p0 - p, n0 - n)):
                    g = _gain(q, m, p0, n0)
                    if g > 1e-9 and (best is None or g > best[0]):
                        # halfway to the next value seen, so that both sides keep a margin
                        at = (x.hi + after.lo) / 2
                        best = g, Condition(names[f], above, at if x.hi <= at < after.lo else x.hi), q, m
        least = best[0] if best else 0.0
        split = sorted((x for x in mixed if x[0] > least + 1e-9), key=lambda x: (-x[0], x[1], x[2].lo))[:SPLIT_BINS]
        if not split:
            return (p0, n0), best and best[1:]
        for f, x, smaller in _split(here, [(f, x) for _, f, x in split]):
            parts[f].remove(x)
            parts[f] += smaller


def _split(here: DataFrame, wanted: list[tuple[int, Part]]) -> list[tuple[int, Part, list[Part]]]:
    """Each wanted part of a feature, and the up to BINS parts of equal width in it that hold rows."""
    by: dict[int, list[Part]] = {}
    for f, x in sorted(wanted, key=lambda w: (w[0], w[1].lo)):
        by.setdefault(f, []).append(x)
    places = []
    for f, found in by.items():
        v = F.col("at")[f]
        lows, highs = (F.array(*map(F.lit, x)) for x in ([x.lo for x in found], [x.hi for x in found]))
        no = F.size(F.filter(lows, lambda low: low <= v)) - 1
        low, high = F.get(lows, no), F.get(highs, no)
        piece = F.least(F.floor((v - low) / (high - low) * BINS), F.lit(BINS - 1)).cast("int")
        at = F.struct(F.lit(f).alias("feature"), no.alias("no"), piece.alias("piece"), v.alias("v"))
        places.append(F.when(F.col("bins")[f].isin(sorted({x.bin for x in found})), F.when(v <= high, at)))
    counts = (here.select("bad", F.explode(F.array_compact(F.array(*places))).alias("a"))
              .groupBy("a.feature", "a.no", "a.piece")
              .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"), F.min("a.v").alias("lo"), F.max("a.v").alias("hi")).collect())
    smaller: dict[tuple[int, int], list[Part]] = {}
    for r in counts:
        smaller.setdefault((r["feature"], r["no"]), []).append(Part(r["lo"], r["hi"], r["p"], r["n"], by[r["feature"]][r["no"]].bin))
    return [(f, x, smaller[f, no]) for f, found in by.items() for no, x in enumerate(found)]


def _prune(rows: DataFrame, names: list[str], rule: Rule) -> Rule:
    """The best beginning of the rule on the pruning rows, or nothing if it is not precise there."""
    held = rows.where("not grow")
    sums = []
    for i in range(1, len(rule) + 1):
        c = _all([x.on_labelled(names) for x in rule[:i]])
        sums += [F.sum(F.when(c, F.col("bad")).otherwise(0)).alias(f"p{i}"),
                 F.sum(F.when(c, 1 - F.col("bad")).otherwise(0)).alias(f"n{i}")]
    r = held.agg(*sums).first()
    best, value = 0, -2.0
    for i in range(1, len(rule) + 1):
        p, n = r[f"p{i}"] or 0, r[f"n{i}"] or 0
        if p + n and (p - n) / (p + n) > value:
            best, value = i, (p - n) / (p + n)
    if not best:
        return ()
    p, n = r[f"p{best}"], r[f"n{best}"]
    return rule[:best] if p >= MIN_COVERED and p >= MIN_PRECISION * (p + n) else ()


def base_failed() -> Column:
    s = F.col(f"`{STATS}`")
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects a document, from 1; null where none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_all([c.column() for c in rule]), F.lit(i)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> DataFrame:
    """docs with STATS, `quality base_failed`, `quality rule` and `quality kept`, in place of columns of those names.

    The statistics are computed once and written, with the columns of docs, to
    the shared folder; learning reads only id and statistics from there. Null
    and empty texts have no words and fail the base rule. Empty tables give no
    rows; without labels only the base rule decides.
    """
    added = [STATS, "quality base_failed", "quality rule", "quality kept"]
    return _judged(docs, labels, id_col, text_col, label_col).select(*_unpacked(docs, *added), *[F.col(f"`{c}`") for c in added])


def _judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """ROW and the columns that judge adds."""
    stats = written(_row_stats(docs, text_col), "quality")
    rules = learn_rules(stats.select(F.col(ROW)[id_col].alias(id_col), F.col(f"`{STATS}`")), labels, id_col, label_col)
    out = stats.withColumn("quality base_failed", base_failed()).withColumn("quality rule", verdict(rules))
    return out.withColumn("quality kept", ~F.col("quality base_failed") & F.col("quality rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame, **names: str) -> DataFrame:
    """The rows of docs that neither the base rule nor a learned rule rejects, unchanged."""
    return _judged(docs, labels, **names).where("`quality kept`").select(*_unpacked(docs))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns, and the number of the rejecting rule."""
    j = judge(docs.select("doc_id", "text").withColumn("text", F.col("text").cast("string")), labels)
    s = F.col(f"`{STATS}`")
    return j.select("doc_id", *[s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                    F.col("quality base_failed").alias("base_failed"), F.col("quality kept").alias("kept"),
                    F.col("quality rule").alias("rule"))

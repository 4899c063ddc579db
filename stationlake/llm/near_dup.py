"""MinHash near-duplicate detection with bottom-k sketches.

Method. One hash function orders all word shingles; a document's sketch is the
k smallest hashes of its shingle set. Inverted lists of the retained values
generate overlaps, the sketch of the union estimates the similarity, and the
exact Jaccard similarity of the full sets confirms a link.

No link is lost to list lengths. Retained values are ranked rarest first and a
document enters the lists of only its first `shared - c + 1` shared values: two
documents whose sketches have c values in common must meet in one of those
(prefix filtering), so a passage shared by a third of the corpus costs nothing
for documents that also hold text of their own. c is the overlap that a pair at
the threshold falls short of with probability under 1e-10 (see `least_overlap`).

Equal sets collapse into one class first. In each list the member with the most
common content (its head) is compared with all members; links found so far give
labels (components). Lists whose members still have different labels are looked
at again through the members' differences to the head, D = set xor head set. The
difference of two members is the xor of their D, so a link needs an overlap of
their D that grows with these, and at least one common element if one of the two
is not linked to the head; what all copies have in common is gone. Within a list,
elements are ranked rarest first, and a pair meets in the first allowed / 2 + 1
elements of the smaller D and the first allowed + 1 of the larger one, allowed
being the most elements in which linked sets can differ. Again the head of each
such list comes first, then pairs whose labels still differ, and only if what is
left of both D behind the common element can still reach the overlap. Connected
components of all links are the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import row_key, ship, small_batches, written
from .components import connected_components

CHUNK_BYTES = 2 << 20


def least_overlap(size: int, k: int, num: int, den: int, miss: float = 1e-10) -> int:
    """Retained values that a pair at Jaccard num/den or more shares, but for probability `miss`.

    size: the set's size. Sets of up to k shingles are retained whole, so
    ceil(size * num / den) values are shared for certain. For larger sets each
    of the k smallest values of the union is shared with probability num/den.
    """
    t, tail, c = num / den, 0.0, 0
    while c < k:
        tail += comb(k, c) * t**c * (1 - t) ** (k - c)
        if tail > miss:
            break
        c += 1
    return max(1, min(c, -(-size * num // den)))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (A-Z lower-cased).

    Fewer words than `width`: the whole sequence is the one shingle; no word: empty.
    """
    w = tv.words(texts, tv.space_separators(), lower=True)
    grams = tv.window_hash(w.hash, width)
    sets = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        n = b - a
        if n >= width:
            s = np.sort(grams[a : b - width + 1])
            sets.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        else:
            sets.append(np.array([tv.sequence_hash(w.hash[a:b])] if n else [], dtype=np.uint64))
    return sets


def _signed(s: np.ndarray) -> np.ndarray:
    return s.view(np.int64)


def _keys(s: np.ndarray) -> tuple[int, int]:
    """128-bit identity of a set."""
    a = int(np.sum(tv.mix(s ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)) if len(s) else 0
    b = int(np.bitwise_xor.reduce(tv.mix(s + np.uint64(0x14057B7EF767814F)))) if len(s) else 0
    return np.uint64(a).view(np.int64).item(), np.uint64(b).view(np.int64).item()


def _sketcher(width: int, k: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tv.rechunk(batches, tv.text_sizes("text"), CHUNK_BYTES):
            sets = shingle_sets(b.column("text"), width)
            keys = [_keys(s) for s in sets]
            low = [s[:k] for s in sets]
            ends = np.cumsum([0, *map(len, low)], dtype=np.int32)
            flat = np.concatenate([*low, np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([
                b.column("id").cast(id_type), b.column("rk"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([x for x, _ in keys], pa.int64()), pa.array([y for _, y in keys], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(_signed(flat))),
            ], names=["id", "rk", "n", "k1", "k2", "sketch"])
        tv.lean(0)  # idle workers stay: what a task has freed is not left with them
    return run


def _set_writer(width: int):
    """(cid, k1, k2, text) -> (cid, members): the full set, where it is the class's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tv.rechunk(batches, tv.text_sizes("text"), CHUNK_BYTES):
            sets = shingle_sets(b.column("text"), width)
            same = [_keys(s) == (x, y) for s, x, y in
                    zip(sets, b.column("k1").to_pylist(), b.column("k2").to_pylist())]
            yield pa.RecordBatch.from_arrays([
                b.column("cid").filter(pa.array(same, pa.bool_())),
                pa.array([s.tobytes() for s, ok in zip(sets, same) if ok], pa.binary()),
            ], names=["cid", "members"])
        tv.lean(0)
    return run


def similar(a: np.ndarray, b: np.ndarray, k: int, num: int, den: int) -> bool:
    """Linked by the estimate on the union's sketch and by den * |a & b| >= num * |a | b|."""
    la, lb = a[:k], b[:k]
    both = np.concatenate((la, lb))
    both.sort()
    dup = both[1:] == both[:-1]
    union = len(both) - int(dup.sum())
    if union > k:  # the k smallest of the union decide
        distinct = both[np.concatenate(([True], ~dup))]
        shared = int((both[1:][dup] <= distinct[k - 1]).sum())
    else:
        shared = int(dup.sum())
    if shared < least_overlap(min(union, k), k, num, den):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return den * common >= num * (len(a) + len(b) - common)


def _verifier(k: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = pa.array([similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), k, num, den)
                            for x, y in zip(batch.column("sa"), batch.column("sb"))], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(got), batch.column("b").filter(got)], names=["a", "b"])
        tv.lean(0)
    return run


def _tested(pairs: DataFrame, sets: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(a, b) of the pairs that are links, written."""
    both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("members").alias("sa")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("members").alias("sb")), "b"))
    linked = both.select("a", "b", "sa", "sb").mapInArrow(_verifier(k, num, den), "a long, b long").select("a", "b")
    with small_batches(pairs.sparkSession):
        return written(linked, "links")


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(head, cid, n, label, sa, sb) -> (head, cid, n, label, d, values): what is in one of the two sets only."""
    for batch in batches:
        for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
            both = np.concatenate((np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)))
            both.sort()
            twice = both[1:] == both[:-1]
            once = np.ones(len(both), dtype=bool)
            once[1:] &= ~twice
            once[:-1] &= ~twice
            values = _signed(both[once])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in ("head", "cid", "n", "label")), pa.array([len(values)], pa.int64()),
                                              pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))],
                                             names=["head", "cid", "n", "label", "d", "values"])
    tv.lean(0)


def _similar_size(a: str, b: str, num: int, den: int) -> Column:
    return (F.least(a, b) * F.lit(den)) >= (F.greatest(a, b) * F.lit(num))


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """members (cid, ...) with a label: the smallest class within two links.

    Classes with equal labels are connected; the members of one head get the
    same label. That is all the labels are for (to leave out pairs that are
    connected already), so two passes are enough.
    """
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
    found = both.join(near, "b").groupBy("a").agg(F.min("m").alias("found"))
    return (members.join(found.withColumnRenamed("a", "cid"), "cid", "left")
            .withColumn("label", F.least("cid", F.coalesce("found", "cid"))).drop("found"))


def _reach(num: int, den: int) -> Column:
    """Whether the rest of both differences, from the common element on, can hold the overlap of a link."""
    rest = F.least(F.col("d") - F.col("rank"), F.col("pd") - F.col("pr")) + 1
    return rest * F.lit(2 * (den + num)) >= (F.col("d") + F.col("pd")) * F.lit(den + num) - (F.col("n") + F.col("pn")) * F.lit(den - num)


def _links(lists: DataFrame, sets: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """All links (a, b) between the classes in lists (key, cid, n, score), but for some inside a component."""
    heads = (lists.groupBy("key").agg(F.max(F.struct("score", F.xxhash64("cid").alias("h"), "cid", "n")).alias("head"),
                                      F.count("*").alias("m"))
             .where("m > 1").select("key", F.col("head.cid").alias("head"), F.col("head.n").alias("head_n")))
    grouped = written(lists.join(heads, "key").where("cid <> head").select("head", "head_n", "cid", "n").distinct(), "heads")
    first = grouped.where(_similar_size("n", "head_n", num, den)).select(
        F.least("cid", "head").alias("a"), F.greatest("cid", "head").alias("b")).distinct()
    linked = _tested(first, sets, k, num, den)

    members = grouped.select("head", "cid", "n").union(grouped.select("head", F.col("head").alias("cid"), F.col("head_n").alias("n")).distinct())
    members = written(_labelled(members, linked), "labels")
    mixed = members.groupBy("head").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("head")
    left = members.join(mixed, "head", "left_semi").where("cid <> head")
    both = (left.join(sets.select("cid", F.col("members").alias("sa")), "cid")
            .join(sets.select(F.col("cid").alias("head"), F.col("members").alias("sb")), "head"))
    apart = both.select("head", "cid", "n", "label", "sa", "sb").mapInArrow(
        _differ, "head long, cid long, n long, label long, d long, values array<long>")
    with small_batches(lists.sparkSession):
        values = written(apart.select("head", "cid", "n", "label", "d", F.explode("values").alias("v")), "values")
    shared = values.groupBy("head", "v").agg(F.count("*").alias("f")).where("f > 1")
    own = Window.partitionBy("head", "cid")
    allowed = F.floor(F.col("n") * F.lit(den - num) / F.lit(num))
    placed = (values.join(shared, ["head", "v"])
              .withColumn("rank", F.col("d") - F.count("*").over(own) + F.row_number().over(own.orderBy("f", "v")))
              .where(F.col("rank") <= allowed + 1)
              .withColumn("indexed", F.col("rank") <= F.floor(allowed / 2) + 1))
    placed = written(placed, "prefixes")

    # the head of each list of a difference, then the pairs that labels still tell apart
    top = (placed.where("indexed").groupBy("head", "v").agg(F.min(F.struct("d", "cid", "n", "label", "rank")).alias("t"))
           .select("head", "v", F.col("t.cid").alias("p"), F.col("t.n").alias("pn"), F.col("t.d").alias("pd"), F.col("t.label").alias("pl"), F.col("t.rank").alias("pr")))
    second = _candidates(placed.join(top, ["head", "v"]).where("cid <> p"), num, den)
    linked = linked.union(_tested(second, sets, k, num, den))
    placed = written(_labelled(placed.drop("label"), linked), "prefixes")
    one = placed.where("indexed").select("head", "v", F.col("cid").alias("p"), F.col("n").alias("pn"), F.col("d").alias("pd"),
                                         F.col("label").alias("pl"), F.col("rank").alias("pr"))
    several = placed.groupBy("head", "v").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("head", "v")
    third = _candidates(placed.join(several, ["head", "v"], "left_semi").join(one, ["head", "v"]).where("pd < d or (pd = d and p < cid)"), num, den)
    return linked.union(_tested(third, sets, k, num, den))


def _candidates(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct (a, b) of the joined rows that can be a new link."""
    able = pairs.where("label <> pl").where(_similar_size("n", "pn", num, den)).where(_reach(num, den))
    return able.select(F.least("cid", "p").alias("a"), F.greatest("cid", "p").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    num: int = 8, den: int = 10, k: int = 64) -> DataFrame:
    """(id, rk, n_shingles, component_id, kept), a row per row of docs.

    width: words of a shingle; num/den: similarity from which documents are
    linked; k: sketch size. component_id is the smallest id reachable over
    links; kept marks the row that stays for its group.

    Null or wordless text: empty set, linked with nothing, component_id its own
    id. A null id never becomes a component's id unless the whole component has
    none; such rows have kept = (id is null and component_id is null). Repeated
    rows get equal results. Other columns of docs are not read. rk is the row
    key of common.row_key. Empty input gives no rows.
    """
    out = _grouped(docs, id_col, text_col, width, num, den, k)
    return out.select(F.col("id").alias(id_col), "rk", F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int = 5, num: int = 8, den: int = 10, k: int = 64) -> DataFrame:
    """(id, rk, n, component, component_id); component: the group's internal number, null for an empty set."""
    ship(docs)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                         row_key(id_col, text_col).alias("rk"))
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = docs.schema[id_col].dataType
    rows = written(source.mapInArrow(
        _sketcher(width, k, to_arrow_type(id_type)),
        f"id {id_type.simpleString()}, rk long, n long, k1 long, k2 long, sketch array<long>"), "sketches")
    classes = written(rows.where("n > 0").groupBy("k1", "k2", "n")
                      .agg(F.min("id").alias("id"), F.min("rk").alias("rk"), F.first("sketch").alias("sketch"))
                      .withColumn("cid", F.monotonically_increasing_id()), "classes")

    values = classes.select("cid", "n", F.explode("sketch").alias("v"))
    often = values.groupBy("v").agg(F.count("*").alias("f")).where("f > 1")
    top = least_overlap(1 << 40, k, num, den)
    c = F.least(F.lit(top), F.ceil(F.col("n") * F.lit(num) / F.lit(den)))
    own = Window.partitionBy("cid")
    lists = written(values.join(often, "v")
                    .withColumn("shared", F.count("*").over(own))
                    .withColumn("score", F.sum(F.log2("f")).over(own))
                    .withColumn("rank", F.row_number().over(own.orderBy("f", "v")))
                    .where(F.col("rank") <= F.col("shared") - c + 1)
                    .select(F.col("v").alias("key"), "cid", "n", "score"), "lists")
    wanted = lists.select("cid").distinct().join(classes.select("cid", "k1", "k2", "rk"), "cid")
    sets = written(source.select("rk", "text").join(wanted.hint("shuffle_hash"), "rk")
                   .select("cid", "k1", "k2", "text").mapInArrow(_set_writer(width), "cid long, members binary")
                   .dropDuplicates(["cid"]), "sets")
    labels = connected_components(_links(lists, sets, k, num, den)).withColumnRenamed("node", "cid")
    member = classes.select("cid", "k1", "k2", "n", "id").join(labels, "cid", "left") \
        .withColumn("component", F.coalesce("component", "cid"))
    lowest = member.groupBy("component").agg(F.min("id").alias("component_id"))
    named = member.join(lowest, "component").select("k1", "k2", "n", "component", "component_id")
    out = rows.select("id", "rk", "n", "k1", "k2").join(named, ["k1", "k2", "n"], "left") \
        .withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))
    return out.select("id", "rk", "n", "component", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """docs with one document of each near-duplicate group: the one with the smallest id.

    All columns pass unchanged. Null ids come last; of different texts with the
    same id the one with the smallest row key stays. Of rows with equal id and
    text one stays (the smallest in column order); documents without words are
    in no group, and all others of them stay.
    """
    found = _grouped(docs, id_col, text_col, **params).groupBy("component", "id", "rk").agg(F.count("*").alias("copies"))
    found = written(found, "grouped")
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "rk", "copies"))
    grouped = found.where("component is not null").groupBy("component").agg(best.alias("r")).select("r.rk", "r.copies")
    keys = written(grouped.union(found.where("component is null").select("rk", "copies")), "kept")
    rows = docs.select(row_key(id_col, text_col).alias("rk"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    once, more = (keys.where(c).select("rk") for c in ("copies = 1", "copies > 1"))
    single = rows.join(once, "rk", "left_semi").select("row.*")
    repeated = rows.join(more, "rk", "left_semi").groupBy("rk").agg(F.min("row").alias("row")).select("row.*")
    return single.union(repeated)

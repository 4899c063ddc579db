"""Sequence packing as a cutting-stock problem, solved by column generation.

Documents are tokenized and cut at multiples of the capacity; full pieces are
sequences of their own and the rest of each document is one piece. Spark counts
the pieces per length class (short lengths exactly, longer ones rounded up by
less than 1 in FINE: a bounded histogram). On the driver a linear program over cutting patterns is solved by
the revised simplex method, with a knapsack dynamic program pricing new
patterns. Pattern counts are rounded down, the few pieces left over are packed
greedily into further patterns, and Spark gives the pieces of each class, in
ranked order, to the slots of the patterns.

Ranks are two-level (class and salt), so a length that a third of all documents
share is ranked by many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textvec as tv
from .common import ship, written
from .encode import encoder, with_end

CHUNK_BYTES = 2 << 20
#: Lengths over `FINE * 2**i` are rounded up to multiples of 2**i; up to 2 * FINE lengths are exact.
FINE = 64
#: Parts in which the pieces of a class are ranked, whatever the number of partitions.
SALTS = 256


@dataclass(frozen=True)
class Pattern:
    """`times` sequences that each hold count[c] pieces of class c (a class is a rounded length in tokens)."""

    count: dict[int, int]
    times: int


def _price(value: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack by dynamic programming: the pattern of greatest value."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right").tolist()
    for c in range(int(sizes[0]), capacity + 1):
        got = best[c - sizes[: fits[c]]] + value[: fits[c]]
        i = int(got.argmax())
        if got[i] > best[c - 1] + 1e-12:
            best[c], took[c] = got[i], i
        else:
            best[c] = best[c - 1]
    column, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
            continue
        column[took[c]] += 1
        c -= int(sizes[took[c]])
    return float(best[capacity]), column


def solve(demand: dict[int, int], capacity: int, gap: float = 1e-3, rounds: int = 400, waste: float = 0.01) -> list[Pattern]:
    """Patterns that hold exactly the demanded pieces; capacity and classes in tokens.

    Column generation ends within `gap` of the linear program's optimum (no
    pattern is worth over 1 + gap), or after `rounds` patterns. Patterns of the
    program that leave more than `waste` of a sequence empty are not used; what
    the others leave over is packed largest first. Either way the patterns cover
    the demand.
    """
    classes = sorted(c for c, n in demand.items() if n)
    if not classes:
        return []
    sizes = np.array(classes)
    whole = np.array([demand[c] for c in classes])
    m = len(classes)
    need = whole * (1 + 1e-4 * np.arange(1, m + 1) / m)  # uneven on purpose: no degenerate steps
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(columns))
    x = need / np.diag(columns)
    for _ in range(rounds):
        dual = inverse.sum(axis=0)
        worth, column = _price(np.maximum(dual, 0.0), sizes, capacity)
        if worth <= 1 + gap:
            break
        column[dual <= 0] = 0
        u = (inverse * column).sum(axis=1)  # no BLAS: its threads do not suit a busy driver
        ratio = np.where(u > 1e-9, x / np.where(u > 1e-9, u, 1.0), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        columns[:, leave] = column
        row = inverse[leave] / u[leave]
        inverse -= np.outer(u, row)
        inverse[leave] = row
        x = np.maximum((inverse * need).sum(axis=1), 0.0)
    left = whole.astype(np.int64)
    out = []
    for j in np.argsort(-x):
        column = columns[:, j].astype(np.int64)
        used = column > 0
        if int((column * sizes).sum()) < capacity * (1 - waste):
            continue  # its pieces are better off with the others that are left over
        times = int(min(np.floor(x[j] + 1e-9), (left[used] // column[used]).min()))
        if times > 0:
            left -= times * column
            out.append(Pattern({classes[i]: int(column[i]) for i in np.flatnonzero(used)}, times))
    while left.any():  # at most a few pieces a pattern are left
        column, room = np.zeros(m, dtype=np.int64), capacity
        for i in range(m - 1, -1, -1):
            take = min(int(left[i]), room // classes[i])
            column[i] = take
            room -= take * classes[i]
        used = column > 0
        times = int((left[used] // column[used]).min())
        left -= times * column
        out.append(Pattern({classes[i]: int(column[i]) for i in np.flatnonzero(used)}, times))
    return out


def _cutter(tokenizer, end_id: int, capacity: int, id_type: pa.DataType, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer.value)
        for b in tv.rechunk(batches, tv.text_sizes("text"), CHUNK_BYTES):
            ids, off = with_end(*enc.encode(b.column("text")), end_id)
            total = np.diff(off)
            pieces = -(-total // capacity)
            doc = np.repeat(np.arange(len(b)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
            length = np.minimum(total[doc] - start, capacity)
            at = off[doc] + start
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            arrays = [b.column("id").cast(id_type).take(pa.array(doc)), pa.array(start), pa.array(length),
                      pa.array(crc, pa.int64()), pa.array(total[doc])]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
         capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most `capacity` tokens.

    Columns: id, start (ids of the document before the piece), length, ids_crc32
    (of its ids as little-endian unsigned 32-bit integers), doc_tokens (with the
    end id), sequence_id, offset; with_ids adds the ids themselves. Null text:
    empty, one piece with the end id. Repeated rows and null ids are packed like
    any others; other columns are not read; an empty table gives no rows.
    """
    ship(docs)
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())  # a vocabulary file: bounded, a few MB
    id_field = docs.schema[id_col].dataType
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {id_field.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long" + (
        ", ids array<int>" if with_ids else "")
    pieces = written(source.mapInArrow(_cutter(tokenizer, end_id, capacity, to_arrow_type(id_field), with_ids), schema)
                     .withColumn("class", _class(F.col("length"), capacity))
                     .withColumn("salt", F.pmod(F.xxhash64("id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")), "pieces")
    # at most classes x SALTS rows, whatever the number of documents
    counts = pieces.groupBy("class", "salt").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("class", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    demand = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(_slots(solve(demand, capacity)),
                                  "class int, until array<long>, each array<long>, base array<long>")

    rank = F.col("before") + F.row_number().over(
        Window.partitionBy("class", "salt").orderBy("id", "start", "ids_crc32", "doc_tokens")) - 1
    placed = (pieces.join(before, ["class", "salt"]).withColumn("rank", rank)
              .join(F.broadcast(slots), "class")
              .withColumn("slot", F.size(F.filter("until", lambda u: u <= F.col("rank")))))
    begin = F.when(F.col("slot") > 0, F.get("until", F.col("slot") - 1)).otherwise(F.lit(0))
    inside = F.col("rank") - begin
    placed = (placed.withColumn("sequence_id", F.get("base", "slot") + F.floor(inside / F.get("each", "slot")))
              .withColumn("turn", F.pmod(inside, F.get("each", "slot"))))
    earlier = (Window.partitionBy("sequence_id").orderBy(F.desc("class"), "turn")  # one sequence: at most `capacity` rows
               .rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).select(
        F.col("id").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        F.col("sequence_id").cast("long").alias("sequence_id"), F.col("offset").cast("long").alias("offset"),
        *(["ids"] if with_ids else []))


def _class(length: Column, capacity: int) -> Column:
    """The length, rounded up so that less than 1 in FINE is lost and there are at most FINE classes an octave."""
    out, step = length, 1
    while FINE * step < capacity:
        out = F.when(length > FINE * step, F.least(F.ceil(length / step) * step, F.lit(capacity))).otherwise(out)
        step *= 2
    return out.cast("int")


def _slots(patterns: list[Pattern]) -> list[tuple]:
    """For each class, the patterns that hold it: rank up to which (exclusive), pieces a sequence, first sequence."""
    out: dict[int, tuple[list, list, list]] = {}
    base = 0
    for p in patterns:
        for c, n in p.count.items():
            until, each, first = out.setdefault(c, ([], [], []))
            until.append((until[-1] if until else 0) + n * p.times)
            each.append(n)
            first.append(base)
        base += p.times
    return [(c, *v) for c, v in out.items()]

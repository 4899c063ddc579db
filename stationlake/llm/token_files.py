"""Token-id files: canonical length-limited Huffman codes in independent blocks.

Documents are range-partitioned by id, tokenized in that order and stored as raw
ids; Spark counts every id over all documents; the driver turns the counts (at
most one row per vocabulary entry) into code lengths by package-merge. Each
block is then coded by itself. The file format, as Parquet rows in ascending
document order:

* blocks: part, block, before (ids in earlier blocks of the part), docs (Arrow
  stream: id, ids of each document), n (ids), marks (bit offset of every
  MARK-th id, little-endian u64) and bits (the codes, first bit highest);
* codes: id and code length, for every id that occurs. Canonical codes follow
  from the lengths: ascending by (length, id).

Reading needs no other state: a block decodes alone, and the marks let all its
stretches of MARK ids be decoded side by side with a lookup table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_path
from . import textvec as tv
from .common import row_key, ship, written
from .encode import encoder, with_end
from .packing_io import batch_to_blob, blob_to_batch

BLOCK_BYTES = 2 << 20
MARK = 256
MAX_BITS = 20
_RAW = "part long, block long, before long, docs binary, n long, ids binary"
_BLOCKS = "part long, block long, before long, docs binary, n long, marks binary, bits binary"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits for positive counts (package-merge)."""
    n = len(counts)
    if n == 1:
        return np.ones(1, dtype=np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaf = counts[order].astype(np.int64)
    # each round: the merged list's weights, and how many of its first items are leaves
    items, leaves = leaf, [np.arange(n + 1)]
    for _ in range(limit - 1):
        pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaf, pairs))
        place = np.argsort(both, kind="stable")
        items = both[place]
        leaves.append(np.concatenate(([0], np.cumsum(place < n))))
    length = np.zeros(n, dtype=np.int64)
    take = 2 * n - 2
    for firsts in reversed(leaves):
        k = int(firsts[take])
        length[:k] += 1
        take = 2 * (take - k)
    out = np.empty(n, dtype=np.int64)
    out[order] = length
    return out


def canonical(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, lengths, codes) in code order."""
    order = np.lexsort((symbols, lengths))
    symbols, lengths = symbols[order], lengths[order].astype(np.int64)
    step = np.left_shift(np.int64(1), MAX_BITS - lengths)
    return symbols, lengths, (np.cumsum(step) - step) >> (MAX_BITS - lengths)


def encode_block(ids: np.ndarray, code: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(marks, bits); code and length are indexed by id."""
    bits = length[ids].astype(np.int64)
    end = np.cumsum(bits)
    at = end - bits
    word, inside = at >> 6, at & 63
    value = code[ids].astype(np.uint64)
    room = 64 - inside - bits  # negative: the code goes on in the next word
    low = np.maximum(room, 0).astype(np.uint64)
    over = np.maximum(-room, 0).astype(np.uint64)
    out = np.zeros((int(end[-1]) >> 6) + 2 if len(ids) else 1, dtype=np.uint64)
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(ids) else np.zeros(0, np.int64)
    if len(ids):
        out[word[first]] = np.bitwise_or.reduceat((value >> over) << low, first)
        cross = np.flatnonzero(over)
        out[word[cross] + 1] |= value[cross] << (np.uint64(64) - over[cross])
    return at[::MARK].astype("<u8"), out.astype(">u8").tobytes()


def decode_block(n: int, marks: np.ndarray, bits: bytes, symbol: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The ids of a block; symbol and width: table by the next MAX_BITS bits."""
    words = np.append(np.frombuffer(bits, dtype=">u8").astype(np.uint64), np.uint64(0))
    at = marks.astype(np.int64)
    out = np.zeros((len(at), MARK), dtype=np.uint32)
    last = n - (len(at) - 1) * MARK if len(at) else 0
    for j in range(MARK if len(at) > 1 else last):
        if j == last and last < MARK:
            at = at[:-1]  # the final stretch is shorter
        w, s = at >> 6, (at & 63).astype(np.uint64)
        window = (words[w] << s) | ((words[w + 1] >> np.uint64(1)) >> (np.uint64(63) - s))
        peek = (window >> np.uint64(64 - MAX_BITS)).astype(np.int64)
        out[: len(at), j] = symbol[peek]
        at = at + width[peek]
    return out.ravel()[:n]


def _raw_writer(tokenizer, end_id: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer.value)
        context = TaskContext.get()
        part, before = context.partitionId() if context else 0, 0
        for block, b in enumerate(tv.rechunk(batches, tv.text_sizes("text"), BLOCK_BYTES)):
            ids, off = with_end(*enc.encode(b.column("text")), end_id)
            docs = pa.RecordBatch.from_arrays([b.column("id").cast(id_type), pa.array(np.diff(off))], names=["id", "n"])
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int64()) for x in (part, block, before)), pa.array([batch_to_blob(docs)], pa.binary()),
                 pa.array([len(ids)], pa.int64()), pa.array([ids.astype("<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4").tobytes()], pa.binary())],
                names=["part", "block", "before", "docs", "n", "ids"])
            before += len(ids)
    return run


def _raw_ids(n: int, blob) -> np.ndarray:
    raw = memoryview(blob)
    return np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n else "<u4").astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, dtype=np.int64)
    for b in batches:
        for n, blob in zip(b.column("n").to_pylist(), b.column("ids")):
            c = np.bincount(_raw_ids(n, blob.as_buffer()), minlength=len(total))
            c[: len(total)] += total
            total = c
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])


def _block_writer(codes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, lengths, code = canonical(*codes.value)
        by_id = np.zeros((2, int(symbols.max()) + 1 if len(symbols) else 1), dtype=np.int64)
        by_id[0, symbols], by_id[1, symbols] = code, lengths
        for b in batches:
            for i, (n, blob) in enumerate(zip(b.column("n").to_pylist(), b.column("ids"))):
                marks, bits = encode_block(_raw_ids(n, blob.as_buffer()), by_id[0], by_id[1])
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(i, 1) for c in ("part", "block", "before", "docs", "n")),
                     pa.array([marks.tobytes()], pa.binary()), pa.array([bits], pa.binary())],
                    names=["part", "block", "before", "docs", "n", "marks", "bits"])
    return run


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2) -> None:
    """Writes the files of the format under path, in ascending id order (ties: by text hash).

    Null text: empty, so only the end id. Null ids come first; repeated rows are
    documents like any others; an empty table gives empty files. Other columns
    are not read.
    """
    ship(docs)
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = spark.sparkContext.broadcast(f.read())  # a vocabulary file: bounded, a few MB
    id_field = docs.schema[id_col].dataType
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                         row_key(id_col, text_col).alias("rk"))
    ordered = source.repartitionByRange("id", "rk").sortWithinPartitions("id", "rk").select("id", "text")
    raw = written(ordered.mapInArrow(_raw_writer(tokenizer, end_id, to_arrow_type(id_field)), _RAW), "ids")
    counts = raw.select("n", "ids").mapInArrow(_count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    symbols = np.array([r["id"] for r in counts], dtype=np.int64)
    lengths = code_lengths(np.array([r["n"] for r in counts], dtype=np.int64)) if counts else symbols
    codes = spark.sparkContext.broadcast((symbols, lengths))  # at most one entry a vocabulary id
    raw.mapInArrow(_block_writer(codes), _BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    spark.createDataFrame(list(zip(symbols.tolist(), lengths.tolist())), "id long, length long").coalesce(1) \
        .write.parquet(f"{path}/codes")


def _reader(codes, id_type: pa.DataType, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, lengths, code = canonical(*codes.value)
        symbol, width = np.zeros(1 << MAX_BITS, dtype=np.uint32), np.ones(1 << MAX_BITS, dtype=np.int64)
        reach = np.left_shift(np.int64(1), MAX_BITS - lengths)
        filled = int(reach.sum())
        symbol[:filled], width[:filled] = np.repeat(symbols, reach), np.repeat(lengths, reach)
        for b in batches:
            for first, blob, n, marks, bits in zip(b.column("first").to_pylist(), b.column("docs"), b.column("n").to_pylist(),
                                                   b.column("marks"), b.column("bits")):
                ids = decode_block(n, np.frombuffer(marks.as_buffer(), "<u8"), bits.as_py(), symbol, width)
                docs = blob_to_batch(blob.as_buffer())
                size = docs.column("n").to_numpy()
                end = np.cumsum(size)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(end.tolist(), size.tolist())]
                arrays = [docs.column("id").cast(id_type), pa.array(first + end - size), pa.array(size), pa.array(crc, pa.int64())]
                names = ["id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], end)).astype(np.int32)),
                                                           pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint", with_ids: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of every document in the files under path.

    start: ids of all documents before it. The parts' totals (one row a file
    part) are summed in order and broadcast; inside a part the blocks know theirs.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    ship(blocks)
    rows = spark.read.schema("id long, length long").parquet(f"{path}/codes").collect()  # bounded by the vocabulary
    codes = spark.sparkContext.broadcast((np.array([r["id"] for r in rows], dtype=np.int64),
                                          np.array([r["length"] for r in rows], dtype=np.int64)))
    totals = blocks.groupBy("part").agg(F.sum("n").alias("total"))
    earlier = totals.withColumn("base", F.coalesce(F.sum("total").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "base")
    placed = blocks.join(F.broadcast(earlier), "part").withColumn("first", F.col("base") + F.col("before"))
    out = f"id {id_type}, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    from pyspark.sql.types import _parse_datatype_string
    arrow_type = to_arrow_type(_parse_datatype_string(id_type))
    return placed.select("first", "docs", "n", "marks", "bits").mapInArrow(_reader(codes, arrow_type, with_ids), out)


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id") -> DataFrame:
    """Writes the token files of docs to the shared folder and reads them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, tokenizer_path, path, id_col)
    return read_tokens(spark, path, docs.schema[id_col].dataType.simpleString()).withColumnRenamed("id", id_col)

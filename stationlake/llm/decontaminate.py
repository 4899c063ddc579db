"""Benchmark decontamination over a positional inverted index of the training text.

`build_index` stores, for every chunk of documents (about 2 MB of text), the
sorted terms of the chunk and their postings (word positions), compressed, as a
Parquet table in the shared folder. `find` answers phrase and proximity queries
on it: it takes the global count of every query term from the stored lists, and
in each chunk starts from the postings of a query's rarest term and intersects
them with the offset-adjusted lists of the others, next rarest first. A query
whose rarest term is absent from a chunk costs one lookup there.

The queries are a stated set (the benchmark). They go to the tasks in blocks of
at most BLOCK_QUERIES, one pass over the index a block, so what is broadcast is
bounded whatever the benchmark's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textvec as tv
from .common import ship, written
from .packing_io import batch_to_blob, blob_to_batch, pack_sorted, squeeze, unpack_sorted, unsqueeze

CHUNK_BYTES = 2 << 20
BLOCK_QUERIES = 50_000
_INDEX = "chunk long, docs binary, terms binary, counts binary, positions binary"


def _planes(values: np.ndarray) -> bytes:
    return squeeze(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def _unplanes(blob, dtype) -> np.ndarray:
    raw = np.frombuffer(unsqueeze(blob), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).view(dtype).ravel()


def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    chunk = (context.partitionId() if context else 0) << 20
    for b in tv.rechunk(batches, tv.text_sizes("text"), CHUNK_BYTES):
        w = tv.words(b.column("text"), tv.symbol_separators(), lower=True)
        order = np.argsort(w.hash, kind="stable")
        h = w.hash[order]
        begin = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
        gap = order.astype(np.uint32)
        gap[1:] -= order[:-1].astype(np.uint32)
        gap[begin] = order[begin]
        docs = pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.diff(w.first))], names=["id", "n_words"])
        counts = np.diff(np.append(begin, len(h))).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([
            pa.array([chunk], pa.int64()),
            *(pa.array([x], pa.binary()) for x in (batch_to_blob(docs), pack_sorted(h[begin]), _planes(counts), _planes(gap)))],
            names=["chunk", "docs", "terms", "counts", "positions"])
        chunk += 1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index: one row a chunk. Null texts are documents without words; other columns are not read."""
    ship(docs)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return written(source.mapInArrow(_indexer, _INDEX), "postings")


class _Chunk:
    """The postings of one chunk, decoded."""

    def __init__(self, terms, counts, positions, n_words: np.ndarray) -> None:
        self.terms = unpack_sorted(terms.as_buffer(), np.uint64)
        counts = _unplanes(counts.as_buffer(), np.uint32).astype(np.int64)
        gap = _unplanes(positions.as_buffer(), np.uint32).astype(np.int64)
        self.begin = np.cumsum(counts) - counts
        self.count = counts
        total = np.cumsum(gap)
        at = total - np.repeat(total[self.begin] - gap[self.begin], counts) if len(gap) else gap
        #: term number and position of every posting, ascending
        self.key = (np.repeat(np.arange(len(counts)), counts) << 32) | at
        self.first = np.concatenate(([0], np.cumsum(n_words)))

    def rank(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term in this chunk, -1 where it is absent."""
        if not len(self.terms):
            return np.full(terms.shape, -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def candidates(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, position) of every posting of the term of each query."""
        there = np.flatnonzero(rank >= 0)
        n = self.count[rank[there]]
        return np.repeat(there, n), self.key[tv.ragged(self.begin[rank[there]], n)] & 0xFFFFFFFF

    def within(self, rank: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the term has a posting at a position from low to high."""
        at = np.searchsorted(self.key, (rank << 32) | low)
        found = self.key[np.minimum(at, len(self.key) - 1)]
        return (rank >= 0) & (at < len(self.key)) & (found <= ((rank << 32) | high)) & (high >= low)

    def match(self, terms: np.ndarray, order: np.ndarray, span: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(query, position): phrase starts, or places of the rarest term with all others within `span` words."""
        rank = self.rank(terms)
        rank[(rank < 0).any(axis=1)] = -1
        q, p = self.candidates(rank[np.arange(len(rank)), order[:, 0]])
        if span is None:
            p = p - order[q, 0]
            ok = p >= 0
            q, p = q[ok], p[ok]
        doc = np.searchsorted(self.first, p, side="right") - 1
        lo, hi = self.first[doc], self.first[doc + 1] - 1
        if span is None:
            ok = p + terms.shape[1] - 1 <= hi
            q, p, lo, hi = q[ok], p[ok], lo[ok], hi[ok]
        for j in range(1, terms.shape[1]):
            o = order[q, j]
            if span is None:
                ok = self.within(rank[q, o], p + o, p + o)
            else:
                ok = self.within(rank[q, o], np.maximum(lo, p - span), np.minimum(hi, p + span))
            q, p, lo, hi = q[ok], p[ok], lo[ok], hi[ok]
        return q, p


def _counter(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = vocabulary.value
        total = np.zeros(len(wanted), dtype=np.int64)
        for b in batches:
            for t, c in zip(b.column("terms"), b.column("counts")):
                terms, counts = unpack_sorted(t.as_buffer(), np.uint64), _unplanes(c.as_buffer(), np.uint32)
                if len(terms):
                    at = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
                    total += np.where(terms[at] == wanted, counts[at].astype(np.int64), 0)
        yield pa.RecordBatch.from_arrays([pa.array(wanted.view(np.int64)), pa.array(total)], names=["term", "n"])
    return run


def _matcher(block, span: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = block.value
        for b in batches:
            for chunk, docs, *lists in zip(*(b.column(c) for c in ("chunk", "docs", "terms", "counts", "positions"))):
                n_words = blob_to_batch(docs.as_buffer()).column("n_words").to_numpy()
                index = _Chunk(*lists, n_words)
                for keys, terms, order in groups:
                    q, p = index.match(terms, order, span)
                    if len(q):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([chunk.as_py()], pa.int64()), pa.array([terms.shape[1]], pa.int32()),
                            pa.array([squeeze(keys[q].tobytes())], pa.binary()),
                            pa.array([squeeze(p.astype(np.int64).tobytes())], pa.binary())],
                            names=["chunk", "width", "queries", "places"])
    return run


def find(index: DataFrame, queries: DataFrame, span: int | None = None) -> DataFrame:
    """Matches of queries (query long, terms array<long>) as rows (chunk, width, queries, places).

    queries and places hold, for the matches of one query length in one chunk,
    the query ids and the word positions in the chunk (int64, squeezed). span
    None: exact phrases, the place is the first word. Otherwise: every
    occurrence of a query's rarest term (ties: the first in the query) that has
    each of the other terms within `span` words in the same document.
    """
    spark = index.sparkSession
    n_blocks = max(1, math.ceil(queries.count() / BLOCK_QUERIES))
    parts = []
    for i in range(n_blocks):
        rows = queries.where(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == i).collect()
        if not rows:
            continue
        vocabulary = np.unique(np.array([t for r in rows for t in r["terms"]], dtype=np.int64).view(np.uint64))
        counts = dict(index.select("terms", "counts").mapInArrow(_counter(spark.sparkContext.broadcast(vocabulary)), "term long, n long")
                      .groupBy("term").agg(F.sum("n")).collect())
        groups = []
        for width in sorted({len(r["terms"]) for r in rows}):
            own = [r for r in rows if len(r["terms"]) == width]
            terms = np.array([r["terms"] for r in own], dtype=np.int64)
            n = np.array([[counts.get(t, 0) for t in r["terms"]] for r in own], dtype=np.int64)
            groups.append((np.array([r["query"] for r in own], dtype=np.int64), terms.view(np.uint64),
                           np.argsort(n, axis=1, kind="stable")))
        block = spark.sparkContext.broadcast(groups)
        parts.append(written(index.mapInArrow(_matcher(block, span), "chunk long, width int, queries binary, places binary"),
                             "matches"))
    if not parts:
        return spark.createDataFrame([], "chunk long, width int, queries binary, places binary")
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _windower(width: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tv.rechunk(batches, tv.text_sizes("text"), CHUNK_BYTES):
            w = tv.words(b.column("text"), tv.symbol_separators(), lower=True)
            row, query, terms = [], [], []
            for i, (a, e) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
                n = min(width, e - a)
                for s in range(a, e - n + 1 if n else a):
                    row.append(i)
                    query.append(np.uint64(tv.sequence_hash(w.hash[s : s + n])).view(np.int64).item())
                    terms.append(w.hash[s : s + n].view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("item").take(pa.array(row, pa.int64())).cast(id_type),
                                              pa.array(query, pa.int64()), pa.array(terms, pa.list_(pa.int64()))],
                                             names=["item", "query", "terms"])
    return run


def _documents(batches_key: tuple, docs: pa.Table, found: pa.Table) -> pa.Table:
    """A chunk and its matches -> its documents with their words, hit words and the windows they hold."""
    batch = blob_to_batch(docs.column("docs")[0].as_buffer())
    n_words = batch.column("n_words").to_numpy()
    first = np.concatenate(([0], np.cumsum(n_words)))
    hit = np.zeros(int(first[-1]), dtype=bool)
    doc, query = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for width, q, p in zip(*(found.column(c) for c in ("width", "queries", "places"))):
        p = np.frombuffer(unsqueeze(p.as_buffer()), np.int64)
        hit |= tv.covered(p, width.as_py(), len(hit))
        doc.append(np.searchsorted(first, p, side="right") - 1)
        query.append(np.frombuffer(unsqueeze(q.as_buffer()), np.int64))
    pair = np.unique(np.stack([np.concatenate(doc), np.concatenate(query)], axis=1), axis=0)
    ends = np.searchsorted(pair[:, 0], np.arange(len(batch) + 1)).astype(np.int32)
    total = np.concatenate(([0], np.cumsum(hit)))
    row = (batches_key[0].as_py() << 17) + np.arange(len(batch), dtype=np.int64)  # a chunk has at most 2**16 rows
    return pa.Table.from_arrays([
        pa.array(row), batch.column("id"), pa.array(n_words.astype(np.int64)),
        pa.array((total[first[1:]] - total[first[:-1]]).astype(np.int64)),
        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(pair[:, 1])))],
        names=["row", "id", "n_words", "n_hit", "windows"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", width: int = 13, share: int = 20) -> DataFrame:
    """(id, n_words, n_hit, item_ids, contaminated) a row per row of docs.

    Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. A
    window is `width` consecutive words of an item; an item of fewer words, but
    not none, is one window. A document word inside any occurrence of a window
    is hit. item_ids: the ids, as sorted strings, of items with an occurring
    window (an item without id hits but is not listed; items that share an id
    count once). contaminated: n_hit > 0 and share * n_hit >= n_words.

    Null or wordless documents have no words and are clean; null items have no
    windows; an empty benchmark leaves all documents clean; repeated documents
    are judged one by one, alike. Other columns are not read.
    """
    index = build_index(docs, id_col, text_col)
    item_type = to_arrow_type(items.schema[item_id].dataType)
    windows = written(items.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("text"))
                      .mapInArrow(_windower(width, item_type), f"item {items.schema[item_id].dataType.simpleString()}, "
                                                               "query long, terms array<long>"), "windows")
    queries = windows.groupBy("query").agg(F.first("terms").alias("terms"))
    matches = find(index, queries)
    id_type = docs.schema[id_col].dataType.simpleString()
    found = index.select("chunk", "docs").groupBy("chunk").cogroup(matches.groupBy("chunk")).applyInArrow(
        _documents, f"row long, id {id_type}, n_words long, n_hit long, windows array<long>")
    judged = written(found, "judged")
    listed = (judged.where("n_hit > 0").select("row", F.explode("windows").alias("query"))
              .join(windows.select("query", F.col("item").cast("string").alias("item")).distinct(), "query")
              .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("item_ids")))
    return judged.join(listed, "row", "left").select(
        F.col("id").alias(id_col), "n_words", "n_hit",
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's columns: the item list as count and SHA-256."""
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")

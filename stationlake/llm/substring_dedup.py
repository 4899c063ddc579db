"""Removal of word passages that occur more than once, by fixed-block anchors.

A repeat of `width` words holds, in each of its places, a whole block of
`(width + 1) // 2` words that starts at a multiple of that length in its document.
So it is enough to index the non-overlapping blocks and to probe them with
every rolling window of the block length: both places of every repeat are hit.
Hits are then extended: around each hit the windows of the full width are
compared by their hash over the whole corpus, and the windows found twice, laid
together, are the maximal exact repeats.

Data moves as compressed payloads, one per chunk of documents (about 2 MB of
text) and hash bucket:

1. chunk -> bucket: distinct hashes of the rolling windows, a flag on those that
   are blocks (31 hash bits within the bucket; a chance match costs a compare).
2. bucket -> chunk: hashes that another chunk holds too, one of them as a block.
3. chunk: windows of the full width around hits, distinct, 64-bit hash, in
   buckets by a second hash; bucket -> chunk: those that occur elsewhere.
4. chunk: words covered by such windows go.

A passage held by a third of all documents is one hash per chunk in its bucket,
so no bucket holds more than one entry a chunk for it, and no pairs are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import buckets_for, ship
from .packing_io import blob_to_batch, chunk_packer, pack_sorted, unpack_sorted

CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 1 << 20
_ENTRY = "bucket int, chunk long, mark long, entries binary, repeated binary"


def _windows(w: tv.Words, width: int, least: int) -> np.ndarray:
    """Starts of all windows of `width` words inside one text of at least `least` words."""
    n = len(w.hash)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    i = np.arange(n - width + 1)
    end = w.first[1:][w.doc[: n - width + 1]]
    begin = w.first[:-1][w.doc[: n - width + 1]]
    return i[(i + width <= end) & (end - begin >= least)]


def _split(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, rows of it in their order) for each bucket present."""
    order = np.argsort(bucket, kind="stable")
    at = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(at)).tolist():
        yield b, order[at[b] : at[b + 1]]


def _entries(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 5
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                      names=["bucket", "chunk", "mark", "entries", "repeated"])


def _place(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and the 31 hash bits kept there (shifted left by one: bit 0 is free for a flag)."""
    return (h % np.uint64(buckets)).astype(np.int32), ((h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)) ^ np.uint32(1)


def _blocks_and_probes(w: tv.Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, hash, starts a block) of the rolling windows of the block length."""
    block = (width + 1) // 2
    start = _windows(w, block, width)
    h = tv.window_hash(w.hash, block)[start]
    return start, h, (start - w.first[:-1][w.doc[start]]) % block == 0


def _probe(text: str, width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, mark, blob in zip(*(batch.column(c) for c in ("chunk", "mark", "docs"))):
                w = tv.words(blob_to_batch(blob.as_buffer()).column(text), tv.space_separators())
                _, h, is_block = _blocks_and_probes(w, width)
                bucket, bits = _place(h, buckets)
                rows = []
                for b, own in _split(bucket, buckets):
                    e = np.sort(bits[own] | is_block[own])
                    last = np.concatenate((e[1:] >> 1 != e[:-1] >> 1, [True]))  # of equal bits the flagged one is last
                    rows.append((b, chunk.as_py(), mark.as_py(), pack_sorted(e[last]), None))
                out = _entries(rows)
                del w, h, is_block, bucket, bits, rows
                tv.lean()
                yield out
    return run


def _match(table: pa.Table) -> pa.Table:
    """One bucket: for each chunk the hashes that two chunks hold, a block among them."""
    tv.lean()  # of the bucket before
    each = [unpack_sorted(x.as_buffer(), np.uint32) for x in table.column("entries")]
    both = np.sort(np.concatenate(each))
    key = both >> 1
    run = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    count = np.diff(np.append(run, len(key)))
    flagged = np.bitwise_or.reduceat(both & 1, run) if len(run) else run
    hit = key[run[(count > 1) & (flagged > 0)]]
    return _reply(table, each, lambda e: e >> 1, hit)


def _reply(table: pa.Table, each: list[np.ndarray], of, hit: np.ndarray) -> pa.Table:
    rows = []
    for b, c, m, e in zip(*(table.column(n).to_pylist() for n in ("bucket", "chunk", "mark")), each):
        k = of(e)
        at = np.searchsorted(hit, k)
        got = k[hit[np.minimum(at, len(hit) - 1)] == k] if len(hit) else k[:0]
        if len(got):
            rows.append((b, c, m, pack_sorted(got), None))
    return pa.Table.from_batches([_entries(rows)])


def _replies(table: pa.Table, mark: int) -> Iterator[tuple[int, pa.BinaryScalar]]:
    for b, m, e in zip(*(table.column(c) for c in ("bucket", "mark", "entries"))):
        if m.as_py() != mark:
            raise RuntimeError("the documents changed between two reads; give a table, not a random or unordered source")
        yield b.as_py(), e


def _isin(h: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(h), dtype=bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, h), len(sorted_values) - 1)] == h


def _wide(w: tv.Words, start: np.ndarray, width: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the full-width windows at start, and their bucket by an independent hash."""
    return (tv.window_hash(w.hash, width, seed=11)[start],
            (tv.window_hash(w.hash, width, seed=13)[start] % np.uint64(buckets)).astype(np.int32))


def _extend(text: str, width: int, buckets: int):
    """A chunk and its hits -> distinct full-width windows around the hits; repeated: those found twice in the chunk."""
    block = (width + 1) // 2

    def run(key: tuple, docs: pa.Table, found: pa.Table) -> pa.Table:
        tv.lean()  # of the chunk before
        if not len(docs):
            raise RuntimeError("a reply names a chunk that is not there: the documents changed between two reads")
        mark = docs.column("mark")[0].as_py()
        w = tv.words(blob_to_batch(docs.column("docs")[0].as_buffer()).column(text), tv.space_separators())
        start, h, is_block = _blocks_and_probes(w, width)
        hit = np.zeros(len(h), dtype=bool)
        bucket, bits = _place(h, buckets)
        by = dict(_split(bucket, buckets))
        for b, e in _replies(found, mark):
            own = by[b]
            hit[own] = _isin(bits[own] >> 1, unpack_sorted(e.as_buffer(), np.uint32))
        order = np.argsort(h, kind="stable")
        s = h[order]
        begins = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
        if len(s):
            many = (np.diff(np.append(begins, len(s))) > 1) & (np.add.reduceat(is_block[order], begins) > 0)
            hit[order] |= np.repeat(many, np.diff(np.append(begins, len(s))))
        near = np.zeros(len(w.hash) + 1, dtype=np.int32)  # window starts from which a hit lies within the window
        at = start[hit]
        np.add.at(near, np.maximum(at - (width - block), 0), 1)
        np.add.at(near, at + 1, -1)
        full = _windows(w, width, width)
        full = full[np.cumsum(near)[full] > 0]
        h, bucket = _wide(w, full, width, buckets)
        rows = []
        for b, own in _split(bucket, buckets):
            e, n = np.unique(h[own], return_counts=True)
            rows.append((b, key[0].as_py(), mark, pack_sorted(e), pack_sorted(e[n > 1])))
        return pa.Table.from_batches([_entries(rows)])
    return run


def _recur(table: pa.Table) -> pa.Table:
    """One bucket: for each chunk the windows that it holds twice or that another chunk holds too."""
    tv.lean()  # of the bucket before
    each = [unpack_sorted(x.as_buffer(), np.uint64) for x in table.column("entries")]
    twice = [unpack_sorted(x.as_buffer(), np.uint64) for x in table.column("repeated")]
    values, count = np.unique(np.concatenate(each), return_counts=True)
    hit = np.union1d(values[count > 1], np.concatenate(twice))
    return _reply(table, each, lambda e: e, hit)


def join_words(w: tv.Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    length = (w.end - w.start + 1)[keep]
    data = np.append(w.data, np.uint8(0x20))[np.minimum(tv.ragged(w.start[keep], length), len(w.data))]
    data[np.cumsum(length) - 1] = 0x20
    return _texts(data, length, w.doc[keep], len(w.first) - 1)


def cut_words(w: tv.Words, offsets: np.ndarray, keep: np.ndarray) -> pa.Array:
    """Each text without the words that go; kept words keep the white space after them."""
    nxt = np.minimum(np.append(w.start[1:], len(w.data)), offsets[1:][w.doc])
    length = (nxt - w.start)[keep]
    data = w.data[tv.ragged(w.start[keep], length)]
    # the last kept word of a text drops its trailing white space
    doc = w.doc[keep]
    final = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) if len(doc) else np.zeros(0, np.int64)
    bare = np.minimum(length, (w.end - w.start)[keep])
    shorter = length.copy()
    shorter[final] = bare[final]
    begin = np.cumsum(length) - length
    return _texts(data[tv.ragged(begin, shorter)], shorter, doc, len(w.first) - 1, strip=0)


def _texts(data: np.ndarray, length: np.ndarray, doc: np.ndarray, n: int, strip: int = 1) -> pa.Array:
    """Texts from the pieces of their words; strip: bytes to leave out at each end."""
    size = np.bincount(doc, weights=length, minlength=n).astype(np.int64) if len(doc) else np.zeros(n, np.int64)
    ends = np.cumsum(size)
    begin = ends - size
    size = np.maximum(size - strip, 0)
    data = data[tv.ragged(begin, size)] if strip else data
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _finish(text: str, width: int, buckets: int):
    def run(key: tuple, docs: pa.Table, found: pa.Table) -> pa.Table:
        tv.lean()  # of the chunk before
        if not len(docs):
            raise RuntimeError("a reply names a chunk that is not there: the documents changed between two reads")
        batch = blob_to_batch(docs.column("docs")[0].as_buffer())
        column = batch.column(text)
        w = tv.words(column, tv.space_separators())
        gone = np.zeros(len(w.hash), dtype=bool)
        replies = list(_replies(found, docs.column("mark")[0].as_py()))
        if replies:
            full = _windows(w, width, width)
            h, bucket = _wide(w, full, width, buckets)
            again = np.zeros(len(full), dtype=bool)
            by = dict(_split(bucket, buckets))
            for b, e in replies:
                again[by[b]] = _isin(h[by[b]], unpack_sorted(e.as_buffer(), np.uint64))
            gone = tv.covered(full[again], width, len(w.hash))
        removed = np.bincount(w.doc[gone], minlength=len(batch)).astype(np.int64)
        _, offsets = tv.string_bytes(column)
        cut = cut_words(w, offsets, ~gone)
        import pyarrow.compute as pc
        new = pc.if_else(pa.array(removed > 0), cut.cast(pa.string()), column.cast(pa.string()))
        arrays = [new if n == text else batch.column(n) for n in batch.schema.names]
        return pa.Table.from_arrays(
            [*arrays, pa.array(np.diff(w.first)), pa.array(removed), join_words(w, ~gone).cast(pa.string())],
            names=[*batch.schema.names, "repeat n_words", "repeat n_removed", "repeat kept"])
    return run


def remove_repeats(docs: DataFrame, text_col: str = "text", width: int = 35) -> DataFrame:
    """docs with, in place of its text, the text without words that lie in a repeated window.

    A window is `width` consecutive words of one document; it is repeated if its
    word sequence also starts anywhere else, in the same document or another.
    Windows are judged on the input. Added columns: `repeat n_words`, `repeat
    n_removed` (words) and `repeat kept` (the kept words joined by one space).
    The text of a document that loses nothing is unchanged, a null text stays
    null with 0 words; texts of fewer than `width` words lose nothing; repeated
    rows are repeats of each other. Other columns pass through, but for those
    that have the name of an added column, which takes their place. Empty input gives no rows. docs is read more than once and must give
    the same rows in the same partitions each time, as a table does.
    """
    ship(docs)
    docs = docs.drop("repeat n_words", "repeat n_removed", "repeat kept")
    buckets = buckets_for(docs, BUCKET_BYTES)
    packed = docs.mapInArrow(chunk_packer(text_col, CHUNK_BYTES), "chunk long, mark long, docs binary")
    pack, probe = chunk_packer(text_col, CHUNK_BYTES), _probe(text_col, width, buckets)
    probes = docs.mapInArrow(lambda batches: probe(pack(batches)), _ENTRY)  # one worker a task instead of two
    hits = probes.groupBy("bucket").applyInArrow(_match, _ENTRY)
    by_chunk = packed.groupBy("chunk")
    wide = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(_extend(text_col, width, buckets), _ENTRY)
    again = wide.groupBy("bucket").applyInArrow(_recur, _ENTRY)
    out = T.StructType([*docs.schema.fields, T.StructField("repeat n_words", T.LongType()),
                        T.StructField("repeat n_removed", T.LongType()), T.StructField("repeat kept", T.StringType())])
    return by_chunk.cogroup(again.groupBy("chunk")).applyInArrow(_finish(text_col, width, buckets), out)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 35) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of each document."""
    r = remove_repeats(docs.select(id_col, text_col), text_col, width)
    return r.select(id_col, F.col("repeat n_words").alias("n_words"), F.col("repeat n_removed").alias("n_removed"),
                    F.sha2(F.col("repeat kept"), 256).alias("kept_sha256"))

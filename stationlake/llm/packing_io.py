"""Compact binary values that the operators pass through Spark shuffles.

A task sends one row per (chunk of documents, hash bucket) instead of one row
per word; the row's payload is one of the forms below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from . import textvec as tv

_ZSTD = None


def _zstd() -> pa.Codec:
    global _ZSTD
    if _ZSTD is None:
        _ZSTD = pa.Codec("zstd", compression_level=1)
    return _ZSTD


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + _zstd().compress(raw, asbytes=True)


def unsqueeze(blob) -> bytes:
    blob = memoryview(blob)
    n = int.from_bytes(blob[:8], "little")
    return _zstd().decompress(blob[8:], n, asbytes=True) if n else b""


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as differences, byte plane by byte plane, compressed."""
    d = values.copy()
    d[1:] -= values[:-1]
    return squeeze(np.ascontiguousarray(d.view(np.uint8).reshape(len(d), d.itemsize).T).tobytes())


def unpack_sorted(blob, dtype) -> np.ndarray:
    raw = np.frombuffer(unsqueeze(blob), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    d = np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).view(dtype).ravel()
    return np.cumsum(d, dtype=dtype)


def batch_to_blob(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def blob_to_batch(blob) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(pa.py_buffer(memoryview(blob)))))


def chunk_packer(size_column: str, limit: int):
    """mapInArrow body: rows -> (chunk, mark, docs): the rows of each chunk of about `limit` bytes as one blob.

    chunk names the chunk by its partition and place there, so it is the same
    each time the input is read; mark is taken from the content and lets a later
    step notice an input that changed between reads.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        at = (context.partitionId() if context else 0) << 32
        for b in tv.rechunk(batches, tv.text_sizes(size_column), limit):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([_mark(b, size_column)], pa.int64()),
                                              pa.array([batch_to_blob(b)], pa.binary())],
                                             names=["chunk", "mark", "docs"])
            at += 1
    return run


def _mark(batch: pa.RecordBatch, column: str) -> int:
    data, offsets = tv.string_bytes(batch.column(column))
    h = tv.range_hash(data, offsets[:-1], offsets[1:])
    return np.uint64(tv.combine([h])).view(np.int64).item()

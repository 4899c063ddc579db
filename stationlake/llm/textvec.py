"""Vectorised word and window hashing over Arrow string arrays.

Helpers for the tasks of the operators in this folder. A task sees an Arrow
array of texts; everything is computed on the concatenated UTF-8 bytes with
numpy, so no Python object is made per word. Words are maximal runs of bytes
that are not separators. Separators are ASCII, so byte rules and code-point
rules agree on UTF-8 text.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MASK = (1 << 64) - 1


#: Resident bytes of a worker above which freed memory is handed back.
LEAN_BYTES = 240 << 20
try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def lean(above: int = LEAN_BYTES) -> None:
    """Hand freed memory back to the system if the worker has grown beyond so many resident bytes.

    Arrow's pool and the C allocator keep what is freed; workers are used again
    by later tasks and stages, so without this each keeps its largest chunk ever.
    """
    try:
        with open("/proc/self/statm") as f:
            resident = int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")
    except OSError:
        resident = above + 1
    if resident > above:
        pa.default_memory_pool().release_unused()
        if _trim is not None:
            _trim(0)


def splitmix(x: int) -> int:
    """One splitmix64 output for the integer state x (all 64-bit constants come from this rule)."""
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


def constants(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit constants."""
    return np.array([splitmix(seed * 1_000_003 + i) | 1 for i in range(n)], dtype=U64)


BYTE_VALUE = constants(1, 256)
_BASE = int(constants(2, 1)[0])
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64, grown by doubling and kept per process."""
    t = _powers.get(base)
    if t is None or len(t) < n:
        size = max(1 << 16, 1 << max(0, n - 1).bit_length())
        t = np.full(size, base, dtype=U64)
        t[0] = 1
        t = np.multiply.accumulate(t)
        if size <= 1 << 23:
            _powers[base] = t
    return t[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, element-wise."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def space_separators() -> np.ndarray:
    """Separator table of words `[^\\x20\\x09-\\x0D]+`."""
    t = np.zeros(256, dtype=bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def symbol_separators() -> np.ndarray:
    """Separator table of words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` (after lower-casing A-Z)."""
    t = np.zeros(256, dtype=bool)
    for a, b in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
        t[a : b + 1] = True
    return t


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def string_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks() if arr.num_chunks != 1 else arr.chunk(0)
    if arr.null_count:
        arr = arr.fill_null("")
    if not pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    if len(arr) == 0 or arr.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(arr) + 1, dtype=np.int64)
    data = np.frombuffer(arr.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of an array of texts, in order.

    data: the bytes (lower-cased if asked); start, end: byte range of each word;
    doc: text number of each word; first: first word of each text, with the
    total at the end; hash: 64-bit hash of each word's bytes.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words; a word never crosses the end of a text."""
    inside = ~separators[data]
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range data[start:end] (equal bytes, equal hash)."""
    n = len(data)
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(BYTE_VALUE[data] * _power_table(_BASE, n), out=total[1:])
    h = (total[end] - total[start]) * _power_table(_BASE_INV, n + 1)[start]
    return mix(h + (end - start).astype(U64) * U64(0x9E3779B97F4A7C15))


def words(arr: pa.Array, separators: np.ndarray, lower: bool = False) -> Words:
    data, offsets = string_bytes(arr)
    if lower:
        data = LOWER[data]
    start, end = spans(data, offsets, separators)
    first = np.searchsorted(start, offsets).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(first))
    return Words(data, start, end, doc, first, range_hash(data, start, end))


def window_hash(h: np.ndarray, width: int, seed: int = 7) -> np.ndarray:
    """Hash of every `width` consecutive words: element i covers words i .. i+width-1."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    c = constants(seed, width)
    out = h[:n] * c[0]
    for j in range(1, width):
        out += h[j : j + n] * c[j]
    return mix(out)


def sequence_hash(h: np.ndarray, seed: int = 7) -> int:
    """Hash of a whole word sequence, equal to window_hash of that width."""
    return int(window_hash(h, len(h), seed)[0]) if len(h) else 0


def combine(arrays: Iterable[np.ndarray]) -> int:
    """Order-dependent 64-bit key of some integer arrays."""
    key = np.zeros(1, dtype=U64)
    for a in arrays:
        a = np.asarray(a).astype(np.int64).view(U64)
        key = mix(key * U64(0x9E3779B97F4A7C15) + U64(len(a)))
        if len(a):
            part = mix(a.copy()) * _power_table(_BASE, len(a))
            key = mix(key + np.sum(part, dtype=U64, keepdims=True))
    return int(key[0])


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask over n words: those within `width` words from any of the window starts."""
    d = np.zeros(n + 1, dtype=np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + width, n), -1)
    return np.cumsum(d[:-1]) > 0


def rechunk(batches: Iterable[pa.RecordBatch], size_of: Callable[[pa.RecordBatch], np.ndarray],
            limit: int) -> Iterator[pa.RecordBatch]:
    """Row groups of about `limit` bytes by the given row sizes (a larger row stands alone).

    The groups depend on the rows and their order only, not on how they were batched.
    """
    held: list[pa.RecordBatch] = []
    total = 0
    for b in batches:
        sizes = size_of(b)
        at = 0
        for i, s in enumerate(sizes.tolist()):
            if total and total + s > limit:
                held.append(b.slice(at, i - at))
                yield _joined(held)
                held, total, at = [], 0, i
                lean()
            total += s
        held.append(b.slice(at))
    if sum(len(b) for b in held):
        yield _joined(held)
    held.clear()
    lean()


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    parts = [p for p in parts if len(p)]
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def text_sizes(column: str) -> Callable[[pa.RecordBatch], np.ndarray]:
    """Row sizes for rechunk: bytes of a text column plus a constant per row."""
    def of(b: pa.RecordBatch) -> np.ndarray:
        import pyarrow.compute as pc
        n = pc.fill_null(pc.binary_length(b.column(column)), 0)
        return n.to_numpy(zero_copy_only=False).astype(np.int64) + 64
    return of


def ragged(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices first[i] .. first[i]+length[i]-1, one run after another."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    at = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(first - at, length)

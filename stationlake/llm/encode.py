"""Token ids of whole texts with the tokenizers library, each distinct segment once per worker.

A text is cut where no supported tokenizer can merge or look across: before a
white-space run that follows a non-space character, and between an ASCII letter
and a following punctuation mark. Pre-tokenizers of the byte-level and word
kinds match from left to right without looking back, and their tokens never
span such a place, so the ids of a text are the ids of its segments, joined.
Segments repeat a lot; their ids are kept in a table per worker, looked up by
64-bit hash. Frequent segments are found in a small direct-mapped copy of it,
so that only the others of a chunk are sorted.
"""

from __future__ import annotations

import hashlib
import os
from itertools import chain

import numpy as np
import pyarrow as pa

from . import textvec as tv

#: Bytes of segments and ids that a worker keeps; beyond that it starts anew (this bounds memory and never changes a result).
KEPT_BYTES = 32 << 20
#: Slots of the copy, by the highest bits of a hash (16 bytes each; the segment seen last has the slot).
SLOT_BITS = 18

_SPACE = tv.space_separators()
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in ".,;:!?)('\"#$%&*"]] = True  # without the characters of special-token strings

_encoders: dict[str, Encoder] = {}


def _after_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each position is white space outside ASCII (fixed values: UTF-8 of those characters)."""
    padded = np.concatenate((np.zeros(3, np.uint8), data))
    a, b, c = padded[at], padded[at + 1], padded[at + 2]  # the three bytes before
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    three = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | (
        (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F))))
    return two | three


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the segments, first segment of each text with the total at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    cut = np.zeros(n, dtype=bool)
    cut[1:] = (space[1:] & ~space[:-1] & (data[:-1] >= 0x20)) | (_LETTER[data[:-1]] & _MARK[data[1:]])
    at = np.flatnonzero(cut)
    wide = at[data[at - 1] >= 0x80]
    cut[wide[_after_wide_space(data, wide)]] = False
    begin = offsets[:-1]
    cut[begin[np.diff(offsets) > 0]] = True
    start = np.flatnonzero(cut)
    return start, np.searchsorted(start, offsets)


class Encoder:
    """Encodes arrays of texts; json is the content of the tokenizer's file."""

    def __init__(self, json: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._reset()

    def _reset(self) -> None:
        self.hash = np.zeros(0, dtype=np.uint64)
        self.first = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(1 << 20, dtype=np.uint32)
        self.used = 0
        self.slot_hash = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
        self.slot_hash[0] = ~np.uint64(0)  # the hash of another slot: an unused slot matches nothing
        self.slot_first = np.zeros(1 << SLOT_BITS, dtype=np.int32)
        self.slot_length = np.zeros(1 << SLOT_BITS, dtype=np.int32)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        length = np.fromiter(map(len, found), np.int64, len(found))
        total = int(length.sum())
        if self.used + total > len(self.ids):
            grown = np.zeros(max(2 * len(self.ids), self.used + total), dtype=np.uint32)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        at = np.searchsorted(self.hash, hashes)
        first = self.used + np.cumsum(length) - length
        self.hash = np.insert(self.hash, at, hashes)
        self.first = np.insert(self.first, at, first)
        self.length = np.insert(self.length, at, length)
        self.used += total

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids)."""
        data, offsets = tv.string_bytes(texts)
        start, text_first = segments(data, offsets)
        end = np.append(start[1:], len(data))
        hashes = tv.range_hash(data, start, end)
        slots = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        rest = np.flatnonzero(self.slot_hash[slots] != hashes)
        distinct, example, inverse = np.unique(hashes[rest], return_index=True, return_inverse=True)
        if 24 * (len(self.hash) + len(distinct)) + 4 * self.used > KEPT_BYTES:
            self._reset()
            rest = np.arange(len(hashes))
            distinct, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        example = rest[example]
        at = np.searchsorted(self.hash, distinct)
        new = np.ones(len(distinct), dtype=bool)
        if len(self.hash):
            new = self.hash[np.minimum(at, len(self.hash) - 1)] != distinct
        raw = data.tobytes()
        for part in np.array_split(np.flatnonzero(new), max(1, int(new.sum()) // 20_000)):
            if len(part):
                places = example[part]
                self._learn(distinct[part], [raw[a:b].decode() for a, b in zip(start[places].tolist(), end[places].tolist())])
        at = np.searchsorted(self.hash, distinct)
        first, length = self.slot_first[slots].astype(np.int64), self.slot_length[slots].astype(np.int64)
        if len(distinct):
            first[rest], length[rest] = self.first[at][inverse], self.length[at][inverse]
            slot = (distinct >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            last = np.flatnonzero(np.concatenate((slot[1:] != slot[:-1], [True])))  # one a slot: they are sorted
            slot, at = slot[last], at[last]
            self.slot_hash[slot], self.slot_first[slot], self.slot_length[slot] = distinct[last], self.first[at], self.length[at]
        ids = self.ids[tv.ragged(first, length)]
        return ids, np.concatenate(([0], np.cumsum(length)))[text_first]


def encoder(json: str) -> Encoder:
    """The worker's encoder for a tokenizer; kept between tasks."""
    key = hashlib.sha256(json.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(json)
    return _encoders[key]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Appends end_id to the ids of each text."""
    n = len(offsets) - 1
    out = np.insert(ids, offsets[1:], np.uint32(end_id))
    return out, offsets + np.arange(n + 1)

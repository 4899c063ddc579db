"""Token counts by a finite-state transducer compiled from a byte-level BPE vocabulary.

Inside a pre-token the tokens that BPE has settled on so far form the state, and
each byte moves to the next state and changes the number of emitted tokens by a
fixed amount (a merge takes tokens back, so it can be negative). What can still
change the tokens lies in the longest suffix that begins some token, so a state
is: that suffix, and for each of its places the token that ends there and its
count. States are found and their transitions compiled when they are first met;
from then on a byte costs one table lookup.

The pre-tokenizer's rule is a set of places where the transducer returns to its
first state. Texts are cut into chunks of LANE bytes, and all chunks of a batch
advance side by side. A chunk's state map (state at its start -> state at its end,
tokens) is constant behind its first such place, so this part runs at once for
all chunks. The maps compose from left to right: the parts before the first
place run from the states that the chunks to the left end in. Chunks without
such a place (inside one long pre-token) run from assumed states, and again
where composition gives another state, until nothing changes.
"""

from __future__ import annotations

import hashlib
import json as jsonlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textvec as tv
from .common import ship

CHUNK_BYTES = 2 << 20
LANE = 256
#: States that a worker keeps; beyond that it compiles anew (this bounds memory and never changes a result).
KEPT_STATES = 300_000

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_classes: np.ndarray | None = None
_transducers: dict[str, Transducer] = {}


def char_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number, other."""
    global _classes
    if _classes is None:
        t = np.full(0x110000, OTHER, dtype=np.uint8)
        for c in range(0x110000):
            k = unicodedata.category(chr(c))[0]
            if k == "L":
                t[c] = LETTER
            elif k == "N":
                t[c] = NUMBER
        # fixed values: the characters with the property White_Space
        t[[*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
        _classes = t
    return _classes


def byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in byte-level vocabularies -> the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def pretoken_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mask of the bytes at which a pre-token starts, by the rule of the vocabulary family:
    contractions, letters, numbers or other characters with an optional space before, white space."""
    n = len(data)
    starts = np.zeros(n, dtype=bool)
    if not n:
        return starts
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    padded = np.concatenate((data, np.zeros(4, np.uint8))).astype(np.uint32)
    b0, b1, b2, b3 = (padded[lead + i] for i in range(4))
    code = np.where(b0 < 0x80, b0, np.where(
        b0 < 0xE0, (b0 & 0x1F) << 6 | b1 & 0x3F, np.where(
            b0 < 0xF0, (b0 & 0x0F) << 12 | (b1 & 0x3F) << 6 | b2 & 0x3F,
            (b0 & 0x07) << 18 | (b1 & 0x3F) << 12 | (b2 & 0x3F) << 6 | b3 & 0x3F)))
    kind = char_classes()[np.minimum(code, 0x10FFFF)]
    m = len(lead)
    first = np.zeros(m + 1, dtype=bool)  # first character of a text
    at = offsets[:-1][np.diff(offsets) > 0]
    first[np.searchsorted(lead, at)] = True
    first[m] = True
    before = np.concatenate(([OTHER], kind[:-1]))
    after = np.concatenate((kind[1:], [OTHER]))
    space = kind == SPACE
    last_space = space & ~first[1:] & (after != SPACE)  # the last of a white-space run before something else
    attaches = last_space & (code == 0x20)
    mark = first[:-1] | (before != kind) | last_space
    mark[1:] &= ~(attaches[:-1] & ~first[1:-1])
    # contractions: an apostrophe at which a match starts, and what comes after the letters
    quote = np.flatnonzero((code == 0x27) & mark)
    if len(quote):
        ends = np.searchsorted(lead, offsets[1:])[np.searchsorted(offsets, lead[quote], side="right") - 1]
        wide = np.concatenate((code, [0, 0, 0]))
        c1 = np.where(quote + 1 < ends, wide[quote + 1], 0)
        c2 = np.where(quote + 2 < ends, wide[quote + 2], 0)
        one = np.isin(c1, [ord(c) for c in "stmd"])
        two = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l")))
        size = np.where(one, 2, np.where(two, 3, 0))
        quote, size = quote[size > 0], size[size > 0]
        mark[quote + 1] = False
        nxt = quote + size
        nxt = nxt[nxt < m]
        mark[nxt] = np.where(kind[nxt] == SPACE, mark[nxt], True)
    starts[lead] = mark
    return starts


class Transducer:
    """The compiled automaton of one byte-level BPE vocabulary."""

    def __init__(self, json: str) -> None:
        spec = jsonlib.loads(json)
        alphabet = byte_alphabet()
        as_bytes = {t: bytes(alphabet[c] for c in t) for t in spec["model"]["vocab"] if all(c in alphabet for c in t)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for i, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[as_bytes[a], as_bytes[b]] = i
        made = {a + b for a, b in self.rank}
        self.tokens = made | {bytes([b]) for b in range(256)}
        self.begins = {t[:i] for t in made for i in range(1, len(t))}
        self.joint: dict[tuple[bytes, bytes], bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = (b"", (None,), (0,))
        self.ids = {start: 0}
        self.states = [start]
        self.column = np.full(256, -1, dtype=np.int16)  # table column of each byte met so far
        self.byte: list[int] = []
        self.next = np.full((4096, 32), -1, dtype=np.int32)
        self.emit = np.zeros((4096, 32), dtype=np.int8)

    def _resize(self, rows: int, columns: int) -> None:
        old = self.next, self.emit
        self.next = np.full((rows, columns), -1, dtype=np.int32)
        self.emit = np.zeros((rows, columns), dtype=np.int8)
        for new, was in zip((self.next, self.emit), old):
            new[: was.shape[0], : was.shape[1]] = was

    def _columns(self, data: np.ndarray) -> np.ndarray:
        """Table columns of the bytes; new bytes get the next ones."""
        for b in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
            if self.column[b] < 0:
                self.column[b] = len(self.byte)
                self.byte.append(b)
        if len(self.byte) > self.next.shape[1]:
            self._resize(len(self.next), min(256, len(self.byte) + 16))
        return self.column.astype(np.uint8)[data]

    def bpe(self, word: bytes) -> list[bytes]:
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranked = [(self.rank.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            r, _ = min(ranked)
            if r == 1 << 60:
                break
            merged, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and self.rank.get((parts[i], parts[i + 1])) == r:
                    merged.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def _neighbours(self, a: bytes, b: bytes) -> bool:
        """Whether BPE leaves token b next to token a as they are."""
        ok = self.joint.get((a, b))
        if ok is None:
            ok = self.joint[a, b] = self.bpe(a + b) == [a, b]
        return ok

    def compile(self, state: int, column: int) -> None:
        """Fills in one transition."""
        suffix, last, count = self.states[state]
        text = suffix + bytes([self.byte[column]])
        for j in range(len(text)):  # the one token that ends here: longest first
            token = text[j:]
            if token in self.tokens and (last[j] is None or self._neighbours(last[j], token)):
                break
        here = count[j] + 1
        last, count = (*last, token), (*count, here)
        i = 0
        while i < len(text) and text[i:] not in self.begins:
            i += 1
        key = (text[i:], last[i:], tuple(c - here for c in count[i:]))
        to = self.ids.get(key)
        if to is None:
            to = self.ids[key] = len(self.states)
            self.states.append(key)
            if to >= len(self.next):
                self._resize(len(self.next) * 3 // 2, self.next.shape[1])
        self.next[state, column] = to
        self.emit[state, column] = here - self.states[state][2][-1]

    def run(self, columns: np.ndarray, reset: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Moves all stretches start:end side by side; (states at their ends, tokens emitted)."""
        order = np.argsort(start - end, kind="stable")
        at, length = start[order], (end - start)[order]
        now, total = state[order].astype(np.int32), np.zeros(len(order), dtype=np.int64)
        live = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
        for j, k in enumerate(live.tolist()):
            place = at[:k] + j
            byte = columns[place]
            s = np.where(reset[place], np.int32(0), now[:k])
            to = self.next[s, byte]
            if to.min() < 0:
                new = to < 0
                for x in np.unique(s[new].astype(np.int64) << 8 | byte[new]).tolist():
                    self.compile(x >> 8, x & 255)
                to = self.next[s, byte]
            total[:k] += self.emit[s, byte]
            now[:k] = to
        out_state, out_total = np.empty_like(now), np.empty_like(total)
        out_state[order], out_total[order] = now, total
        return out_state, out_total

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; null: 0."""
        texts, owner, extra = self._without_specials(texts)
        if len(self.states) > KEPT_STATES:
            self._reset()
        data, offsets = tv.string_bytes(texts)
        out = extra
        if not len(data):
            return out
        reset = pretoken_starts(data, offsets)
        columns = self._columns(data)
        pieces = -(-np.diff(offsets) // LANE)
        text = np.repeat(np.arange(len(pieces)), pieces)
        start = offsets[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * LANE
        end = np.minimum(start + LANE, offsets[1:][text])
        places = np.append(np.flatnonzero(reset), len(data))
        first = places[np.searchsorted(places, start)]
        has = first < end
        state, tokens = np.zeros(len(start), dtype=np.int32), np.zeros(len(start), dtype=np.int64)
        state[has], tokens[has] = self.run(columns, reset, first[has], end[has], state[has])
        # the state maps of chunks inside one long pre-token, composed until the states at the seams agree
        inner = np.flatnonzero(~has)
        begin = np.zeros(len(inner), dtype=np.int32)
        todo = np.arange(len(inner))
        while len(todo):
            lanes = inner[todo]
            state[lanes], tokens[lanes] = self.run(columns, reset, start[lanes], end[lanes], begin[todo])
            true = state[inner - 1]
            todo = np.flatnonzero(true != begin)
            begin[todo] = true[todo]
        head = np.flatnonzero(has & (first > start))
        _, more = self.run(columns, reset, start[head], first[head], state[head - 1])
        tokens[head] += more
        np.add.at(out, owner[text], tokens)
        return out

    def _without_specials(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Texts cut at special-token strings, the text that each piece is of, and the special tokens of each text."""
        import pyarrow.compute as pc
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        n = len(texts)
        holds = np.zeros(n, dtype=bool)
        for s in self.special:
            holds |= pc.fill_null(pc.match_substring(texts, s), False).to_numpy(zero_copy_only=False)
        extra = np.zeros(n, dtype=np.int64)
        if not holds.any():
            return texts, np.arange(n), extra
        pieces, owner = [], []
        for i, t in enumerate(texts.to_pylist()):
            parts = [t or ""]
            for s in sorted(self.special, key=len, reverse=True) if holds[i] else ():
                split = [p.split(s) for p in parts]
                extra[i] += sum(len(p) - 1 for p in split)
                parts = [x for p in split for x in p]
            pieces += parts
            owner += [i] * len(parts)
        return pa.array(pieces, pa.large_string()), np.array(owner), extra


def transducer(json: str) -> Transducer:
    """The worker's transducer of a vocabulary; kept between tasks."""
    key = hashlib.sha256(json.encode()).hexdigest()
    if key not in _transducers:
        _transducers.clear()
        _transducers[key] = Transducer(json)
    return _transducers[key]


def _counter(tokenizer, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(tokenizer.value)
        for b in tv.rechunk(batches, tv.text_sizes("text"), CHUNK_BYTES):
            _, offsets = tv.string_bytes(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("id").cast(id_type), pa.array(np.diff(offsets)), pa.array(t.count(b.column("text")))],
                                             names=["id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of docs.

    n_tokens: as the tokenizer of the file gives, without begin and end tokens;
    strings of its special tokens inside a text are such tokens. over_limit:
    n_tokens > limit. Null and empty texts have 0 bytes and tokens; repeated
    rows and null ids pass like any others; other columns are not read. No
    shuffle: each row is counted where it is read.
    """
    ship(docs)
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: bounded, a few MB
    id_field = docs.schema[id_col].dataType
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = source.mapInArrow(_counter(tokenizer, to_arrow_type(id_field)), f"id {id_field.simpleString()}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

"""Periodic runs of words, found by a sparse dynamic program over the diagonals of a text.

Diagonal q of a text compares each word with the one q places before it. The
program walks over the words once; the diagonals on which the last word matched
are active, each with its match length. A word's earlier occurrences lengthen
active diagonals by one or start new ones; a diagonal without a match at a word
ends there and emits its run at once, if it is long enough.

Which earlier occurrences count keeps the program sparse. A run of period q that
repeats three times has a match of at least 2q words, so the window of W words
that ends at a word of the match, W being the power of two with W/2 < q <= W,
occurs q places earlier, and nowhere nearer, or the run would have a smaller
period. So for each W a word has one earlier occurrence, the nearest one of the
window that ends there, and it counts if its lag is in (W/2, W]. A text of one
repeated word has one active diagonal, and a common word costs nothing.

Words and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textvec as tv
from .common import ship
from .substring_dedup import join_words

CHUNK_BYTES = 2 << 20
RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def least_match(min_words: int, min_repeats: int) -> int:
    """Words that every run's diagonal matches, whatever its period."""
    return min(max(min_words - q, (min_repeats - 1) * q) for q in range(1, max(2, min_words)))


def _repeating(w: tv.Words, width: int) -> np.ndarray:
    """Numbers of the texts in which some window of `width` words occurs twice; no other text has a run."""
    n = len(w.hash) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    inside = w.doc[:n] == w.doc[width - 1 :]
    doc = w.doc[:n][inside]
    h = tv.mix(tv.window_hash(w.hash, width)[inside] + doc.astype(np.uint64) * tv.constants(21, 1)[0])
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(0, dtype=np.int64)
    return np.unique(doc[twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h])


def _earlier(h: np.ndarray, min_repeats: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, lag, W) of the earlier occurrences that count, in order of the words of one text."""
    words, lags, sizes = [], [], []
    window, size = h, 1
    while min_repeats * (size // 2 + 1) <= len(h) and len(window) > size // 2:
        order = np.argsort(window, kind="stable")
        same = window[order[1:]] == window[order[:-1]]
        lag = (order[1:] - order[:-1])[same]
        at = order[1:][same]
        fits = (lag > size // 2) & (lag <= size)
        words.append(at[fits] + size - 1)
        lags.append(lag[fits])
        sizes.append(np.full(int(fits.sum()), size))
        if len(window) <= size:
            break
        c = tv.constants(30 + size.bit_length(), 2)
        window = tv.mix(window[:-size] * c[0] + window[size:] * c[1])
        size *= 2
    if not words:
        return (np.zeros(0, np.int64),) * 3
    at = np.concatenate(words)
    order = np.argsort(at, kind="stable")
    return at[order], np.concatenate(lags)[order], np.concatenate(sizes)[order]


def runs_of(h: np.ndarray, min_words: int = 24, min_repeats: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text, given a hash a word, by start and period."""
    found: list[tuple[int, int, int]] = []

    def emit(last: int, ended) -> None:
        for lag, match in ended:
            length = match + lag
            if length >= min_words and length >= min_repeats * lag:
                found.append((last - length + 1, length, lag))

    active: dict[int, int] = {}  # lag -> match length up to the word before
    extended: dict[int, int] = {}
    now = -1
    for word, lag, size in zip(*(x.tolist() for x in _earlier(h, min_repeats))):
        if word != now:
            if len(extended) < len(active) or active.keys() - extended.keys():
                emit(now - 1, [(q, m) for q, m in active.items() if q not in extended])
            active, extended = extended, {}
            if word != now + 1:
                emit(now, active.items())
                active = {}
            now = word
        extended[lag] = active.get(lag, size - 1) + 1
    emit(now - 1, [(q, m) for q, m in active.items() if q not in extended])
    emit(now, extended.items())
    found.sort(key=lambda r: (r[0], r[2]))
    return found


def _finder(min_words: int, min_repeats: int, id_type: pa.DataType):
    width = least_match(min_words, min_repeats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tv.rechunk(batches, tv.text_sizes("text"), CHUNK_BYTES):
            w = tv.words(b.column("text"), tv.space_separators())
            runs: list[list[dict]] = [[] for _ in range(len(b))]
            keep = np.ones(len(w.hash), dtype=bool)
            for d in _repeating(w, width).tolist():
                first = int(w.first[d])
                for start, length, period in runs_of(w.hash[first : w.first[d + 1]], min_words, min_repeats):
                    runs[d].append({"start": start, "length": length, "period": period})
                    keep[first + start + period : first + start + length] = False
            yield pa.RecordBatch.from_arrays(
                [b.column("id").cast(id_type), pa.array(np.diff(w.first)), pa.array(runs, pa.list_(_RUN)),
                 join_words(w, keep).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 24,
              min_repeats: int = 3) -> DataFrame:
    """(id, n_words, runs, collapsed), a row per row of docs.

    Words are maximal stretches without white space (ASCII). A run is a stretch
    of at least `min_words` words whose smallest period q fits `min_repeats`
    times or more and that neither neighbouring word extends with that period;
    runs holds (start, length, period) by start, then period, words numbered
    from 0. collapsed: the words left, joined by one space, when each run keeps
    its first q words only; a word that one run keeps and another drops goes.

    min_repeats is 3 at least (ValueError else). Null or empty text: 0 words,
    no runs, empty collapsed. Null and repeated ids pass through; each row is
    judged alone, so ties and repeated rows need no rule. Other columns are not
    read, whatever their names. Empty input gives no rows. One text is held by
    one task, whole.
    """
    if min_repeats < 3:
        raise ValueError("min_repeats must be 3 or more")
    ship(docs)
    kind = docs.schema[id_col].dataType
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return source.mapInArrow(_finder(min_words, min_repeats, to_arrow_type(kind)),
                             f"id {kind.simpleString()}, n_words long, runs array<{RUN}>, collapsed string")


def plant_tail(words: list[bytes], doc_id: int) -> list[bytes]:
    """The words of a document, with a periodic tail if the contract's rule picks its id."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _planter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, texts = b.column("id").to_pylist(), b.column("text")
        at = [i for i, d in enumerate(ids) if d is not None and texts[i].is_valid and zlib.crc32(str(d).encode()) % 10 == 0]
        if at:
            new = [b" ".join(plant_tail(texts[i].as_py().encode().split(), ids[i])).decode() for i in at]
            mask = np.zeros(len(b), dtype=bool)
            mask[at] = True
            texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(new, texts.type))
        yield pa.RecordBatch.from_arrays([b.column("id"), texts], names=["id", "text"])


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of docs, a tenth of the texts (by id) with a periodic tail; a null id is left alone."""
    ship(docs)
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return source.mapInArrow(_planter, source.schema)


def strongest(runs: str) -> Column:
    """The run of greatest length / period (exactly); of equal ones that of smallest start, then period."""
    def more(best: Column, r: Column) -> Column:
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    return F.aggregate(runs, F.lit(None).cast(RUN), more)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's row a document: runs of the texts with planted tails."""
    found = find_runs(planted(docs, id_col, text_col), "id", "text").withColumn("best", strongest("runs"))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        F.col("id").alias(id_col), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))

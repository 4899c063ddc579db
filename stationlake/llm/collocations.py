"""Collocations: phrases that occur together more often than their parts suggest.

Every phrase of up to `longest` words gets a Rabin-Karp fingerprint: prefix
polynomials over the bytes give a 64-bit value a word, prefix polynomials over
these values give the fingerprint of any stretch of words by one subtraction.
Language and length are mixed in. Only fingerprints travel, and only phrases that
prove frequent are ever spelled out:

1. A chunk of documents (about 2 MB of text) counts its fingerprints and sends
   one compressed payload a bucket of fingerprints: the distinct ones, a 16-bit
   check of the words by an independent polynomial, and the counts. The payload
   says which chunk it is from: that is the pointer to an occurrence.
2. A bucket adds the counts up. Each fingerprint that reaches the least count is
   handed to one of the chunks that hold it (picked by its own value, so that
   no chunk gets them all). Where checks differ, different phrases collide; then
   every chunk that holds the fingerprint gets it, to count from the text.
3. A chunk finds the fingerprints it was handed in its text and spells them:
   words, and the total, or what it counted for each different text. Sums by text
   are exact for collided fingerprints too.

What remains is a table of frequent phrases with their counts; the parts of a
frequent phrase are frequent, so scores are joins within this table. An error
needs two phrases with equal fingerprint and equal check (80 bits).

A phrase held by every document is one entry a chunk in one bucket. The documents
are read twice and chunks are named by partition and place: give a table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .common import buckets_for, ship, written
from .packing_io import blob_to_batch, chunk_packer, pack_sorted, squeeze, unpack_sorted, unsqueeze

CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 2 << 20
_COUNTED = "bucket int, chunk long, mark long, prints binary, checks binary, counts binary"
_OWNED = "chunk long, mark long, prints binary, counts binary"
_SPELLED = "lang string, n int, phrase string, f long"

BREAKS = np.zeros(256, dtype=bool)
BREAKS[[*map(ord, ".,;:!?"), *range(0x0A, 0x0E)]] = True
SEPARATORS = BREAKS.copy()
SEPARATORS[[0x20, 0x09]] = True
_CHECK_VALUE = (tv.constants(41, 256) >> np.uint64(32)).astype(np.uint32)
_CHECK_BASE = int(tv.constants(42, 1)[0]) & 0xFFFFFFFF


def _powers32(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint32)
    p[:1] = 1
    return np.multiply.accumulate(p, dtype=np.uint32)


def _word_checks(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A second 32-bit value of each word, independent of its hash."""
    total = np.zeros(len(data) + 1, dtype=np.uint32)
    np.cumsum(_CHECK_VALUE[data] * _powers32(_CHECK_BASE, len(data)), out=total[1:], dtype=np.uint32)
    inverse = _powers32(pow(_CHECK_BASE, -1, 1 << 32), len(data) + 1)
    return (total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint32)


class Phrases:
    """Fingerprints of all phrases of 1 to `longest` words in a chunk of documents.

    print, check, at, n: fingerprint, 16-bit check, first word and words of each
    phrase. bits: fingerprint bits in use (fewer than 64 only in tests, to force
    collisions).
    """

    def __init__(self, batch: pa.RecordBatch, longest: int, bits: int) -> None:
        data, offsets = tv.string_bytes(batch.column("text"))
        data = tv.LOWER[data]
        start, end = tv.spans(data, offsets, SEPARATORS)
        first = np.searchsorted(start, offsets)
        doc = np.repeat(np.arange(len(batch)), np.diff(first))
        broken = np.cumsum(BREAKS[data], dtype=np.int32)[start] if len(data) else start
        new = np.ones(len(start), dtype=bool)
        new[1:] = (broken[1:] != broken[:-1]) | (doc[1:] != doc[:-1])
        piece = np.cumsum(new)
        names, lang = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True) if len(batch) else ([], [])
        seeds = tv.range_hash(*_joined(names)) if len(names) else np.zeros(0, np.uint64)
        self.langs, self.lang = list(names), np.asarray(lang, dtype=np.int64)[doc]
        self.data, self.start, self.end = data, start, end
        value, check = tv.range_hash(data, start, end), _word_checks(data, start, end)
        base = int(tv.constants(43, 1)[0])
        m = len(start)
        total = np.zeros(m + 1, dtype=np.uint64)
        np.cumsum(value * _powers64(base, m), out=total[1:])
        back = _powers64(pow(base, -1, 1 << 64), m)
        salt, place = tv.constants(44, longest + 1), tv.constants(45, longest).astype(np.uint32)
        prints, checks, ats, sizes = [], [], [], []
        running = np.zeros(m, dtype=np.uint32)
        for n in range(1, longest + 1):
            k = max(0, m - n + 1)
            at = np.flatnonzero(piece[:k] == piece[n - 1 :]) if k else np.zeros(0, np.int64)
            running = running[:k] + check[n - 1 :] * place[n - 1] if k else running[:0]
            prints.append(tv.mix((total[at + n] - total[at]) * back[at] + seeds[self.lang[at]] * salt[n] if len(at) else np.zeros(0, np.uint64)))
            checks.append((running[at] * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16))
            ats.append(at.astype(np.int32))
            sizes.append(np.full(len(at), n, dtype=np.int8))
        self.print = np.concatenate(prints)
        if bits < 64:
            self.print = self.print >> np.uint64(64 - bits) << np.uint64(64 - bits)
        self.check, self.at, self.n = np.concatenate(checks), np.concatenate(ats), np.concatenate(sizes)
        self._raw: bytes | None = None

    def spell(self, i: int) -> tuple[str, int, str]:
        """(lang, words, phrase) of phrase i."""
        if self._raw is None:
            self._raw = self.data.tobytes()
        a, n = int(self.at[i]), int(self.n[i])
        words = [self._raw[self.start[j] : self.end[j]] for j in range(a, a + n)]
        return self.langs[self.lang[a]], n, b" ".join(words).decode()


def _powers64(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


def _joined(names) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [s.encode() for s in names]
    ends = np.cumsum([len(r) for r in raw])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), ends - [len(r) for r in raw], ends


def _runs(prints: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate(([True], prints[1:] != prints[:-1]))) if len(prints) else np.zeros(0, np.int64)


def _planes(values: np.ndarray) -> bytes:
    return squeeze(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def _unplanes(blob, dtype) -> np.ndarray:
    raw = np.frombuffer(unsqueeze(blob), dtype=np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, len(raw) // width).T).view(dtype).ravel()


def _counter(longest: int, buckets: int, bits: int):
    """A chunk's distinct (fingerprint, check) with counts, one payload a bucket."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("mark", pa.int64()), ("prints", pa.binary()),
                        ("checks", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, mark, blob in zip(*(batch.column(c) for c in ("chunk", "mark", "docs"))):
                p = Phrases(blob_to_batch(blob.as_buffer()), longest, bits)
                order = np.argsort(p.print)
                prints, checks = p.print[order], p.check[order]
                if np.any((prints[1:] == prints[:-1]) & (checks[1:] != checks[:-1])):
                    order = np.lexsort((p.check, p.print))
                    prints, checks = p.print[order], p.check[order]
                begin = np.flatnonzero(np.concatenate(([True], (prints[1:] != prints[:-1]) | (checks[1:] != checks[:-1])))) if len(prints) else order
                counts = np.diff(np.append(begin, len(prints))).astype(np.uint32)
                prints, checks = prints[begin], checks[begin]
                cut = np.concatenate(([0], np.searchsorted(prints, edges), [len(prints)]))
                rows = [(b, chunk.as_py(), mark.as_py(), pack_sorted(prints[x:y]), checks[x:y].tobytes(), _planes(counts[x:y]))
                        for b, (x, y) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if y > x]
                out = pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                del p, order, prints, checks, begin, counts, rows
                tv.lean()
                yield out
    return run


def _adder(least: int):
    """One bucket: the frequent fingerprints, each handed to one chunk, collided ones to all that hold them."""
    def run(table: pa.Table) -> pa.Table:
        tv.lean()  # of the bucket before
        each = [unpack_sorted(x.as_buffer(), np.uint64) for x in table.column("prints")]
        counts = np.concatenate([_unplanes(x.as_buffer(), np.uint32) for x in table.column("counts")]).astype(np.uint64)
        checks = np.concatenate([np.frombuffer(x.as_buffer(), np.uint16) for x in table.column("checks")])
        source = np.repeat(np.arange(len(each), dtype=np.int32), [len(e) for e in each])
        prints = np.concatenate(each)
        del each
        order = np.argsort(prints, kind="stable")
        prints, counts, checks, source = prints[order], counts[order], checks[order], source[order]
        begin = _runs(prints)
        size = np.diff(np.append(begin, len(prints)))
        total = np.add.reduceat(counts, begin)
        often = total >= np.uint64(least)
        mixed = np.minimum.reduceat(checks, begin) != np.maximum.reduceat(checks, begin)
        one = np.flatnonzero(often & ~mixed)
        pick = begin[one] + (tv.mix(prints[begin[one]]) % size[one].astype(np.uint64)).astype(np.int64)
        all_of = np.flatnonzero(often & mixed)
        also = tv.ragged(begin[all_of], size[all_of])
        owner = np.concatenate((source[pick], source[also]))
        value = np.concatenate((prints[pick], prints[also]))
        sums = np.concatenate((total[one], np.zeros(len(also), np.uint64)))  # 0: to be counted from the text
        order = np.lexsort((value, owner))
        owner, value, sums = owner[order], value[order], sums[order]
        cut = np.searchsorted(owner, np.arange(len(table) + 1))
        chunks, marks = table.column("chunk").to_pylist(), table.column("mark").to_pylist()
        rows = [(chunks[i], marks[i], value[x:y], sums[x:y]) for i, (x, y) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())) if y > x]
        return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                         pa.array([pack_sorted(r[2]) for r in rows], pa.binary()), pa.array([_planes(r[3]) for r in rows], pa.binary())],
                        names=["chunk", "mark", "prints", "counts"])
    return run


def _speller(longest: int, bits: int):
    """A chunk and the fingerprints it was handed -> phrases with counts, and its words by language (n = 0)."""
    def run(key: tuple, docs: pa.Table, owned: pa.Table) -> pa.Table:
        if not len(docs) or any(m != docs.column("mark")[0].as_py() for m in owned.column("mark").to_pylist()):
            raise RuntimeError("the documents changed between two reads; give a table, not a random or unordered source")
        tv.lean()  # of the chunk before
        p = Phrases(blob_to_batch(docs.column("docs")[0].as_buffer()), longest, bits)
        found: Counter = Counter()
        for lang, words in zip(*np.unique(p.lang, return_counts=True)):
            found[p.langs[lang], 0, ""] = int(words)
        if len(owned):
            value = np.concatenate([unpack_sorted(x.as_buffer(), np.uint64) for x in owned.column("prints")])
            total = np.concatenate([_unplanes(x.as_buffer(), np.uint64) for x in owned.column("counts")])
            order = np.argsort(value)
            value, total = value[order], total[order]
            begin = _runs(value)  # a collided fingerprint can come once a check
            value, total = value[begin], total[begin]
            at = np.minimum(np.searchsorted(value, p.print), len(value) - 1)
            here = np.flatnonzero(value[at] == p.print)
            which, example = np.unique(at[here], return_index=True)
            if len(which) < len(value):
                raise RuntimeError("a phrase is not in the chunk it was counted in: the documents changed between two reads")
            for w, e in zip(which.tolist(), here[example].tolist()):
                if total[w]:
                    found[p.spell(e)] += int(total[w])
            for i in here[total[at[here]] == 0].tolist():
                found[p.spell(i)] += 1
        keys = list(found)
        return pa.table([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                         pa.array([k[2] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())],
                        names=["lang", "n", "phrase", "f"])
    return run


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10,
                  bits: int = 64) -> DataFrame:
    """(lang, n, phrase, f): every phrase of 1 to `longest` words that occurs `least` times or more, a row a
    language and phrase; a row with n = 0 and an empty phrase holds the language's number of words.

    Texts are lower-cased (A-Z) and split at `[.,;:!?\\x0A-\\x0D]` into pieces and at spaces and tabs into words;
    phrases are consecutive words of one piece, overlapping occurrences count. A null text is empty, a null
    language `und`. Other columns are not read, whatever their names. Repeated rows count each time. An empty
    table gives no rows. A text is held by one task, whole.
    """
    ship(docs)
    source = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"),
                         F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    buckets = buckets_for(docs, BUCKET_BYTES)
    packed = source.mapInArrow(chunk_packer("text", CHUNK_BYTES), "chunk long, mark long, docs binary")
    counted = packed.mapInArrow(_counter(longest, buckets, bits), _COUNTED)
    owned = counted.groupBy("bucket").applyInArrow(_adder(least), _OWNED)
    spelled = packed.groupBy("chunk").cogroup(owned.groupBy("chunk")).applyInArrow(_speller(longest, bits), _SPELLED)
    return spelled.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("n") == 0))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 3, least: int = 10,
                 inside_pct: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases of 2 to `longest` words.

    a: occurrences of the phrase, `least` at least. Cutting it after k words gives l and r, the occurrences of
    the first part and the rest, and score = floor(1000000 * a * a / (l * r)), in exact decimals; the cut of
    lowest score counts, of equal ones that of smallest k. A phrase goes if a longer frequent phrase contains it
    and occurs at least inside_pct / 100 as often (it is enough to look one word further: what is longer still
    is no more frequent). n: words of the language. Order: score and a descending, phrase ascending (bytes),
    which leaves no ties. Input as in phrase_counts. top is the report's length, nothing is cut before it.
    """
    counts = written(phrase_counts(docs, text_col, lang_col, longest, least), "phrases")
    known = counts.where("n > 0").select("lang", "n", "phrase", "f")
    phrases = known.where("n > 1")
    part = F.split("phrase", " ")
    cuts = (phrases.select("lang", "n", "phrase", F.col("f").alias("a"), part.alias("w"), F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
            .select("lang", "n", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("head"),
                    F.array_join(F.slice("w", F.col("k") + 1, F.col("n") - F.col("k")), " ").alias("tail")))
    left = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"])
    big = {c: F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}
    scored = scored.select("lang", "phrase", "k", "a", "l", "r", (F.lit(1_000_000).cast("decimal(7,0)") * big["a"] * big["a"]).alias("over"),
                           (big["l"] * big["r"]).alias("under")).withColumn("score", F.expr("over div under"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")).select("lang", "phrase", "b.*")
    ends = F.array(F.array_join(F.slice(part, 1, F.col("n") - 1), " "), F.array_join(F.slice(part, 2, F.col("n") - 1), " "))
    around = (known.where("n > 2").select("lang", F.explode(ends).alias("phrase"), "f").groupBy("lang", "phrase")
              .agg(F.max("f").alias("longer")))
    free = best.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_pct))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    some = (free.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(16)))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    words = counts.where("n = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""Language identification by a linear-chain conditional random field over words.

Every word gets a label; neighbouring labels are tied by learned transition
weights, so words of code-switched text are labelled in context. Features of a
word, hashed to one weight table: its byte n-grams of two to four bytes, those
at its edges being affixes as they include the edge, and the word itself
(lexicon). A document's language is the label with the largest sum of posterior
probabilities, by forward-backward over the whole text.

The weights are fitted on the driver from a bounded sample of labelled
documents: about SAMPLE_DOCS per language, of each at most SAMPLE_CHARS
characters from a place given by a hash. Runs of words of different documents
are joined into code-switched sequences, from which the transitions are learned.
Documents are then labelled where they are read, without a shuffle; the model
that is broadcast has FEATURES weights per language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import textvec as tv
from .common import ship

CHUNK_BYTES = 2 << 20
SAMPLE_DOCS = 200
SAMPLE_CHARS = 3000
FEATURES = 1 << 18
SEQUENCES = 1600
SEQUENCE_WORDS = 20
EPOCHS = 10
UNDETERMINED = "und"

_LETTERS = np.ones(256, dtype=bool)  # separators: all ASCII but letters
_LETTERS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False
_MULTIPLIERS = tv.constants(23, 5)
_SHIFT = np.uint64(64 - (FEATURES.bit_length() - 1))


@dataclass
class Words:
    """Words of some texts: feature lists (first: place of each word's list) and words of each text."""

    grams: list[tuple[np.ndarray, np.ndarray]]  # for each n: (features, first feature of each word)
    lexicon: np.ndarray
    text: np.ndarray  # first word of each text, total at the end
    start: np.ndarray
    end: np.ndarray


def word_features(texts: pa.Array) -> Words:
    data, offsets = tv.string_bytes(texts)
    # one separator around every text, so that each word has edges
    data = np.insert(tv.LOWER[data], offsets, np.uint8(0x20)) if len(offsets) else data
    offsets = offsets + np.arange(len(offsets))
    separator = _LETTERS[data]
    data = np.where(separator, np.uint8(0x20), data)
    edge = np.flatnonzero(separator[1:] != separator[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    wide = np.concatenate((data, np.zeros(4, np.uint8))).astype(np.uint64)
    grams = []
    for n in (2, 3, 4):
        key = wide[: len(data)].copy()
        for i in range(1, n):
            key |= wide[i : i + len(data)] << np.uint64(8 * i)
        feature = ((key * _MULTIPLIERS[n]) >> _SHIFT).astype(np.int64)
        count = np.maximum(end - start + 3 - n, 1)  # places within the word and its two edges
        grams.append((feature[tv.ragged(start - 1, count)], np.cumsum(count) - count))
    lexicon = (tv.range_hash(data, start, end) >> _SHIFT).astype(np.int64)
    return Words(grams, lexicon, np.searchsorted(start, offsets), start - 1, end - 1)


@dataclass
class Model:
    langs: list[str]
    weight: np.ndarray  # FEATURES x languages
    transition: np.ndarray  # languages x languages
    first: np.ndarray

    def emissions(self, w: Words) -> np.ndarray:
        out = self.weight[w.lexicon].astype(np.float64)
        for feature, first in w.grams:
            if len(first):
                out += np.add.reduceat(self.weight[feature], first, axis=0)
        return out


def forward_backward(emission: np.ndarray, text: np.ndarray, transition: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Posterior probability of each label of each word; text: first word of each text, total at the end.

    All texts advance side by side, longest first, so a step is a few operations
    on arrays of the texts that are that long.
    """
    score = np.exp(emission - emission.max(axis=1, keepdims=True)) if len(emission) else emission
    move = np.exp(transition - transition.max())
    length = np.diff(text)
    order = np.argsort(-length, kind="stable")
    begin, length = text[:-1][order], length[order]
    live = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left").tolist()
    alpha = np.empty_like(score)
    now = np.tile(np.exp(first - first.max()), (len(order), 1))
    for t, k in enumerate(live):
        at = begin[:k] + t
        now = (now[:k] if t == 0 else np.einsum("ki,ij->kj", now[:k], move)) * score[at]
        now /= now.sum(axis=1, keepdims=True)
        alpha[at] = now
    back = np.ones((len(order), score.shape[1]))
    for t in range(len(live) - 1, -1, -1):
        k = live[t]
        at = begin[:k] + t
        alpha[at] *= back[:k]
        alpha[at] /= alpha[at].sum(axis=1, keepdims=True)
        b = np.einsum("ij,kj->ki", move, back[:k] * score[at])
        back[:k] = b / b.sum(axis=1, keepdims=True)
    return alpha


def train(texts: list[str], labels: list[str], seed: int = 5) -> Model:
    """Fits the field on whole-document labels: AdaGrad on the likelihood of code-switched sequences."""
    langs = sorted(set(labels))
    n = len(langs)
    model = Model(langs, np.zeros((FEATURES, n), np.float32), np.zeros((n, n)), np.zeros(n))
    if n < 2:
        return model
    w = word_features(pa.array(texts, pa.large_string()))
    label = np.array([langs.index(x) for x in labels])
    size = np.diff(w.text)
    pools = [np.flatnonzero((label == i) & (size > 0)) for i in range(n)]
    usable = [i for i in range(n) if len(pools[i])]
    if len(usable) < 2:
        return model
    rng = np.random.default_rng(seed)
    word = np.empty((SEQUENCES, SEQUENCE_WORDS), dtype=np.int64)
    gold = np.empty((SEQUENCES, SEQUENCE_WORDS), dtype=np.int64)
    for s in range(SEQUENCES):
        t = 0
        while t < SEQUENCE_WORDS:
            i = usable[int(rng.integers(len(usable)))]
            doc = pools[i][int(rng.integers(len(pools[i])))]
            run = min(int(rng.integers(4, SEQUENCE_WORDS + 1)), SEQUENCE_WORDS - t, int(size[doc]))
            at = w.text[doc] + int(rng.integers(size[doc] - run + 1))
            word[s, t : t + run] = np.arange(at, at + run)
            gold[s, t : t + run] = i
            t += run
    lists = [(w.lexicon, np.arange(len(w.lexicon)), np.ones(len(w.lexicon), np.int64))]
    lists += [(f, first, np.diff(np.append(first, len(f)))) for f, first in w.grams]
    square = [np.full_like(model.weight, 1e-4), np.full((n, n), 1e-2), np.full(n, 1e-2)]
    eye = np.eye(n)
    for _ in range(EPOCHS):
        for part in np.array_split(rng.permutation(SEQUENCES), 4):
            ids, y = word[part].ravel(), gold[part]
            feature = [f[tv.ragged(first[ids], count[ids])] for f, first, count in lists]
            repeat = [count[ids] for _, _, count in lists]
            emission = np.zeros((len(ids), n))
            for f, r in zip(feature, repeat):
                emission += np.add.reduceat(model.weight[f], np.cumsum(r) - r, axis=0)
            text = np.arange(len(part) + 1) * SEQUENCE_WORDS
            post = forward_backward(emission, text, model.transition, model.first)
            off = (post - eye[y.ravel()]) / len(part)
            grad = np.zeros_like(model.weight)
            for f, r in zip(feature, repeat):
                spread = np.repeat(off, r, axis=0)
                for i in range(n):
                    grad[:, i] += np.bincount(f, weights=spread[:, i], minlength=FEATURES)
            # expected transitions from the posteriors of neighbours given the emissions
            e = np.exp(emission - emission.max(axis=1, keepdims=True)).reshape(len(part), SEQUENCE_WORDS, n)
            pair = _pairs(e, model.transition, model.first) / len(part)
            seen = np.zeros((n, n))
            np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0 / len(part))
            begin = (post.reshape(len(part), SEQUENCE_WORDS, n)[:, 0] - eye[y[:, 0]]).mean(axis=0)
            for value, g, s, rate in ((model.weight, grad, square[0], 0.4), (model.transition, pair - seen, square[1], 0.2),
                                      (model.first, begin, square[2], 0.1)):
                s += g * g
                value -= (rate * g / np.sqrt(s)).astype(value.dtype)
    return model


def _pairs(score: np.ndarray, transition: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Expected number of each label pair, summed over sequences of one length."""
    move = np.exp(transition)
    steps = score.shape[1]
    alpha = np.empty_like(score)
    now = np.exp(first) * score[:, 0]
    alpha[:, 0] = now / now.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        now = np.einsum("ki,ij->kj", alpha[:, t - 1], move) * score[:, t]
        alpha[:, t] = now / now.sum(axis=1, keepdims=True)
    back = np.ones_like(score[:, 0])
    total = np.zeros_like(transition)
    for t in range(steps - 1, 0, -1):
        right = back * score[:, t]
        both = np.einsum("ki,ij,kj->kij", alpha[:, t - 1], move, right)
        total += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = np.einsum("ij,kj->ki", move, right)
        back /= back.sum(axis=1, keepdims=True)
    return total


def predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, Words]:
    """(language, score) of each text, the posteriors of all words, and the words."""
    w = word_features(texts)
    post = forward_backward(model.emissions(w), w.text, model.transition, model.first) if model.langs else np.zeros((len(w.start), 1))
    total = np.concatenate((np.zeros((1, post.shape[1])), np.cumsum(post, axis=0)))
    total = total[w.text[1:]] - total[w.text[:-1]]
    words = np.diff(w.text)
    best = total.argmax(axis=1)
    score = np.clip(total[np.arange(len(best)), best] / np.maximum(words, 1), 0.0, 1.0)
    data, offsets = tv.string_bytes(texts)
    ascii_letters = np.concatenate(([0], np.cumsum(((data | 0x20) >= ord("a")) & ((data | 0x20) <= ord("z")))))
    lettered = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~lettered & (words > 0)).tolist():  # other scripts, or only signs
        lettered[i] = any(c.isalpha() for c in texts[i].as_py())
    known = lettered & bool(model.langs)
    return ([model.langs[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())], np.where(known, score, 0.0), post, w)


def _labeller(broadcast, id_type: pa.DataType, with_words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for b in tv.rechunk(batches, tv.text_sizes("text"), CHUNK_BYTES):
            column = b.column("text").fill_null("")
            lang, score, post, w = predict(model, column)
            arrays = [b.column("id").cast(id_type), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            names = ["id", "held_out", "lang_pred", "score"]
            if with_words:
                best = post.argmax(axis=1)
                doc = np.repeat(np.arange(len(b)), np.diff(w.text))
                base = (w.start - _bases(column)[doc], w.end - _bases(column)[doc])
                struct = pa.StructArray.from_arrays(
                    [pa.array(base[0]), pa.array(base[1]), pa.array([model.langs[i] if model.langs else UNDETERMINED for i in best.tolist()], pa.string()),
                     pa.array(post.max(axis=1) if len(post) else np.zeros(0))], names=["start", "end", "lang", "probability"])
                arrays.append(pa.ListArray.from_arrays(pa.array(w.text.astype(np.int32)), struct))
                names.append("words")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
    return run


def _bases(texts: pa.Array) -> np.ndarray:
    """Where each text begins in the buffer of word_features, counted as its word places are."""
    _, offsets = tv.string_bytes(texts)
    return offsets[:-1] + np.arange(len(offsets) - 1)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model from documents that are not held out and have a language and an id."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
                       held_out(id_col).alias("held")).where("id is not null and text is not null and lang is not null and not held")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return Model([], np.zeros((FEATURES, 1), np.float32), np.zeros((1, 1)), np.zeros(1))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, SAMPLE_DOCS / n)))])
    place = F.pmod(F.xxhash64("id", F.lit(2)), F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1)))
    chosen = (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)) < share[F.col("lang")]
    sample = (rows.where(chosen).select("id", "lang", F.substring("text", (place + 1).cast("int"), F.lit(SAMPLE_CHARS)).alias("piece"))
              .limit(2 * SAMPLE_DOCS * len(counts)).collect())
    sample.sort(key=lambda r: (r["lang"], r["id"]))
    return train([r["piece"] for r in sample], [r["lang"] for r in sample])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", with_words: bool = False) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row of docs; the language column is used for fitting only.

    held_out: crc32 of the id as text is 1 modulo 3 (false for a null id, which
    is not learned from either). lang_pred: a learned language, or `und` with
    score 0 where the text is null or has no letter, or nothing was learned.
    score: mean posterior of that language over the text's words. with_words
    adds the words: byte range, language and probability each. Ties go to the
    language first in order. Repeated rows get equal results; other columns are
    not read; an empty table gives no rows.
    """
    ship(docs)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, lang_col))
    id_field = docs.schema[id_col].dataType
    source = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {id_field.simpleString()}, held_out boolean, lang_pred string, score double" + (
        ", words array<struct<start:bigint,end:bigint,lang:string,probability:double>>" if with_words else "")
    return source.mapInArrow(_labeller(model, to_arrow_type(id_field), with_words), schema).withColumnRenamed("id", id_col)

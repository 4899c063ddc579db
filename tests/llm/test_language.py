"""The random field on documents held out from it, and on code-switched text."""

import random
import zlib

from stationlake.llm import language_id

SYLLABLES = {"xa": "ka lo mi ta ru ne".split(), "yb": "str ent ung sch ach ver".split(), "zc": "éa ion eux ç ou èr".split()}


def text(lang, seed, n=60):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 4))) for _ in range(n))


def test_held_out_accuracy_and_words(spark):
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(["xa", "yb", "zc"] * 60)]
    rows += [(900, None, "xa"), (901, "123 .,! €", "yb"), (902, "", None), (903, text("yb", 903), None), (None, text("xa", 5), "zc"), (5, rows[5][1], "zc")]
    mixed = text("xa", 1, 12) + ", " + text("zc", 2, 12)
    rows.append((904, mixed, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = language_id.identify(docs, with_words=True).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902):
            assert r.lang_pred == "und" and r.score == 0
        elif r.doc_id == 904:
            raw = mixed.encode()
            assert [raw[w.start:w.end].decode() for w in r.words] == mixed.replace(",", "").split(" ")
            right = [w.lang == ("xa" if i < 12 else "zc") for i, w in enumerate(r.words)]
            assert sum(right) >= 22
        elif r.doc_id is not None:
            assert r.lang_pred == (["xa", "yb", "zc"][r.doc_id % 3] if r.doc_id < 900 else "yb")


def test_nothing_to_learn(spark, no_docs):
    assert language_id.identify(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language_id.identify(docs).collect()] == [("und", 0.0)]


def test_forward_backward_against_all_paths():
    """Posteriors of short texts against the sum over every sequence of labels."""
    from itertools import product

    import numpy as np
    r = np.random.default_rng(4)
    lengths, k = [4, 1, 0, 6, 2], 3
    text = np.concatenate(([0], np.cumsum(lengths)))
    emission, move, first = r.normal(size=(text[-1], k)), r.normal(size=(k, k)), r.normal(size=k)
    got = language_id.forward_backward(emission, text, move, first)
    for a, e in zip(text[:-1], text[1:]):
        want = np.zeros((e - a, k))
        for path in product(range(k), repeat=int(e - a)):
            weight = np.exp(sum(emission[a + i, y] for i, y in enumerate(path)) + sum(move[x, y] for x, y in zip(path, path[1:]))
                            + (first[path[0]] if path else 0))
            for i, y in enumerate(path):
                want[i, y] += weight
        if e > a:
            assert np.allclose(got[a:e], want / want.sum(axis=1, keepdims=True))

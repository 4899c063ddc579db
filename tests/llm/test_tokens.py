"""Token counts, token files and packing against the tokenizers library."""

import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest

from stationlake.llm import pack, token_counts, token_files
from stationlake.llm.encode import Encoder

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", None, "a<|endoftext|> b <|endoftext|>", "don't 'rest ''s it's. (x)  y  z　\n\n w", "Ünḯ café é '", " <|startoftext|>x",
       "a.b,c!?d  \t e", "x\x1f y", "ΑΣ Σ. ΟΔΟΣ ", "日本語 テスト。", "\n\n\nabc\r\n  def", "We'Re I'LL", "12345 67.8 x'y'z \"q\" $5 100%",
       "a" * 3000 + " b", "abcdefghijklmnop" * 200, "  ", "'", "'s", " 's", " a", "<|endoftext|><|endoftext|>'ll"]


def library(path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_gives_the_library_ids(path, odd_rows):
    texts = ODD + [t for _, t in odd_rows]
    ids, off = Encoder(open(path, encoding="utf-8").read()).encode(pa.array(texts, pa.string()))
    want = library(path)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == [want(t) for t in texts]


def test_transducer_counts(odd_rows):
    texts = ODD + [t for _, t in odd_rows]
    want = library(BYTE)
    t = token_counts.Transducer(open(BYTE, encoding="utf-8").read())
    assert t.count(pa.array(texts, pa.string())).tolist() == [len(want(x)) for x in texts]


def test_token_counts(odd_docs, odd_rows, no_docs):
    want = library(BYTE)
    got = token_counts.token_counts(odd_docs, BYTE).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (str(i), len((t or "").encode()), len(want(t)), len(want(t)) > 512) for i, t in odd_rows)
    assert token_counts.token_counts(no_docs, BYTE).count() == 0


def test_code_lengths_are_optimal_and_limited():
    import heapq
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 700):
        counts = r.integers(1, 1000, n)
        length = token_files.code_lengths(counts)
        heap, cost = counts.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        assert n == 1 or int((length * counts).sum()) == cost
    skewed = token_files.code_lengths(2 ** np.arange(40), 7)
    assert skewed.max() <= 7 and abs((2.0 ** -skewed).sum() - 1) < 1e-12


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_block_round_trip(n):
    r = np.random.default_rng(n)
    symbols = np.sort(r.choice(50_000, 900, replace=False))
    symbol, length, code = token_files.canonical(symbols, token_files.code_lengths(r.zipf(1.3, 900).clip(1, 10**9)))
    by = np.zeros((2, 50_001), dtype=np.int64)
    by[0, symbol], by[1, symbol] = code, length
    ids = r.choice(symbols, n)
    marks, bits = token_files.encode_block(ids, by[0], by[1])
    reach = 1 << (token_files.MAX_BITS - length)
    assert (token_files.decode_block(n, marks, bits, np.repeat(symbol, reach), np.repeat(length, reach)) == ids).all()


def test_token_files(spark, odd_docs, odd_rows, no_docs, tmp_path):
    want = library(BYTE)
    token_files.write_tokens(odd_docs, BYTE, str(tmp_path / "t"))
    got = token_files.read_tokens(spark, str(tmp_path / "t"), with_ids=True).orderBy("start").collect()
    assert [r.id for r in got] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i))
    assert sorted((str(r.id), r.ids) for r in got) == sorted((str(i), [*want(t), 2]) for i, t in odd_rows)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.n_tokens == len(r.ids) for r in got)
    assert token_files.round_trip(no_docs, BYTE).count() == 0


def test_patterns_hold_the_demand():
    r = np.random.default_rng(3)
    for n in (1, 40, 5000):
        sizes, counts = np.unique(np.minimum(256, r.geometric(1 / 50, n)), return_counts=True)
        demand = dict(zip(sizes.tolist(), counts.tolist()))
        got: dict[int, int] = {}
        patterns = pack.solve(demand, 256)
        for p in patterns:
            assert sum(c * k for c, k in p.count.items()) <= 256
            for c, k in p.count.items():
                got[c] = got.get(c, 0) + k * p.times
        assert got == demand
        assert sum(p.times for p in patterns) <= 1.02 * sum(c * k for c, k in demand.items()) / 256 + 8


def test_packing(odd_docs, odd_rows, no_docs):
    want = library(WORD)
    rows = pack.pack(odd_docs, WORD, capacity=128, with_ids=True).collect()
    for _, g in groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in g:
            assert r.offset == at and r.length == len(r.ids) > 0
            at += r.length
        assert at <= 128
    whole = {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        if r.doc_id is not None and r.doc_id != 21:  # rows that share an id are told apart by nothing
            whole.setdefault(r.doc_id, []).append((r.start, r.ids, r.doc_tokens))
    for i, t in odd_rows:
        if i in whole:
            ids = [x for _, part, _ in sorted(whole[i]) for x in part]
            assert ids == [*want(t), 1] and {n for _, _, n in whole[i]} == {len(ids)}
    assert sum(r.length for r in rows) == sum(len(want(t)) + 1 for _, t in odd_rows)
    assert pack.pack(no_docs, WORD).count() == 0

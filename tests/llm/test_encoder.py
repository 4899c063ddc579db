"""The encoder's kept segments: same ids with and without them, and no sorting of what is frequent."""

import random

import numpy as np
import pyarrow as pa
import pytest

from stationlake.llm import encode as EN

public_tokenizers = pytest.importorskip("public_tokenizers")


def texts(seed, n=60):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["naïve", "é", "日本", "don't", "<|endoftext|>", "a,b", "\n\n", "　"]
    return pa.array([None, ""] + [" ".join(r.choice(words) for _ in range(r.randrange(40))) for _ in range(n)])


def encoder(monkeypatch, **limits):
    for k, v in limits.items():
        monkeypatch.setattr(EN, k, v)
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return EN.Encoder(f.read())


@pytest.mark.parametrize("limits", [{}, {"SLOT_BITS": 2}, {"KEPT_BYTES": 3000}, {"SLOT_BITS": 1, "KEPT_BYTES": 600}])
def test_kept_segments_never_change_an_id(monkeypatch, limits):
    enc = encoder(monkeypatch, **limits)
    for seed in (1, 2, 1, 3, 1):
        some = texts(seed)
        ids, offsets = enc.encode(some)
        want = [enc.tokenizer.encode(t or "", add_special_tokens=False).ids for t in some.to_pylist()]
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == want


def test_frequent_segments_are_not_sorted_again(monkeypatch):
    enc, sorted_rows = encoder(monkeypatch), []
    monkeypatch.setattr(EN.np, "unique", lambda x, _real=np.unique, **k: (sorted_rows.append(len(x)), _real(x, **k))[1])
    enc.encode(texts(5, 400))
    enc.encode(texts(5, 400))
    assert sorted_rows[1] < sorted_rows[0] / 10

"""Nearest neighbours against brute force: exact on searched parts, recall of the parts, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlake.llm import nearest as N
from stationlake.llm.queries import QUERIES
from tests.conftest import SF_SMALL




def plain(rows, k=5):
    """rows: (id, vector) -> {query id: [(id, score)]}."""
    ok = [(i, np.array(v, dtype=np.float64)) for i, v in rows
          if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    sizes = [len(v) for _, v in ok]
    size = min(set(sizes), key=lambda s: (-sizes.count(s), s), default=0)
    ok = [(i, v) for i, v in ok if len(v) == size]
    out = {}
    for q, a in ok:
        if q % 50 == 0:
            best = out.setdefault(q, {})
            for i, b in ok:
                if i != q:
                    s = float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
                    best[i] = max(best.get(i, -2), s)
    return {q: sorted(b.items(), key=lambda e: (-e[1], e[0]))[:k] for q, b in out.items() if b}


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        near = out.setdefault(r.query_id, [])
        assert r["rank"] == len(near) + 1
        near.append((r.vec_id, r.score))
    return out


def same(a, b):
    assert a.keys() == b.keys()
    for q in a:
        assert [i for i, _ in a[q]] == [i for i, _ in b[q]], q
        assert np.allclose([s for _, s in a[q]], [s for _, s in b[q]], rtol=0, atol=1e-12)


def recall(got, want):
    return sum(len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) for q in want) / sum(map(len, want.values()))


def clustered(n, d, clusters, noise, seed):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(clusters, d))
    return centre[r.integers(clusters, size=n)] + noise * r.normal(size=(n, d))


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "n", 2.0) for i, v in rows],
                                 "vec_id long, embedding array<double>, node int, ids string, score double").repartition(4)


def test_small_tables_are_searched_whole(spark):
    got = by_query(QUERIES["op13_nearest"](spark, SF_SMALL))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    same(got, plain(rows))


def test_odd_rows(spark):
    r = np.random.default_rng(3)
    base = [(i, r.normal(size=4)) for i in range(120)]
    copies = [(1000 + i, base[0][1]) for i in range(60)] + [(2000 + i, 2 * base[1][1]) for i in range(3)]
    odd = [(None, [1, 2, 3, 4]), (150, None), (200, []), (250, [0, 0, 0, 0]), (300, [1, None, 2, 3]), (350, [1, float("nan"), 2, 3]),
           (400, [1, float("inf"), 0, 0]), (450, [1, 2, 3]), (500, [1e-200, 1e-200, 0, 1e-200]), (501, [1e300, 1e300, -1e300, 0]),
           (50, base[50][1]), (50, base[3][1]), (51, base[7][1])]
    rows = base + copies + odd
    want = plain([(i, N._scaled(np.array([v]))[0].tolist() if i in (500, 501) else v if v is None else list(v)) for i, v in rows])
    same(by_query(N.nearest(table(spark, rows), F.col("id") % 50 == 0)), want)


def test_few_or_no_rows(spark):
    assert by_query(N.nearest(table(spark, []), F.col("id") % 50 == 0)) == {}
    assert by_query(N.nearest(table(spark, [(0, [1, 0])]), F.col("id") % 50 == 0)) == {}
    rows = [(0, [1, 0]), (50, [1, 1]), (7, [0, 1])]
    same(by_query(N.nearest(table(spark, rows), F.col("id") % 50 == 0)), plain(rows))


@pytest.mark.parametrize("levels, leaf, fanout", [(1, 250, 16), (2, 100, 4)])
def test_recall_of_learned_parts(spark, levels, leaf, fanout):
    x = clustered(1500, 16, 30, 0.35, 5)
    rows = [(i, v) for i, v in enumerate(x)] + [(5000 + 50 * i, x[9]) for i in range(40)]
    got = by_query(N.nearest(table(spark, rows), F.col("id") % 50 == 0, leaf_rows=leaf, fanout=fanout, sample=600))
    want = plain(rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert recall(got, want) >= 0.9


def test_queries_that_find_too_few_are_searched_everywhere(spark):
    x = clustered(60, 8, 6, 0.1, 6)
    rows = [(i, v) for i, v in enumerate(x)]
    same(by_query(N.nearest(table(spark, rows), F.col("id") % 50 == 0, k=30, leaf_rows=10, fanout=8, mass=0.05)), plain(rows, 30))


def test_balanced_parts_and_fewer_cut_edges():
    x = N._unit(clustered(800, 12, 16, 0.3, 7))
    graph = N.neighbour_graph(x, 10)
    part = N.balanced_parts(x, graph, 7)
    size = np.bincount(part, minlength=7)
    assert size.min() >= math.floor(800 / 7 * 0.95) and size.max() <= math.ceil(800 / 7 * 1.05)
    first = np.zeros(800, dtype=np.int64)
    N._first_parts(x, np.arange(800), 7, 0, first)
    cut = lambda p: int((p[graph] != p[:, None]).sum())
    assert cut(part) < cut(first)


def test_routed_probabilities_hold_for_unseen_rows():
    x = N._unit(clustered(3000, 16, 40, 0.5, 8))
    place, ask = N.fit_parts(x[:1500], 8)
    part = (N._inputs(x) @ place).argmax(axis=1)
    near = N.neighbour_graph(x, 5)
    p = N._softmax(N._inputs(x[1500:]) @ ask)
    order = np.argsort(-p, axis=1)
    sorted_p = np.take_along_axis(p, order, 1)
    sent = np.zeros_like(p, dtype=bool)
    np.put_along_axis(sent, order, np.cumsum(sorted_p, 1) - sorted_p < 0.95, 1)
    hit = np.take_along_axis(sent, part[near[1500:]], 1).mean()
    assert hit > 0.93 and sent.sum(axis=1).mean() < 6

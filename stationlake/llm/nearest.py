"""Approximate nearest neighbours by learned partitions of the space.

Fitting (on a bounded sample of each part of the data): a neighbour graph is cut
into balanced parts with few edges between them, and two small softmax
classifiers learn the parts: one places every row in one part, the other says
for a query how its neighbours are spread over the parts (its targets are the
parts in which the sample's neighbours were placed; its temperature is set on
held-out sample rows, so that its probabilities can be taken at their word).
Queries go to the most probable parts until these hold `mass` of the
probability, and all rows there are ranked exactly.

Data beyond leaf_rows x fanout rows is partitioned again inside its parts, so the
parts' size stays bounded while their number grows with the data. Fitting,
placing and ranking are all grouped Spark work in blocks of bounded size; a part
that came out large is ranked in several blocks.

Equal vectors are one class, which stands for its smallest ids: a result of k
needs no more than k + 1 of them (one may be the query's own).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, written

GROUP_ROWS = 50_000
QUERY_ROWS = 2_048
NEIGHBOURS = 10
_FOUND = "cid long, id long, score double"


def usable(docs: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct (id, v) of the rows that take part; v as doubles.

    No part: a null id; a vector that is null, empty, zero, holds null or
    non-finite components, or has another number of components than most
    vectors (of equally many, the smaller number).
    """
    v = F.col("v")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull()
                      & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0))
    size = rows.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size(v) == (size["size"] if size else 0)).distinct()


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row divided by a power of two (exactly), so that no square over- or underflows."""
    _, e = np.frexp(np.abs(x).max(axis=1, initial=0.0))
    return np.ldexp(x, -e[:, None])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return _scaled(values.reshape(len(flat), -1).astype(np.float64)) if len(flat) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# --- fitting ---------------------------------------------------------------------------------------------------


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of each row of unit vectors x, itself left out."""
    out = np.empty((len(x), k), dtype=np.int64)
    for a in range(0, len(x), 512):
        s = x[a : a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + len(s)] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _first_parts(x: np.ndarray, rows: np.ndarray, parts: int, label: int, out: np.ndarray) -> None:
    """Parts of equal size by halving along the direction of most variance."""
    if parts == 1:
        out[rows] = label
        return
    y = x[rows] - x[rows].mean(axis=0)
    order = np.argsort(y @ np.linalg.eigh(y.T @ y)[1][:, -1], kind="stable")
    left = parts // 2
    cut = round(len(rows) * left / parts)
    _first_parts(x, rows[order[:cut]], left, label, out)
    _first_parts(x, rows[order[cut:]], parts - left, label + left, out)


def _spread(part: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """For each row, the edges (in either direction) to each part."""
    m, k = graph.shape
    own = np.repeat(np.arange(m), k)
    other = graph.ravel()
    count = np.bincount(own * parts + part[other], minlength=m * parts) + np.bincount(other * parts + part[own], minlength=m * parts)
    return count.reshape(m, parts)


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.05, rounds: int = 20) -> np.ndarray:
    """A part for each row: sizes within slack of equal, few edges of the graph between parts.

    Starts from equal halvings; rows then move to the part that most of their
    edges lead to, largest gain first, while sizes allow it; the best cut counts.
    """
    m = len(x)
    part = np.zeros(m, dtype=np.int64)
    _first_parts(x, np.arange(m), parts, 0, part)
    most, least = math.ceil(m / parts * (1 + slack)), math.floor(m / parts * (1 - slack))
    best, best_inside = part.copy(), -1
    for r in range(rounds):
        count = _spread(part, graph, parts)
        inside = int(count[np.arange(m), part].sum())
        if inside > best_inside:
            best, best_inside = part.copy(), inside
        to = count.argmax(axis=1)
        gain = count[np.arange(m), to] - count[np.arange(m), part]
        movers = np.flatnonzero((gain > 0) & (np.arange(m) % 2 == r % 2))  # neighbours that swap places would gain nothing
        size = np.bincount(part, minlength=parts)
        for i in movers[np.argsort(-gain[movers], kind="stable")].tolist():
            if size[to[i]] < most and size[part[i]] > least:
                size[part[i]] -= 1
                size[to[i]] += 1
                part[i] = to[i]
    inside = int(_spread(part, graph, parts)[np.arange(m), part].sum())
    return part if inside > best_inside else best


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _inputs(x: np.ndarray) -> np.ndarray:
    """Unit vectors scaled to components of about 1, and a constant."""
    return np.concatenate((x * math.sqrt(x.shape[1]), np.ones((len(x), 1))), axis=1)


def classifier(x: np.ndarray, target: np.ndarray, steps: int = 200, rate: float = 0.05, decay: float = 1e-3) -> np.ndarray:
    """Weights of a softmax classifier for soft targets, by Adam on all rows at once."""
    a = _inputs(x)
    w = np.zeros((a.shape[1], target.shape[1]))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = a.T @ (_softmax(a @ w) - target) / len(a) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def fit_parts(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights that place rows, weights that route queries) from a sample x of unit vectors."""
    k = min(NEIGHBOURS, len(x) - 1)
    if parts < 2 or len(x) < 4 * parts or k < 1:
        flat = np.zeros((x.shape[1] + 1, max(parts, 1)))
        flat[-1, 1:] = -1e9  # too few rows to split: all go to the first part
        return flat, flat
    graph = neighbour_graph(x, k)
    part = balanced_parts(x, graph, parts)
    place = classifier(x, _spread(part, graph, parts) * 0.1 / k + np.eye(parts)[part] * 0.8)
    placed = (_inputs(x) @ place).argmax(axis=1)
    spread = np.stack([np.bincount(placed[row], minlength=parts) for row in graph]) / k
    held = np.arange(len(x)) % 5 == 0
    ask = classifier(x[~held], spread[~held])
    z = _inputs(x[held]) @ ask
    loss = [(-(spread[held] * np.log(_softmax(z / t) + 1e-12)).sum(), t) for t in np.geomspace(0.25, 16, 25)]
    return place, ask / min(loss)[1]


# --- Spark -----------------------------------------------------------------------------------------------------


def _fitter(parts: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        place, ask = fit_parts(_unit(_matrix(table.column("v"))), parts)
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([place.tobytes()], pa.binary()),
                         pa.array([ask.tobytes()], pa.binary())], names=["node", "place", "ask"])
    return run


def _router(parts: int, mass: float | None):
    """Rows of a node -> their child nodes: the most probable one, or (with mass) the fewest that hold this probability."""
    def run(key: tuple, rows: pa.Table, model: pa.Table) -> pa.Table:
        x = _unit(_matrix(rows.column("v"))) if len(rows) else np.zeros((0, 1))
        if not len(rows):
            row, child = np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            w = np.frombuffer(model.column("place" if mass is None else "ask")[0].as_buffer(), np.float64).reshape(-1, parts)
            z = _inputs(x) @ w
            if mass is None:
                row, child = np.arange(len(x)), z.argmax(axis=1)
            else:
                p = _softmax(z)
                order = np.argsort(-p, axis=1, kind="stable")
                before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
                row, at = np.nonzero(before < mass)
                child = order[row, at]
        out = rows.select(["cid", "v", "ids"]).take(pa.array(row))
        return out.append_column("node", pa.array(key[0].as_py() * parts + child, pa.int64()))
    return run


_PLACED = "cid long, v array<double>, ids array<long>, node long"


def _blocked(rows: DataFrame, sizes: DataFrame, size: str, limit: int, name: str) -> DataFrame:
    """rows with their block: nodes of more than `limit` rows are dealt over several blocks."""
    blocks = sizes.select("node", F.greatest(F.lit(1), F.ceil(F.col(size) / limit)).cast("int").alias(f"{name}s"))
    return rows.join(blocks, "node").withColumn(name, F.pmod(F.xxhash64("cid"), F.col(f"{name}s")).cast("int"))


def _own(rows: DataFrame) -> DataFrame:
    """The same rows under columns of their own, so that two frames of one origin can be grouped together."""
    return rows.select(*[F.col(c).alias(c) for c in rows.columns])


def _routed(rows: DataFrame, models: DataFrame, parts: int, mass: float | None) -> DataFrame:
    sizes = rows.groupBy("node").agg(F.count("*").alias("m"))
    dealt = _blocked(rows, sizes, "m", GROUP_ROWS, "block")
    needed = sizes.select("node", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("m") / GROUP_ROWS)).cast("int") - 1)).alias("block"))
    keys = ["node", "block"]
    return _own(dealt.select(*keys, "cid", "v", "ids")).groupBy(*keys).cogroup(
        _own(needed.join(models, "node")).groupBy(*keys)).applyInArrow(_router(parts, mass), _PLACED)


def _ranker(k: int):
    """A block of rows and a block of queries -> for each query the k nearest ids of the block, exactly."""
    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        cids, ids, scores = [], [], []
        if len(rows) and len(queries):
            x, q = _matrix(rows.column("v")), _matrix(queries.column("v"))
            nx, nq = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
            members, names = rows.column("ids").to_pylist(), queries.column("cid").to_pylist()
            for a in range(0, len(q), 256):
                s = (q[a : a + 256] / nq[a : a + 256, None]) @ (x / nx[:, None]).T
                for i, near in enumerate(s):
                    some = min(k, len(x))
                    while True:
                        at = np.flatnonzero(near >= np.partition(near, len(x) - some)[len(x) - some] - 1e-12)
                        exact = (q[a + i] * x[at]).sum(axis=1) / (nq[a + i] * nx[at])
                        best: dict[int, float] = {}
                        for score, j in zip(exact.tolist(), at.tolist()):
                            for d in members[j]:
                                if best.get(d, -2.0) < score:
                                    best[d] = score
                        if len(best) >= k or some == len(x):
                            break
                        some = min(2 * some, len(x))  # ids that repeat with other vectors
                    top = sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k]
                    cids += [names[a + i]] * len(top)
                    ids += [d for d, _ in top]
                    scores += [c for _, c in top]
        return pa.table([pa.array(cids, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())], names=["cid", "id", "score"])
    return run


def _ranked(rows: DataFrame, asked: DataFrame, k: int, leaf_rows: int) -> DataFrame:
    """(cid, id, score): the k nearest ids in the nodes that each asked class was sent to."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("m")).join(asked.groupBy("node").agg(F.count("*").alias("q")), "node")
    data = _blocked(rows, sizes, "m", leaf_rows, "block")
    data = data.join(sizes.select("node", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("q") / QUERY_ROWS)).cast("int") - 1)).alias("part")), "node")
    some = _blocked(asked, sizes, "q", QUERY_ROWS, "part")
    some = some.join(sizes.select("node", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("m") / leaf_rows)).cast("int") - 1)).alias("block")), "node")
    keys = ["node", "block", "part"]
    found = _own(data.select(*keys, "v", "ids")).groupBy(*keys).cogroup(
        _own(some.select(*keys, "cid", "v")).groupBy(*keys)).applyInArrow(_ranker(k), _FOUND)
    best = found.groupBy("cid", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("cid").orderBy(F.desc("score"), "id")
    return best.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).drop("at")


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
            leaf_rows: int = 4096, fanout: int = 16, sample: int = 4096, mass: float = 0.97) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with is_query (a condition on `id`), its k nearest other rows found.

    Nearness is the cosine in double precision on the given vectors, largest
    first, ties to the smaller id; ranks start at 1. All rows are indexed and
    stay candidates. leaf_rows: rows of a part that are aimed at (up to so many
    rows in all are searched whole); fanout: most parts that a part is split
    into; sample: rows that each split is fitted on; mass: probability that the
    parts a query is sent to must hold over all levels, about the recall to
    expect. A query that finds fewer than k rows there is searched against all
    parts, so it returns k rows, or all if there are fewer.

    Rows that take no part: see `usable`. Repeated rows count once. An id that
    comes with several vectors is near by the nearest of them, as query and as
    candidate, and no candidate of itself. Other columns are not read. An empty
    table gives no rows.
    """
    ship(vectors)
    base = written(usable(vectors, id_col, vec_col).withColumn("h", F.xxhash64("v")), "vectors")
    first = Window.partitionBy("h", "v").orderBy("id")
    classes = (base.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)
               .groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    start = F.lit(0).cast("long").alias("node")  # stored, so that joins on it are joins on a column, not on a constant
    classes = written(classes.select("h", "v", "ids", F.monotonically_increasing_id().alias("cid"), start), "classes")
    queries = written(base.where(is_query).join(classes.select("h", "v", "cid"), ["h", "v"]).select("id", "cid"), "queries")
    n = classes.count()
    levels = 0
    while leaf_rows * fanout**levels < n:
        levels += 1
    parts = math.ceil((n / leaf_rows) ** (1 / levels)) if levels else 1
    rows = classes.select("cid", "v", "ids", "node")
    asked = rows.join(queries.select("cid").distinct(), "cid", "left_semi")
    for _ in range(levels):
        models = written(_drawn(rows, sample).groupBy("node").applyInArrow(_fitter(parts), "node long, place binary, ask binary"), "parts")
        rows = written(_routed(rows, models, parts, None), "placed")
        asked = written(_routed(asked, models, parts, mass ** (1 / levels)), "asked")
    found = written(_ranked(rows, asked, k + 1, leaf_rows), "found")
    out = _named(queries, found, k)
    if levels:
        few = queries.join(out.groupBy("query_id").agg(F.count("*").alias("m")), F.col("id") == F.col("query_id"), "left").where(
            F.coalesce("m", F.lit(0)) < k).select("cid").distinct()
        few = written(few, "few")
        if not few.isEmpty():
            nodes = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts**levels - 1).cast("long")))
            wide = classes.drop("node").join(few, "cid").select("cid", "v", "ids", nodes.alias("node"))
            found = written(found.join(few, "cid", "left_anti").unionByName(_ranked(rows, wide, k + 1, leaf_rows)), "found")
            out = _named(queries, found, k)
    return out


def _drawn(rows: DataFrame, sample: int) -> DataFrame:
    """At most `sample` rows of each node, by the hash of their number; only about 1.5 times as many are compared."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("m"))
    h = F.xxhash64("cid", F.lit(1))
    near = rows.join(sizes, "node").where(F.pmod(h, F.lit(1 << 40)) < F.lit(1.5 * sample * (1 << 40)) / F.col("m"))
    pick = Window.partitionBy("node").orderBy(h, "cid")
    return near.withColumn("at", F.row_number().over(pick)).where(F.col("at") <= sample).drop("at", "m")


def _named(queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Results by class -> results by query id, its own id left out."""
    lists = found.groupBy("cid").agg(F.collect_list(F.struct("id", "score")).alias("near"))
    each = (queries.join(lists, "cid").select(F.col("id").alias("query_id"), F.explode("near").alias("e"))
            .where(F.col("e.id") != F.col("query_id")).groupBy("query_id", F.col("e.id").alias("vec_id")).agg(F.max("e.score").alias("score")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

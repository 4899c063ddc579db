"""Property tests of the change-log operators against a brute-force fold."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationlake.operators import versions as V
from stationlake.sinks import version_log as VL

KEY = ["k"]
SCHEMA = "k bigint, v double, op string, commit_id bigint"


@st.composite
def change_logs(draw):
    """Commits 1..n; each commit touches each key at most once; deletes and
    updates only hit live keys, appends only absent ones."""
    n_commits = draw(st.integers(1, 6))
    live, rows = {}, []
    for c in range(1, n_commits + 1):
        for k in draw(st.lists(st.integers(0, 9), unique=True, max_size=6)):
            if k in live:
                if draw(st.booleans()):
                    rows.append((k, live.pop(k), "delete", c))
                else:
                    live[k] = float(draw(st.integers(0, 99)))
                    rows.append((k, live[k], "update", c))
            else:
                live[k] = float(draw(st.integers(0, 99)))
                rows.append((k, live[k], "append", c))
    return n_commits, rows


def fold(rows, bound):
    state = {}
    for k, v, op, c in sorted(rows, key=lambda r: r[3]):
        if c > bound:
            continue
        if op == "delete":
            state.pop(k, None)
        else:
            state[k] = v
    return state


def state_of(df):
    return {r["k"]: r["v"] for r in df.collect()}


def commits_df(spark, n):
    return spark.createDataFrame(
        [(c, c - 1 if c > 1 else None, dt.datetime(2020, 1, c), "append") for c in range(1, n + 1)],
        "commit_id bigint, parent_id bigint, committed_at timestamp_ntz, operation string")


SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(change_logs())
def test_as_of_equals_fold(spark, log):
    n, rows = log
    chg = spark.createDataFrame(rows, SCHEMA)
    for s in range(1, n + 1):
        assert state_of(V.as_of(chg, KEY, F.lit(s))) == fold(rows, s)


@SETTINGS
@given(change_logs(), st.integers(1, 6))
def test_expiry_keeps_retained_versions(spark, log, keep):
    n, rows = log
    chg = spark.createDataFrame(rows, SCHEMA)
    commits = commits_df(spark, n)
    folded = V.expire_retain_last(chg, commits, KEY, keep)
    oldest = max(1, n - keep + 1)
    for s in range(oldest, n + 1):
        assert state_of(V.as_of(folded, KEY, F.lit(s))) == fold(rows, s)
    assert folded.filter(F.col("commit_id") < oldest).count() == 0


@SETTINGS
@given(change_logs(), st.integers(1, 6))
def test_restore_and_diff(spark, log, target):
    n, rows = log
    target = min(target, n)
    chg = spark.createDataFrame(rows, SCHEMA)
    restore = V.restore_changes(chg, KEY, F.lit(target), F.lit(n + 1), F.lit(n))
    after = chg.unionByName(restore)
    assert state_of(V.as_of(after, KEY)) == fold(rows, target)
    diff = {r["k"]: r["change_type"] for r in V.version_diff(chg, KEY, F.lit(target), F.lit(n)).collect()}
    a, b = fold(rows, target), fold(rows, n)
    expect = {k: ("added" if k not in a else "removed" if k not in b else "changed")
              for k in set(a) | set(b) if a.get(k) != b.get(k) or (k in a) != (k in b)}
    assert diff == expect


def test_bounds_precedence(spark):
    commits = commits_df(spark, 5)
    one = lambda c: spark.range(1).select(c.alias("b")).first()["b"]
    assert one(V.resolve_bound(commits, snapshot_id=2, timestamp=dt.datetime(2020, 1, 4))) == 2
    assert one(V.resolve_bound(commits, timestamp=dt.datetime(2020, 1, 4, 12))) == 4
    assert one(V.resolve_bound(commits, minutes_ago=60, now=dt.datetime(2020, 1, 3, 0, 30))) == 2
    assert one(V.resolve_bound(commits)) == commits.agg({"commit_id": "max"}).first()[0]  # rows without a commit stay unseen


TABLE = "k bigint, v double"
BATCH = f"{TABLE}, op string"


def ops_of(rows, n):
    return [(c, c - 1 if c > 1 else None, dt.datetime(2020, 1, c),
             "append" if all(r[2] == "append" for r in rows if r[3] == c) else "overwrite",
             *[sum(r[2] == op for r in rows if r[3] == c) for op in V.OPS]) for c in range(1, n + 1)]


COMMITS = ("commit_id bigint, parent_id bigint, committed_at timestamp_ntz, operation string, added_rows bigint, "
           "updated_rows bigint, deleted_rows bigint")


@SETTINGS
@given(change_logs(), st.sampled_from([0, 1_000_000]))
def test_overlay_equals_fold(spark, log, broadcast_changes):
    n, rows = log
    chg = spark.createDataFrame(rows, SCHEMA)
    commits = spark.createDataFrame(ops_of(rows, n), COMMITS)
    for s in range(1, n + 1):
        assert state_of(V.as_of(chg, KEY, F.lit(s), commits, broadcast_changes)) == fold(rows, s)


def test_overlay_keeps_null_keys(spark):
    chg = spark.createDataFrame([(None, 1.0, "append", 1), (2, 2.0, "append", 1), (None, 1.5, "update", 2)], SCHEMA)
    commits = spark.createDataFrame([(1, None, None, "append", 2, 0, 0), (2, 1, None, "overwrite", 0, 1, 0)], COMMITS)
    assert state_of(V.as_of(chg, KEY, F.lit(2), commits)) == {None: 1.5, 2: 2.0}


def new_table(spark):
    from stationlake.session import scratch_path
    return scratch_path(spark, "versions")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), BATCH)


def state_at(spark, path, version=None):
    chg, commits = VL.read_changes(spark, path, TABLE), VL.read_commits(spark, path)
    return state_of(V.as_of(chg, KEY, None if version is None else F.lit(version), commits))


def test_commit_changes_roundtrip(spark):
    import pytest
    path = new_table(spark)
    assert VL.commit_changes(spark, path, batch(spark, (1, 1.0, "append"), (2, 2.0, "append")), KEY, "append") == 1
    b2 = spark.createDataFrame([(1, 5.0, "update", 1), (1, 6.0, "update", 2), (2, 2.0, "delete", 1)],
                               "k bigint, v double, op string, seq int")
    assert VL.commit_changes(spark, path, b2, KEY, "overwrite", seq_col="seq") == 2
    # a retried commit 2 rewrites its own folders only
    assert VL.commit_changes(spark, path, b2, KEY, "overwrite", seq_col="seq", commit_id=2) == 2
    assert VL.read_changes(spark, path, TABLE).count() == 4
    assert state_at(spark, path) == {1: 6.0}
    assert state_at(spark, path, 1) == {1: 1.0, 2: 2.0}
    c = {r["commit_id"]: r for r in VL.read_commits(spark, path).collect()}
    assert sorted(c) == [1, 2] and c[2]["parent_id"] == 1
    assert (c[2]["added_rows"], c[2]["updated_rows"], c[2]["deleted_rows"], c[1]["added_files"] > 0) == (0, 1, 1, True)
    # a bad batch is noticed before its commit can be seen, and its id is used again
    for bad, operation in ((b2.drop("seq"), "overwrite"), (batch(spark, (7, 1.0, "insert")), "overwrite"), (batch(spark, (1, 1.0, "update")), "append")):
        with pytest.raises(ValueError):
            VL.commit_changes(spark, path, bad, KEY, operation)
        assert state_at(spark, path) == {1: 6.0}
    assert VL.commit_changes(spark, path, batch(spark, (3, 3.0, "append")), KEY, "append") == 3
    assert state_at(spark, path) == {1: 6.0, 3: 3.0}


def test_restore_to_appends_a_commit(spark):
    path = new_table(spark)
    VL.commit_changes(spark, path, batch(spark, (1, 1.0, "append"), (2, 2.0, "append")), KEY, "append")
    VL.commit_changes(spark, path, batch(spark, (1, 9.0, "update"), (2, 2.0, "delete"), (3, 3.0, "append")), KEY, "overwrite")
    assert VL.restore_to(spark, path, TABLE, KEY, 1) == 3
    assert VL.restore_to(spark, path, TABLE, KEY, 1) == 3  # equal already
    assert state_at(spark, path) == {1: 1.0, 2: 2.0}
    assert state_at(spark, path, 2) == {1: 9.0, 3: 3.0}


def filled(spark):
    path = new_table(spark)
    for c in range(1, 6):
        rows = [(10 * c + i, float(c), "append") for i in range(3)]
        if c > 2:
            rows += [(10 * (c - 1), float(c), "update"), (10 * (c - 1) + 1, float(c - 1), "delete")]
        VL.commit_changes(spark, path, batch(spark, *rows), KEY, "append" if c < 3 else "overwrite",
                          committed_at=dt.datetime(2020, 1, c))
    return path


def test_expiry_removes_data_and_keeps_answers(spark):
    path = filled(spark)
    want = {v: state_at(spark, path, v) for v in range(1, 6)}
    assert VL.expire(spark, path, TABLE, KEY, older_than=dt.datetime(2020, 1, 2, 12)) == 3
    assert VL._folders(spark, f"{path}/log") == [4, 5] and VL._folders(spark, f"{path}/base") == [3]
    assert VL._folders(spark, f"{path}/commits") == [3, 4, 5]
    assert {v: state_at(spark, path, v) for v in (3, 4, 5)} == {v: want[v] for v in (3, 4, 5)}
    assert state_at(spark, path, 2) == {}  # expired
    top = V.list_snapshots(VL.read_commits(spark, path)).collect()
    assert [r["commit_id"] for r in top] == [5, 4, 3] and top[-1]["parent_id"] is None
    assert [r["total_rows"] for r in top] == [len(want[v]) for v in (5, 4, 3)]
    # once more, up to the last version; a later commit goes on from there
    assert VL.expire(spark, path, TABLE, KEY, retain_last=1) == 5
    assert VL._folders(spark, f"{path}/log") == [] and VL._folders(spark, f"{path}/base") == [5]
    assert VL.expire(spark, path, TABLE, KEY, retain_last=1) == 5  # nothing left to do
    assert VL.commit_changes(spark, path, batch(spark, (10, 0.0, "delete")), KEY, "delete") == 6
    assert state_at(spark, path, 5) == want[5]
    assert state_at(spark, path) == {k: v for k, v in want[5].items() if k != 10}


def test_a_crash_between_the_steps_of_an_expiry_hurts_no_answer(spark, monkeypatch):
    import pytest
    for broken in ("mark_expired", "sweep", "remove"):
        path = filled(spark)
        want = {v: state_at(spark, path, v) for v in range(1, 6)}
        with monkeypatch.context() as m:
            calls = []

            def crash(*a, _real=getattr(VL, broken), **k):
                calls.append(a)
                if broken == "sweep" and len(calls) == 1:  # the one before the expiry
                    return _real(*a, **k)
                if broken == "remove" and len(calls) < 3:  # in the middle of the deletions
                    return _real(*a, **k)
                raise RuntimeError("lost driver")
            m.setattr(VL, broken, crash)
            with pytest.raises(RuntimeError):
                VL.expire(spark, path, TABLE, KEY, retain_last=2)
        assert {v: state_at(spark, path, v) for v in (4, 5)} == {v: want[v] for v in (4, 5)}, broken
        assert VL.expire(spark, path, TABLE, KEY, retain_last=2) == 4
        assert {v: state_at(spark, path, v) for v in (4, 5)} == {v: want[v] for v in (4, 5)}, broken
        assert VL._folders(spark, f"{path}/log") == [5] and VL._folders(spark, f"{path}/commits") == [4, 5]


def test_reads_of_appends_need_no_shuffle(spark):
    from tests.test_plans import plan
    path = new_table(spark)
    for c in range(1, 4):
        VL.commit_changes(spark, path, batch(spark, (c, 1.0, "append"), (10 + c, 1.0, "append")), KEY, "append")
    VL.commit_changes(spark, path, batch(spark, (1, 2.0, "update")), KEY, "overwrite")
    chg, commits = VL.read_changes(spark, path, TABLE), VL.read_commits(spark, path)
    assert "Exchange" not in plan(V.as_of(chg, KEY, F.lit(3), commits))
    latest = V.as_of(chg, KEY, F.lit(4), commits)
    latest.collect()
    p = plan(latest)
    # the log of the appends is read and joined in place; only the changed rows are exchanged by key
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and p.count("hashpartitioning") <= p.count("Scan parquet") + 2


def test_snapshot_list_does_not_read_the_log(spark):
    from stationlake.sources import fixtures as FX
    from tests.conftest import SF_SMALL
    path = FX.version_table(spark, SF_SMALL)
    files = V.list_snapshots(VL.read_commits(spark, path)).inputFiles()
    assert files and all("/commits/" in f for f in files)


rows_with_repeats = st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, 0, 1])), max_size=12)


@SETTINGS
@given(rows_with_repeats, rows_with_repeats)
def test_bag_difference(spark, a, b):
    from collections import Counter
    sch = "x string, `y z` int"
    got = {(r[0], r[1]): r["copies"] * (1 if r["change_type"] == "added" else -1)
           for r in V.bag_difference(spark.createDataFrame(a, sch), spark.createDataFrame(b, sch)).collect()}
    want = Counter(b)
    want.subtract(Counter(a))
    assert got == {k: n for k, n in want.items() if n}


def test_bag_versions_refuse_updates_and_shuffle_once(spark):
    import pytest
    from tests.test_plans import plan
    log = spark.createDataFrame([("a", "append", 1), ("a", "append", 2), ("a", "delete", 3), ("b", "append", 3)], "x string, op string, commit_id bigint")
    d = V.version_diff_bag(log, F.lit(1), F.lit(3))
    assert [tuple(r) for r in d.collect()] == [("b", "added", 1)]
    assert plan(d, "simple").split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    with pytest.raises(Exception, match="no updates"):
        V.version_diff_bag(spark.createDataFrame([("a", "update", 2)], "x string, op string, commit_id bigint"), F.lit(1), F.lit(3)).collect()

"""Table versions over a change log.

A versioned table is a change log ``(key..., columns..., op, commit_id)``
(op is ``append``, ``update`` or ``delete``; a delete carries the row it
removes) and a small commits table (see ``sinks.version_log``). Each commit
holds at most one change per key; a commit whose operation is ``append``
only adds keys that are not live.

Reads overlay the log: rows of append commits pass as they are, and only the
keys changed by other commits are folded (``max_by(row, commit_id)``) and
laid over them. Tables without a key are bags of rows: their versions are
compared by signed counts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPS = ("append", "update", "delete")

#: Changed rows (by the commits' own counts) up to which the folded keys are broadcast to the log's
#: readers; beyond it both sides are shuffled by key.
BROADCAST_CHANGES = 1_000_000


# --- commit bounds ----------------------------------------------------------------
def commit_at_or_before(commits: DataFrame, ts) -> Column:
    """Last commit id with committed_at <= ts (scalar subquery)."""
    return commits.filter(F.col("committed_at") <= F.lit(ts)).agg(F.max("commit_id")).scalar()


def resolve_bound(commits: DataFrame, snapshot_id: int | None = None, timestamp=None,
                  minutes_ago: int | None = None, now: dt.datetime | None = None) -> Column | None:
    """Snapshot id beats timestamp, timestamp beats minutes-ago; None means
    the latest version."""
    if snapshot_id is not None:
        return F.lit(int(snapshot_id)).cast("long")
    if timestamp is not None:
        return commit_at_or_before(commits, timestamp)
    if minutes_ago is not None:
        base = F.lit(now) if now is not None else F.localtimestamp()
        ts = base - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(minutes_ago)))
        return commits.filter(F.col("committed_at") <= ts).agg(F.max("commit_id")).scalar()
    return commits.agg(F.max("commit_id")).scalar()  # the latest commit: rows without one are not visible


def _value_cols(changes: DataFrame, key: list[str]) -> list[str]:
    return [c for c in changes.columns if c not in (*key, "op", "commit_id")]


def _upto(changes: DataFrame, bound: Column | None) -> DataFrame:
    return changes if bound is None else changes.filter(F.col("commit_id") <= bound)


# --- reads ------------------------------------------------------------------------
def _folded(changes: DataFrame, key: list[str]) -> DataFrame:
    """Per key its last change: (key..., _r: values and op, _c: its commit)."""
    vals = _value_cols(changes, key)
    return changes.groupBy(*key).agg(F.max_by(F.struct(*vals, "op"), F.col("commit_id")).alias("_r"),
                                     F.max("commit_id").alias("_c"))


def as_of(changes: DataFrame, key: list[str], bound: Column | None = None, commits: DataFrame | None = None,
          broadcast_changes: int = BROADCAST_CHANGES) -> DataFrame:
    """Table state after commit ``bound`` (latest when None).

    With ``commits`` the commits' operations decide what has to be folded. If
    all are appends, the state is the filtered log: no shuffle. Otherwise the
    rows of the other commits are folded by key, and an appended row stays if
    its key was not changed, or was changed before it was appended (again).
    Folded keys are broadcast when the commits count at most
    ``broadcast_changes`` changed rows. Without ``commits`` every key is folded.
    """
    vals = _value_cols(changes, key)
    c = _upto(changes, bound)
    if commits is None:
        last = _folded(c, key)
        return last.filter(F.col("_r.op") != "delete").select(*key, *[F.col(f"_r.{v}").alias(v) for v in vals])
    other = _upto(commits, bound).filter(F.col("operation") != "append")
    if "base_rows" in commits.columns:  # the base of an expiry holds appends only
        other = other.filter(F.col("base_rows").isNull())
    ids = [(r["commit_id"], r["n"]) for r in other.select(
        "commit_id", (F.col("added_rows") + F.col("updated_rows") + F.col("deleted_rows")).alias("n")).collect()]  # one a commit
    if not ids:
        return c.select(*key, *vals)
    changed = F.col("commit_id").isin([i for i, _ in ids])
    last = _folded(c.filter(changed), key)
    over = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)], "_c")
    if sum(n or 0 for _, n in ids) <= broadcast_changes:
        over = F.broadcast(over)
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    kept = c.filter(~changed).join(over, same, "left").filter(F.col("_c").isNull() | (F.col("commit_id") > F.col("_c")))
    return kept.select(*key, *vals).unionByName(
        last.filter(F.col("_r.op") != "delete").select(*key, *[F.col(f"_r.{v}").alias(v) for v in vals]))


def as_of_query(changes: DataFrame, commits: DataFrame, key: list[str], snapshot_id=None, timestamp=None,
                minutes_ago=None, now=None, where: str | None = None, limit: int | None = None,
                order_by: list[str] | None = None) -> DataFrame:
    """As-of read + optional WHERE text (parsed as one expression) + LIMIT.
    With ``order_by`` (default: the key) the limit is a distributed top-k."""
    df = as_of(changes, key, resolve_bound(commits, snapshot_id, timestamp, minutes_ago, now), commits)
    if where:
        df = df.filter(F.expr(where))
    if limit is not None:
        df = df.orderBy(*(order_by or key)).limit(int(limit))
    return df


def _only_touched(changes: DataFrame, key: list[str], early: Column, late: Column | None) -> DataFrame:
    """Restrict the log to keys written in (early, late]. Those commits are a
    partition-pruned slice of the log; AQE measures its keys and, when they
    are few, filters the log with them before any shuffle of it."""
    recent = _upto(changes, late).filter(F.col("commit_id") > early).select(*key)
    return changes.join(recent.distinct(), key, "left_semi")


def _two_states(changes: DataFrame, key: list[str], early: Column, late: Column | None) -> DataFrame:
    """Per key touched after ``early`` (up to ``late``): the row at ``early``
    and at ``late`` (NULL when absent or deleted), in one aggregation."""
    vals = _value_cols(changes, key)
    c = _upto(_only_touched(changes, key, early, late), late)
    row = F.struct(*vals, "op")
    in_early = F.col("commit_id") <= early
    g = c.groupBy(*key).agg(
        F.max_by(F.when(in_early, row), F.when(in_early, F.col("commit_id"))).alias("_a"),
        F.max_by(row, F.col("commit_id")).alias("_b"),
        F.max("commit_id").alias("_last"),
    ).filter(F.col("_last") > early)
    a_live = F.col("_a").isNotNull() & (F.col("_a.op") != "delete")
    b_live = F.col("_b").isNotNull() & (F.col("_b.op") != "delete")
    same = F.lit(True)
    for v in vals:
        same = same & F.col(f"_a.{v}").eqNullSafe(F.col(f"_b.{v}"))
    change = (F.when(~a_live & b_live, "added").when(a_live & ~b_live, "removed")
              .when(a_live & b_live & ~same, "changed"))
    out = g.select(*key, change.alias("change_type"),
                   *[F.when(a_live, F.col(f"_a.{v}")).alias(f"before_{v}") for v in vals],
                   *[F.when(b_live, F.col(f"_b.{v}")).alias(f"after_{v}") for v in vals])
    return out.filter(F.col("change_type").isNotNull())


def version_diff(changes: DataFrame, key: list[str], from_bound: Column, to_bound: Column) -> DataFrame:
    """Rows added, removed or changed between two versions (from < to):
    one row per key with ``change_type`` and the before/after values. Only
    keys written after ``from_bound`` can differ, and one aggregation finds
    both states."""
    return _two_states(changes, key, from_bound, to_bound)


def _bag_sides(copies: Column) -> list[Column]:
    return [F.when(copies > 0, "added").otherwise("removed").alias("change_type"), F.abs(copies).cast("long").alias("copies")]


def version_diff_bag(changes: DataFrame, from_bound: Column, to_bound: Column) -> DataFrame:
    """Rows added and removed between two versions (from < to) of a table without a key.

    The log holds appended and deleted rows only (a changed row is a delete and
    an append), and equal rows count one by one. The difference is the signed
    count of each row over the commits in between, so nothing before
    ``from_bound`` is read, and rows that come and go cancel in one partially
    aggregated shuffle: (columns..., change_type, copies).
    """
    cols = _value_cols(changes, [])
    between = changes.filter((F.col("commit_id") > from_bound) & (F.col("commit_id") <= to_bound))
    sign = F.when(F.col("op") == "append", 1).when(F.col("op") == "delete", -1).otherwise(
        F.raise_error(F.lit("a table without a key has no updates")).cast("int"))
    net = between.groupBy(*cols).agg(F.sum(sign).alias("_n")).filter(F.col("_n") != 0)
    return net.select(*cols, *_bag_sides(F.col("_n")))


def bag_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """``after`` EXCEPT ALL ``before`` as added rows, ``before`` EXCEPT ALL ``after`` as removed ones, for any two
    tables of the same columns: (columns..., change_type, copies), a row a distinct row that differs in number.

    Tables that mostly agree are cheap: only a 128-bit hash and a sign a row are
    shuffled (combined in the map tasks), and whole rows are then read again for
    the hashes whose counts differ. NULLs are equal to each other.
    """
    cols = before.columns

    def signed(df: DataFrame, sign: int) -> DataFrame:
        whole = [F.col(f"`{c}`") for c in cols]
        # NULL adds nothing to a hash, so a mark of the NULLs goes in as well
        nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in whole])
        return df.select(*whole, F.lit(sign).alias("_n"), F.xxhash64(nulls, *whole).alias("_h"),
                         F.xxhash64(*whole, F.lit(7), nulls).alias("_g"))

    both = signed(before, -1).unionByName(signed(after, 1))
    differ = both.groupBy("_h", "_g").agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0).select("_h", "_g")
    rows = both.join(differ, ["_h", "_g"], "left_semi").groupBy(*[f"`{c}`" for c in cols]).agg(F.sum("_n").alias("_n"))
    return rows.filter(F.col("_n") != 0).select(*[F.col(f"`{c}`") for c in cols], *_bag_sides(F.col("_n")))


def restore_changes(changes: DataFrame, key: list[str], to_bound: Column, new_commit_id: Column,
                    latest: Column) -> DataFrame:
    """The change rows of a new commit that makes the latest state equal the
    state at ``to_bound``; history is kept (append them to the log).
    ``latest``: the last commit, so rows without a commit stay unseen."""
    vals = _value_cols(changes, key)
    d = _two_states(changes, key, to_bound, latest)
    # d describes to_bound -> latest; undo it: added -> delete, removed -> append, changed -> update
    op = (F.when(F.col("change_type") == "added", "delete").when(F.col("change_type") == "removed", "append")
          .otherwise("update"))
    src = {v: F.when(F.col("change_type") == "added", F.col(f"after_{v}")).otherwise(F.col(f"before_{v}"))
           for v in vals}
    return d.select(*key, *[src[v].alias(v) for v in vals], op.alias("op"),
                    new_commit_id.cast("long").alias("commit_id"))


def version_audit(changes: DataFrame, commits: DataFrame, key: list[str],
                  keys: DataFrame | None = None) -> DataFrame:
    """Every change of the chosen keys with its commit's time and operation.
    Both joined sides may be derived (keys from an aggregation), so their
    size is left to AQE, which measures them after their shuffle; a commits
    table has one row per commit and ends up broadcast."""
    c = changes if keys is None else changes.join(keys.select(*key).distinct(), key, "left_semi")
    meta = commits.select("commit_id", "committed_at", F.col("operation").alias("commit_operation"))
    return c.join(meta, "commit_id")


def keys_changed_more_than_once(changes: DataFrame, key: list[str]) -> DataFrame:
    return changes.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*key)


def list_snapshots(commits: DataFrame) -> DataFrame:
    """Commits newest first with the rows and files each added, updated and
    deleted and the totals after it. All of it was stored when the commits were
    written, so the log is not read. Totals start from the base's own numbers
    when older commits have been expired (running sum over the small commits
    table, one row a commit)."""
    w = Window.orderBy("commit_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.col("base_rows").isNotNull()
    rows = F.when(base, F.col("base_rows")).otherwise(F.col("added_rows") - F.col("deleted_rows"))
    files = F.when(base, F.col("base_files")).otherwise(F.col("added_files") - F.col("deleted_files"))
    return commits.select(
        "commit_id", "parent_id", "committed_at",
        F.date_format("committed_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("committed_at_text"),
        F.unix_millis(F.col("committed_at").cast("timestamp")).alias("timestamp_ms"),
        "operation", "added_rows", "updated_rows", "deleted_rows", "added_files", "deleted_files",
        F.sum(rows).over(w).cast("long").alias("total_rows"), F.sum(files).over(w).cast("long").alias("total_files"),
    ).orderBy(F.col("commit_id").desc())


# --- maintenance ------------------------------------------------------------------
def fold_before(changes: DataFrame, key: list[str], oldest_kept: Column, commits: DataFrame | None = None) -> DataFrame:
    """New change log in which every commit before ``oldest_kept`` is folded
    into one base commit at ``oldest_kept`` holding that version's state.
    As-of answers for every commit >= oldest_kept are unchanged."""
    vals = _value_cols(changes, key)
    base = as_of(changes, key, oldest_kept, commits).select(
        *key, *vals, F.lit("append").alias("op"), oldest_kept.cast("long").alias("commit_id"))
    return base.unionByName(changes.filter(F.col("commit_id") > oldest_kept))


def oldest_retained_after(commits: DataFrame, ts) -> Column:
    """Oldest commit at or after ``ts``; the latest commit is always kept."""
    return commits.agg(F.coalesce(F.min(F.when(F.col("committed_at") >= F.lit(ts), F.col("commit_id"))),
                                  F.max("commit_id"))).scalar()


def oldest_of_last(commits: DataFrame, n: int) -> Column:
    """Commit id of the n-th newest commit (the oldest one kept)."""
    return commits.select("commit_id").orderBy(F.col("commit_id").desc()).limit(int(n)) \
        .agg(F.min("commit_id")).scalar()


def expire_older_than(changes: DataFrame, commits: DataFrame, key: list[str], ts) -> DataFrame:
    return fold_before(changes, key, oldest_retained_after(commits, ts))


def expire_retain_last(changes: DataFrame, commits: DataFrame, key: list[str], n: int) -> DataFrame:
    return fold_before(changes, key, oldest_of_last(commits, n))

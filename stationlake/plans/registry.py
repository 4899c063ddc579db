"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query runs a library operator over adapters of the whole test tables.
"""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions.parse import scale_units
from stationlake.operators import analytics as A
from stationlake.operators import quality as Q
from stationlake.operators import summaries as S
from stationlake.operators import tables as TB
from stationlake.operators import versions as V
from stationlake.operators.joins import semi_join_stations
from stationlake.plans.jobs import daily_run
from stationlake.plans.maintenance import compact
from stationlake.schemas import OBSERVATION_COLUMNS, OBSERVATIONS_SCHEMA, PARTITION_COLUMNS
from stationlake.session import configure, scratch_path
from stationlake.sinks import tables as SK
from stationlake.sinks import version_log as VL
from stationlake.sources import fixed_width as FW
from stationlake.sources import fixtures as FX
from stationlake.sources import messages as M
from stationlake.sources import observations_csv as OC
from stationlake.streaming import ingest as STR

# Parameters of the fixture queries (the reference uses 1980-2010 and 2015;
# the test tables cover 1995-2001).
BASELINE_FROM, BASELINE_TO, REPORT_FROM = 1995, 1997, 1999
EXACT = 2  # decimal scale for sums of the two-decimal test values

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        REGISTRY[name] = wrapped
        return wrapped
    return deco


def _daily(spark, sf_dir):
    return S.daily_summary(FX.obs_li(spark, sf_dir), FX.st_sup(spark, sf_dir))


def _monthly(spark, sf_dir):
    daily = S.daily_summary(FX.obs_li(spark, sf_dir), FX.st_sup(spark, sf_dir), keep_partitions=True)
    return S.monthly_summary(daily, exact_scale=EXACT)


@register("daily_summary")
def q_daily_summary(spark, sf_dir):
    """Daily pivot of six elements joined to station attributes, read
    through its view."""
    daily, _ = S.register_views(spark, FX.obs_li(spark, sf_dir), FX.st_sup(spark, sf_dir), exact_scale=EXACT)
    return spark.table(daily)


@register("monthly_summary")
def q_monthly_summary(spark, sf_dir):
    """Monthly summary, read through its view (defined over the daily view)."""
    _, monthly = S.register_views(spark, FX.obs_li(spark, sf_dir), FX.st_sup(spark, sf_dir), exact_scale=EXACT)
    return spark.sql(f"SELECT * FROM {monthly}")


@register("annual_summary")
def q_annual_summary(spark, sf_dir):
    return S.annual_summary(_monthly(spark, sf_dir), exact_scale=EXACT)


@register("temp_anomaly")
def q_temp_anomaly(spark, sf_dir):
    return S.temp_anomaly(_monthly(spark, sf_dir), BASELINE_FROM, BASELINE_TO, REPORT_FROM,
                          exact_scale=EXACT)


# --- quality, analytics, scans ---------------------------------------------------


RUN_DATE = _dt.date(1998, 6, 15)       # dq_row_counts run date
SCAN_YEAR, SCAN_MONTH = 1998, 1        # partition-filtered scan
REFRESH_AS_OF = _dt.date(2001, 6, 30)  # annual refresh "today" -> refreshes 2000
MATERIALIZED_BEFORE = _dt.date(2000, 7, 1)  # the annual table was built before this date
GRID_DEGREES = 30.0
CORR_DIGITS = 6
LIMIT_N = 10


@register("month_distribution")
def q_month_distribution(spark, sf_dir):
    return Q.month_distribution(FX.obs_li(spark, sf_dir))


@register("dq_row_counts")
def q_dq_row_counts(spark, sf_dir):
    obs = SK.read_observations(spark, FX.observations_table(spark, sf_dir))
    return Q.dq_row_counts(FX.st_sup(spark, sf_dir), obs, RUN_DATE)


@register("semi_join_stations")
def q_semi_join_stations(spark, sf_dir):
    return semi_join_stations(FX.obs_li(spark, sf_dir), FX.st_selected(spark, sf_dir))


@register("scan_partition_filter")
def q_scan_partition_filter(spark, sf_dir):
    obs = SK.read_observations(spark, FX.observations_table(spark, sf_dir))
    return obs.filter((F.col("year") == SCAN_YEAR) & (F.col("month") == SCAN_MONTH)) \
        .select("station_id", "date", "element", "value")


@register("derive_partitions")
def q_derive_partitions(spark, sf_dir):
    return SK.derive_partitions(FX.obs_li(spark, sf_dir).drop("year", "month"))


@register("scale_units")
def q_scale_units(spark, sf_dir):
    o = FX.obs_li(spark, sf_dir)
    return o.select("station_id", "date", "element", scale_units("element", "value").alias("value"))


@register("scan_limit")
def q_scan_limit(spark, sf_dir):
    o = FX.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                 "o_totalprice", "o_orderdate")
    return TB.scan_limit(o, LIMIT_N, ["o_orderkey"])


@register("temp_trend")
def q_temp_trend(spark, sf_dir):
    return A.temp_trend(_monthly(spark, sf_dir), exact_scale=EXACT + 2)


@register("region_grid")
def q_region_grid(spark, sf_dir):
    return A.region_grid(_monthly(spark, sf_dir), GRID_DEGREES, exact_scale=EXACT + 2)


@register("precip_year_over_year")
def q_precip_year_over_year(spark, sf_dir):
    return A.precip_year_over_year(_monthly(spark, sf_dir))


@register("current_vs_history")
def q_current_vs_history(spark, sf_dir):
    return A.current_vs_history(_monthly(spark, sf_dir), exact_scale=EXACT + 2)


@register("temp_precip_corr")
def q_temp_precip_corr(spark, sf_dir):
    return A.temp_precip_corr(_monthly(spark, sf_dir), digits=CORR_DIGITS)


# --- sinks -----------------------------------------------------------------------
@register("annual_materialize")
def q_annual_materialize(spark, sf_dir):
    path = scratch_path(spark, "annual")
    SK.materialize_annual(S.annual_summary(_monthly(spark, sf_dir), exact_scale=EXACT), path)
    return SK.read_annual(spark, path, S.ANNUAL_COLUMNS)


@register("annual_refresh")
def q_annual_refresh(spark, sf_dir):
    """Materialize from the observations known before MATERIALIZED_BEFORE,
    then refresh the previous year from all observations."""
    path = scratch_path(spark, "annual")
    obs = FX.obs_li(spark, sf_dir)
    early = obs.filter(F.col("date") < F.lit(MATERIALIZED_BEFORE))
    st = FX.st_sup(spark, sf_dir)
    annual = lambda o: S.annual_summary(
        S.monthly_summary(S.daily_summary(o, st), exact_scale=EXACT), exact_scale=EXACT)
    SK.materialize_annual(annual(early), path)
    SK.refresh_annual(annual(obs.filter(F.col("year") == REFRESH_AS_OF.year - 1)), path, as_of=REFRESH_AS_OF)
    return SK.read_annual(spark, path, S.ANNUAL_COLUMNS)


@register("src_parquet_declared_schema")
def q_src_parquet_declared_schema(spark, sf_dir):
    return SK.read_observations(spark, FX.observations_table(spark, sf_dir))


@register("sink_append_stations")
def q_sink_append_stations(spark, sf_dir):
    path = scratch_path(spark, "stations")
    st = FX.st_sup(spark, sf_dir)
    SK.append_stations(st.filter(F.col("state") < "B"), path)
    SK.append_stations(st.filter(~(F.col("state") < "B")), path)
    return SK.read_stations(spark, path)


@register("sink_append_partitioned")
def q_sink_append_partitioned(spark, sf_dir):
    path = scratch_path(spark, "observations")
    obs = FX.obs_li(spark, sf_dir)
    # two loads: first half of the period, then the rest
    SK.append_observations(obs.filter(F.col("year") <= 1998), path)
    SK.append_observations(obs.filter(F.col("year") > 1998), path)
    return SK.read_observations(spark, path)


def _fresh_db(spark):
    db = f"stationlake_{_uuid.uuid4().hex[:10]}"
    return db, scratch_path(spark, db)


@register("sink_create_table")
def q_sink_create_table(spark, sf_dir):
    db, loc = _fresh_db(spark)
    SK.create_tables(spark, db, loc)
    SK.append_stations(FX.st_sup(spark, sf_dir), f"{db}.stations", is_table=True)
    SK.append_observations(FX.obs_li(spark, sf_dir), f"{db}.observations", is_table=True)
    SK.create_tables(spark, db, loc, recreate=True)  # drops the filled tables with their rows
    SK.append_stations(FX.st_sup(spark, sf_dir), f"{db}.stations", is_table=True)
    SK.append_observations(FX.obs_li(spark, sf_dir), f"{db}.observations", is_table=True)
    counts = [(t, spark.table(f"{db}.{t}").count()) for t in ("stations", "observations")]
    spark.sql(f"DROP DATABASE `{db}` CASCADE")
    return spark.createDataFrame(counts, "table_name string, row_count long")


@register("sink_register_files")
def q_sink_register_files(spark, sf_dir):
    """Files written straight into the table's folder become table data once
    the partitions are registered."""
    db, loc = _fresh_db(spark)
    SK.create_tables(spark, db, loc)
    SK.append_observations(FX.obs_li(spark, sf_dir), f"{loc}/observations")
    SK.register_files(spark, f"{db}.observations")
    return spark.table(f"{db}.observations").select(*OBSERVATION_COLUMNS)


@register("sink_register_outside")
def q_sink_register_outside(spark, sf_dir):
    """Files in a folder of their own become partitions of a catalog table where they lie."""
    db, loc = _fresh_db(spark)
    SK.create_tables(spark, db, loc)
    SK.register_outside(spark, f"{db}.observations", FX.observations_table(spark, sf_dir))
    return spark.table(f"{db}.observations").select(*OBSERVATION_COLUMNS)


@register("annual_table")
def q_annual_table(spark, sf_dir):
    """The annual summary as a named table, one year of it replaced."""
    db, loc = _fresh_db(spark)
    SK.create_database(spark, db, loc)
    obs = FX.obs_li(spark, sf_dir)
    st = FX.st_sup(spark, sf_dir)
    annual = lambda o: S.annual_summary(
        S.monthly_summary(S.daily_summary(o, st), exact_scale=EXACT), exact_scale=EXACT)
    SK.create_annual_table(annual(obs.filter(F.col("date") < F.lit(MATERIALIZED_BEFORE))), f"{db}.annual")
    SK.refresh_annual_table(spark, annual(obs.filter(F.col("year") == 2000)), f"{db}.annual", 2000)
    return spark.table(f"{db}.annual").select(*S.ANNUAL_COLUMNS)


@register("monthly_summary_ordered")
def q_monthly_summary_ordered(spark, sf_dir):
    """The ordered monthly summary in files; each row with its position in them."""
    path = scratch_path(spark, "monthly-ordered")
    df = _monthly(spark, sf_dir)
    SK.write_ordered(df, path, S.MONTHLY_ORDER, max_records_per_file=500)
    return SK.read_ordered(spark, path, df.schema)


@register("temp_anomaly_ordered")
def q_temp_anomaly_ordered(spark, sf_dir):
    path = scratch_path(spark, "anomaly-ordered")
    df = S.temp_anomaly(_monthly(spark, sf_dir), BASELINE_FROM, BASELINE_TO, REPORT_FROM, exact_scale=EXACT)
    SK.write_ordered(df, path, S.ANOMALY_ORDER)
    return SK.read_ordered(spark, path, df.schema)


@register("describe_table")
def q_describe_table(spark, sf_dir):
    obs = SK.read_observations(spark, FX.observations_table(spark, sf_dir))
    return TB.describe_table(obs, ["year", "month"], counts=True)


@register("column_profile")
def q_column_profile(spark, sf_dir):
    obs = SK.read_observations(spark, FX.observations_table(spark, sf_dir))
    return TB.column_profile(obs, ["year", "month"])


@register("table_files")
def q_table_files(spark, sf_dir):
    """Rows of each partition folder, from the files' footers."""
    path = FX.observations_table(spark, sf_dir, max_records_per_file=FX.small_file_rows(spark, sf_dir))
    return TB.folder_facts(spark, path, OBSERVATIONS_SCHEMA, ["year", "month"]).select("year", "month", "row_count")


@register("compact_files")
def q_compact_files(spark, sf_dir):
    path = scratch_path(spark, "observations")
    SK.append_observations(FX.obs_li(spark, sf_dir), path, max_records_per_file=FX.small_file_rows(spark, sf_dir))
    compact(spark, path, OBSERVATIONS_SCHEMA, PARTITION_COLUMNS)
    return SK.read_observations(spark, path)


# --- raw file parsing ------------------------------------------------------------

def _parsed_csv(spark, sf_dir):
    return OC.read_observations_csv(spark, FX.observation_files(spark, sf_dir))


def _parsed_stations(spark, sf_dir):
    return FW.read_stations_fixed_width(spark, FX.station_file(spark, sf_dir))


@register("src_stations_fixed_width")
def q_src_stations_fixed_width(spark, sf_dir):
    return FW.accepted(_parsed_stations(spark, sf_dir))


@register("src_observations_csv")
def q_src_observations_csv(spark, sf_dir):
    return OC.accepted(_parsed_csv(spark, sf_dir))


@register("parse_dates")
def q_parse_dates(spark, sf_dir):
    p = _parsed_csv(spark, sf_dir)
    return p.filter(F.coalesce(F.col("reject_reason"), F.lit("")) != "too_few_fields") \
        .select("station_id", "date_text", "date")


@register("observation_time_batch")
def q_observation_time_batch(spark, sf_dir):
    p = _parsed_csv(spark, sf_dir)
    return p.filter(F.col("reject_reason").isNull()) \
        .select("station_id", "date", "element", "time_text", "observation_time")


@register("reject_report")
def q_reject_report(spark, sf_dir):
    return Q.reject_report(("observations", OC.rejects(_parsed_csv(spark, sf_dir))),
                           ("stations", FW.rejects(_parsed_stations(spark, sf_dir))),
                           ("messages", M.dead_letters(_validated(spark, sf_dir))))


# --- messages and streaming -------------------------------------------------------


def _validated(spark, sf_dir):
    return M.validate_messages(FX.messages(spark, sf_dir).withColumnRenamed("event_id", "message_id"))


@register("validate_messages")
def q_validate_messages(spark, sf_dir):
    return _validated(spark, sf_dir).select(F.col("message_id").alias("event_id"), "reject_reason")


@register("message_status")
def q_message_status(spark, sf_dir):
    return M.message_status(_validated(spark, sf_dir)).withColumnRenamed("message_id", "event_id")


@register("message_batch_status")
def q_message_batch_status(spark, sf_dir):
    """Queue events read from the landing folder; outcome per event."""
    recs = M.read_queue_events(spark, FX.queue_event_dir(spark, sf_dir))
    v = M.validate_messages(recs).withColumn("batch_id", F.col("event_id").cast("long"))
    return M.batch_status(v, "batch_id")


@register("src_envelope_base64")
def q_src_envelope_base64(spark, sf_dir):
    return _validated(spark, sf_dir).select(F.col("message_id").alias("event_id"), "envelope", "station_id")


@register("observation_time_stream")
def q_observation_time_stream(spark, sf_dir):
    v = _validated(spark, sf_dir)
    return v.filter(F.col("reject_reason").isNull() | (F.col("reject_reason") == "invalid_observation_time")) \
        .select(F.col("message_id").alias("event_id"), "observation_time_text", "observation_time")


@register("src_json_file")
def q_src_json_file(spark, sf_dir):
    return M.accepted(M.validate_messages(M.read_message_files(spark, FX.message_files(spark, sf_dir))))


@register("src_message_batch")
def q_src_message_batch(spark, sf_dir):
    v = M.validate_messages(M.read_queue_events(spark, FX.queue_event_dir(spark, sf_dir)))
    return M.accepted(v, [F.col("message_id").cast("long").alias("event_id")])


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """readStream over the landing folder, several micro-batches, one
    idempotent write per batch; returns the accepted observations."""
    log = scratch_path(spark, "message-log")
    q = STR.start_ingest(spark, FX.queue_event_dir(spark, sf_dir), log, scratch_path(spark, "ingest-ckpt"),
                         max_files_per_trigger=2)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return STR.accepted_observations(spark, log).select(F.col("message_id").cast("long").alias("event_id"),
                                                        *OBSERVATION_COLUMNS)


# --- table versions ----------------------------------------------------------------

KEY = FX.ORDER_KEY
ASOF_SNAPSHOT = 3
ASOF_TIMESTAMP = _dt.datetime(1999, 6, 30)
NOW = _dt.datetime(2002, 1, 2, 0, 30)
MINUTES_AGO = 60
ASOF_WHERE = "o_orderstatus = 'F' AND o_totalprice > 100000"
DIFF_FROM, DIFF_TO = 7, 9
RESTORE_TO = 7
EXPIRE_BEFORE = _dt.datetime(2001, 6, 1)
RETAIN_LAST = 2
BAG_FROM, BAG_TO = 5, 9


def _log(spark, sf_dir):
    path = FX.version_table(spark, sf_dir)
    return VL.read_changes(spark, path, FX.ORDER_SCHEMA), VL.read_commits(spark, path)


@register("asof_snapshot_id")
def q_asof_snapshot_id(spark, sf_dir):
    chg, commits = _log(spark, sf_dir)
    return V.as_of(chg, KEY, V.resolve_bound(commits, snapshot_id=ASOF_SNAPSHOT), commits)


@register("asof_timestamp")
def q_asof_timestamp(spark, sf_dir):
    chg, commits = _log(spark, sf_dir)
    return V.as_of(chg, KEY, V.resolve_bound(commits, timestamp=ASOF_TIMESTAMP), commits)


@register("asof_minutes_ago")
def q_asof_minutes_ago(spark, sf_dir):
    chg, commits = _log(spark, sf_dir)
    return V.as_of(chg, KEY, V.resolve_bound(commits, minutes_ago=MINUTES_AGO, now=NOW), commits)


@register("asof_latest")
def q_asof_latest(spark, sf_dir):
    chg, commits = _log(spark, sf_dir)
    return V.as_of(chg, KEY, V.resolve_bound(commits), commits)


@register("asof_where_limit")
def q_asof_where_limit(spark, sf_dir):
    chg, commits = _log(spark, sf_dir)
    return V.as_of_query(chg, commits, KEY, where=ASOF_WHERE, limit=LIMIT_N)


@register("list_snapshots")
def q_list_snapshots(spark, sf_dir):
    return V.list_snapshots(VL.read_commits(spark, FX.version_table(spark, sf_dir)))


@register("version_diff")
def q_version_diff(spark, sf_dir):
    chg, _ = _log(spark, sf_dir)
    return V.version_diff(chg, KEY, F.lit(DIFF_FROM), F.lit(DIFF_TO))


@register("version_restore")
def q_version_restore(spark, sf_dir):
    chg, commits = _log(spark, sf_dir)
    new_id = commits.agg(F.max("commit_id") + 1).scalar()
    return V.restore_changes(chg, KEY, F.lit(RESTORE_TO), new_id, V.resolve_bound(commits))


@register("version_audit")
def q_version_audit(spark, sf_dir):
    chg, commits = _log(spark, sf_dir)
    return V.version_audit(chg, commits, KEY, V.keys_changed_more_than_once(chg, KEY))


@register("version_diff_bag")
def q_version_diff_bag(spark, sf_dir):
    """Two versions of a table without a key, from its change log."""
    return V.version_diff_bag(FX.bag_change_log(spark, sf_dir), F.lit(BAG_FROM), F.lit(BAG_TO))


@register("table_diff_bag")
def q_table_diff_bag(spark, sf_dir):
    """Two states of a table without a key, row by row."""
    log = FX.bag_change_log(spark, sf_dir).drop("op")
    before = log.filter(F.col("commit_id") <= 7).drop("commit_id")
    after = log.filter(~F.col("commit_id").isin(2, 8)).drop("commit_id")
    return V.bag_difference(before, after)


def _expired(spark, sf_dir, **keep):
    path = FX.write_version_table(spark, sf_dir)
    VL.expire(spark, path, FX.ORDER_SCHEMA, KEY, **keep)
    return VL.read_changes(spark, path, FX.ORDER_SCHEMA)


@register("expire_older_than")
def q_expire_older_than(spark, sf_dir):
    """The log of a table after a real expiry: base, then later commits."""
    return _expired(spark, sf_dir, older_than=EXPIRE_BEFORE)


@register("expire_retain_last")
def q_expire_retain_last(spark, sf_dir):
    return _expired(spark, sf_dir, retain_last=RETAIN_LAST)


# --- JOB-1 ----------------------------------------------------------------------

JOB_RUN_DATE = _dt.date(2000, 6, 15)


@register("daily_job")
def q_daily_job(spark, sf_dir):
    """The whole daily run over the raw files; returns the annual table."""
    res = daily_run(spark, FX.station_file(spark, sf_dir), FX.observation_files(spark, sf_dir),
                    scratch_path(spark, "warehouse"), JOB_RUN_DATE, filter_stations=True, all_years=True, exact_scale=EXACT)
    return SK.read_annual(spark, res["annual"], S.ANNUAL_COLUMNS)


@register("daily_job_rerun")
def q_daily_job_rerun(spark, sf_dir):
    """A load of all years, then of one year of the same source, with its refresh and a compaction; the annual table."""
    args = (FX.station_file(spark, sf_dir), FX.observation_files(spark, sf_dir), scratch_path(spark, "warehouse"))
    daily_run(spark, *args, JOB_RUN_DATE, filter_stations=True, all_years=True, exact_scale=EXACT)
    res = daily_run(spark, *args, JOB_RUN_DATE, filter_stations=True, year=1998, compact=True, exact_scale=EXACT)
    return SK.read_annual(spark, res["annual"], S.ANNUAL_COLUMNS)

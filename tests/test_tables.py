"""Ordered files, files from outside, the named annual table and facts about tables."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from stationlake.operators import summaries as S
from stationlake.operators import tables as TB
from stationlake.session import scratch_path
from stationlake.sinks import tables as SK
from stationlake.sources import fixtures as FX
from tests.conftest import SF_SMALL
from tests.test_plans import plan


@pytest.fixture
def db(spark):
    name = f"t_{uuid.uuid4().hex[:10]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def monthly(spark):
    return S.monthly_summary(S.daily_summary(FX.obs_li(spark, SF_SMALL), FX.st_sup(spark, SF_SMALL)))


def test_files_read_in_order_are_sorted_and_a_hot_station_is_split(spark):
    rows = [("HOT", 1900 + i // 12, 1 + i % 12, float(i)) for i in range(3000)] + [(f"S{i:03d}", 2000, 1, 0.0) for i in range(200)]
    df = spark.createDataFrame(rows, "station_id string, year int, month int, avg_temp double").repartition(7)
    path = scratch_path(spark, "ordered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        SK.write_ordered(df, path, S.MONTHLY_ORDER, max_records_per_file=150)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    names = sorted(spark.read.parquet(path).inputFiles(), key=lambda f: f.rsplit("/", 1)[1])
    read, hot = [], set()
    for f in names:
        part = [(r["station_id"], r["year"], r["month"]) for r in spark.read.parquet(f).collect()]
        if any(r[0] == "HOT" for r in part):
            hot.add(f.rsplit("/", 1)[1].split("-")[1])
        read += part
    assert read == sorted(read) and len(read) == 3200
    assert len(hot) > 2  # tasks that hold rows of the hot station
    back = SK.read_ordered(spark, path, df.schema).orderBy("position").collect()
    assert [(r["station_id"], r["year"], r["month"]) for r in back] == read and [r["position"] for r in back] == list(range(1, 3201))


def test_ordered_summaries(spark):
    m = S.monthly_summary(S.daily_summary(FX.obs_li(spark, SF_SMALL), FX.st_sup(spark, SF_SMALL)), ordered=True)
    rows = [(r["station_id"], r["year"], r["month"]) for r in m.collect()]
    assert rows == sorted(rows) and "rangepartitioning(station_id" in plan(m)
    a = [(r["year"], r["month"], r["station_id"]) for r in S.temp_anomaly(m, 1995, 1997, 1999, ordered=True).collect()]
    assert a and a == sorted(a)


def test_default_scale_agrees_with_exact_scale(spark):
    daily = S.daily_summary(FX.obs_li(spark, SF_SMALL), FX.st_sup(spark, SF_SMALL))
    keys = ["station_id", "year"]
    plain, exact = (S.annual_summary(S.monthly_summary(daily, exact_scale=e), exact_scale=e).orderBy(*keys).collect() for e in (None, 2))
    assert len(plain) == len(exact) > 0
    for p, e in zip(plain, exact):
        assert all(x == pytest.approx(y, rel=1e-9) if isinstance(x, float) else x == y for x, y in zip(p, e))


def test_files_from_outside_become_rows_without_a_copy(spark, db):
    outside = FX.observations_table(spark, SF_SMALL)
    SK.create_tables(spark, db, scratch_path(spark, db))
    table = f"{db}.observations"
    n = SK.register_outside(spark, table, outside)
    assert n == SK.read_observations(spark, outside).select("year", "month").distinct().count()
    assert spark.table(table).count() == SK.read_observations(spark, outside).count()
    assert all(outside.split(":", 1)[-1] in f for f in spark.table(table).inputFiles())
    assert SK.register_outside(spark, table, outside) == 0  # the same folders again
    other = scratch_path(spark, "elsewhere")
    SK.append_observations(FX.obs_li(spark, SF_SMALL).filter("year = 1998"), other)
    with pytest.raises(ValueError, match="already holds"):
        SK.register_outside(spark, table, other)
    flat = scratch_path(spark, "flat")
    FX.obs_li(spark, SF_SMALL).limit(3).write.parquet(flat)
    with pytest.raises(ValueError, match="no year"):
        SK.register_outside(spark, table, flat)


def test_files_under_a_layout_of_their_own(spark, db):
    root = scratch_path(spark, "drops")
    obs = FX.obs_li(spark, SF_SMALL).filter("year = 1998 and month = 3").drop("year", "month")
    obs.write.parquet(f"{root}/1998/03/a")
    SK.create_tables(spark, db, scratch_path(spark, db))
    assert SK.register_outside(spark, f"{db}.observations", root, pattern=r"/(\d{4})/(\d{2})/[^/]*/[^/]*$") == 1
    assert spark.table(f"{db}.observations").filter("year = 1998 and month = 3").count() == obs.count()


def test_annual_table_loses_a_year_that_became_empty(spark, db):
    SK.create_database(spark, db, scratch_path(spark, db))
    annual = S.annual_summary(monthly(spark))
    SK.create_annual_table(annual, f"{db}.annual")
    years = lambda: {r["year"] for r in spark.table(f"{db}.annual").select("year").distinct().collect()}
    before = years()
    SK.refresh_annual_table(spark, annual.filter("year <> 1999"), f"{db}.annual", 1999)
    assert years() == before - {1999}
    SK.refresh_annual_table(spark, annual, f"{db}.annual", 1999)
    assert years() == before and spark.table(f"{db}.annual").count() == annual.count()


def test_annual_folder_loses_a_year_that_became_empty(spark):
    path = scratch_path(spark, "annual")
    annual = S.annual_summary(monthly(spark))
    SK.materialize_annual(annual, path)
    SK.refresh_annual(annual.filter("year <> 2000"), path, as_of=dt.date(2001, 1, 1))
    assert spark.read.parquet(path).filter("year = 2000").count() == 0


def test_describe_runs_no_job_and_counts_come_from_footers(spark):
    path = FX.observations_table(spark, SF_SMALL)
    obs = SK.read_observations(spark, path)
    assert "Scan" not in plan(TB.describe_table(obs, ["year", "month"])).replace("LocalTableScan", "").replace("Scan ExistingRDD", "")
    with TB.footer_settings(spark):
        p = plan(TB.footer_counts(spark, path, SK.OBSERVATIONS_SCHEMA, ["year", "month"]))
    assert "PushedAggregation: [COUNT(*)]" in p and "station_id" not in p
    facts = TB.folder_facts(spark, path, SK.OBSERVATIONS_SCHEMA, ["year", "month"])
    want = {(r["year"], r["month"]): r["count"] for r in obs.groupBy("year", "month").count().collect()}
    assert {(r["year"], r["month"]): r["row_count"] for r in facts.collect()} == want
    listed = TB.table_files(spark, path, ["year", "month"])
    assert facts.agg(F.sum("file_count"), F.sum("total_bytes")).first() == listed.agg(F.count("*"), F.sum("file_size")).first()


def test_gzip_lines_are_dealt_out_before_they_are_parsed(spark, tmp_path):
    import gzip

    from stationlake.sources import observations_csv as OC
    with gzip.open(tmp_path / "1999.csv.gz", "wt") as f:
        f.writelines(f"S{i},19990105,TMAX,{i},,,a,\n" for i in range(500))
    parsed = OC.read_observations_csv(spark, str(tmp_path))
    assert parsed.rdd.getNumPartitions() > 1
    p = plan(parsed, "simple")
    assert p.index("from_csv") < p.index("Exchange hashpartitioning(_file")  # plans read from the bottom up
    assert OC.accepted(parsed).count() == 500


def test_rejects_are_found_without_values_and_times(spark):
    from stationlake.sources import observations_csv as OC
    parsed = OC.read_observations_csv(spark, FX.observation_files(spark, SF_SMALL))
    p = plan(OC.rejects(parsed).groupBy("reject_reason").count(), "extended").split("== Optimized Logical Plan ==")[1]
    assert "try_to_timestamp" not in p and "gettimestamp" not in p and "/ 10.0" not in p

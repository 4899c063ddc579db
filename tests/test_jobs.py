"""The daily job and maintenance: reruns do not duplicate, refresh replaces
one year, compaction keeps the content."""

import datetime as dt


from stationlake.operators import summaries as S
from stationlake.operators import tables as TB
from stationlake.operators.tables import content_fingerprint
from stationlake.plans.jobs import LOADED_PARTITIONS, LOADED_SCHEMA, daily_run
from stationlake.plans import maintenance as MT
from stationlake.session import scratch_path
from stationlake.sinks import tables as SK
from stationlake.sources import fixtures as FX
from stationlake.sources import fixed_width as FW
from stationlake.sources import observations_csv as OC
from tests.conftest import SF_SMALL


def test_daily_job_rerun_is_idempotent(spark):
    wh = scratch_path(spark, "wh")
    args = (FX.station_file(spark, SF_SMALL), FX.observation_files(spark, SF_SMALL), wh, dt.date(2000, 6, 15))
    first = daily_run(spark, *args, all_years=True)
    n_obs = SK.read_observations(spark, first["observations"]).count()
    n_annual = spark.read.parquet(first["annual"]).count()
    n_rej = spark.read.parquet(first["rejects"]).count()
    parsed = OC.read_observations_csv(spark, FX.observation_files(spark, SF_SMALL))
    assert n_obs == OC.accepted(parsed).count()
    st = FW.read_stations_fixed_width(spark, FX.station_file(spark, SF_SMALL))
    assert n_rej == OC.rejects(parsed).count() + FW.rejects(st).count()
    again = daily_run(spark, *args, all_years=True)
    assert SK.read_observations(spark, again["observations"]).count() == n_obs
    assert spark.read.parquet(again["annual"]).count() == n_annual
    assert spark.read.parquet(again["rejects"]).count() == n_rej
    dq = {r["table_name"]: r["row_count"] for r in again["dq"].collect()}
    assert dq["stations"] == FW.accepted(st).count()


def _one_line_file(tmp_path, name, *lines):
    (tmp_path / name).write_text("".join(x + "\n" for x in lines))
    return str(tmp_path / name)


def test_two_files_of_one_month_add_up(spark, tmp_path):
    st, run = FX.station_file(spark, SF_SMALL), dt.date(2000, 6, 15)
    wh = scratch_path(spark, "wh")
    a = _one_line_file(tmp_path, "a.csv", "S1,19990105,TMAX,100,,,a,", "S1,19980105,TMAX,100,,,a,")
    b = _one_line_file(tmp_path, "b.csv", "S2,19990106,TMIN,-20,,,a,")
    for f in (a, b, a):  # loading a source again replaces its rows only
        res = daily_run(spark, st, f, wh, run)
    rows = SK.read_observations(spark, res["observations"]).select("station_id", "year").collect()
    assert sorted(map(tuple, rows)) == [("S1", 1999), ("S2", 1999)]  # the year before the run
    assert sorted(r["station_id"] for r in SK.read_observations(
        spark, daily_run(spark, st, a, scratch_path(spark, "wh"), run, year=1998)["observations"]).collect()) == ["S1"]
    only = daily_run(spark, st, a, scratch_path(spark, "wh"), run, stations_only=True)
    assert "observations" not in only and SK.read_stations(spark, only["stations"]).count() > 0


def test_recreate_drops_the_rows(spark):
    import uuid
    db = f"recreate_{uuid.uuid4().hex[:8]}"
    loc = scratch_path(spark, db)
    SK.create_tables(spark, db, loc)
    for _ in range(2):
        SK.append_stations(FX.st_sup(spark, SF_SMALL), f"{db}.stations", is_table=True)
        n = spark.table(f"{db}.stations").count()
        SK.create_tables(spark, db, loc, recreate=True)
        assert n == FX.st_sup(spark, SF_SMALL).count() and spark.table(f"{db}.stations").count() == 0
    spark.sql(f"DROP DATABASE `{db}` CASCADE")


def test_annual_files_are_sorted(spark):
    path = scratch_path(spark, "annual")
    monthly = S.monthly_summary(S.daily_summary(FX.obs_li(spark, SF_SMALL), FX.st_sup(spark, SF_SMALL)))
    SK.materialize_annual(S.annual_summary(monthly), path)
    for f in spark.read.parquet(path).inputFiles():
        rows = [tuple((x is not None, x) for x in r) for r in spark.read.parquet(f).select("country", "state", "station_id").collect()]
        assert rows == sorted(rows)


def test_refresh_replaces_one_year(spark):
    path = scratch_path(spark, "annual")
    monthly = S.monthly_summary(S.daily_summary(FX.obs_li(spark, SF_SMALL), FX.st_sup(spark, SF_SMALL)))
    annual = S.annual_summary(monthly)
    SK.materialize_annual(annual, path)
    before = spark.read.parquet(path).groupBy("year").count().collect()
    year = SK.refresh_annual(annual, path, as_of=dt.date(2001, 3, 1))
    assert year == 2000
    assert sorted(spark.read.parquet(path).groupBy("year").count().collect()) == sorted(before)
    SK.refresh_annual(annual, path, as_of=dt.date(2001, 3, 1), mode="append")  # the old INSERT behaviour
    counts = dict(spark.read.parquet(path).groupBy("year").count().collect())
    assert counts[2000] == 2 * dict(before)[2000]


def _fingerprint(df):
    r = content_fingerprint(df).first()
    return r["rows"], r["hash_sum"]


def _small_files(spark):
    """A table whose months of 1998 lie in many files and whose other months in one each."""
    path = scratch_path(spark, "observations")
    obs = FX.obs_li(spark, SF_SMALL)
    SK.append_observations(obs.filter("year <> 1998"), path)
    SK.append_observations(obs.filter("year = 1998"), path, max_records_per_file=9)
    return path


def test_compaction_touches_partitions_with_small_files_only(spark):
    path = _small_files(spark)
    before = _fingerprint(SK.read_observations(spark, path))
    files = {r["file_path"]: r["year"] for r in TB.table_files(spark, path, ["year", "month"]).collect()}
    res = MT.compact(spark, path, SK.OBSERVATIONS_SCHEMA, ["year", "month"], sort_by=["station_id", "date"])
    after = {r["file_path"]: r["year"] for r in TB.table_files(spark, path, ["year", "month"]).collect()}
    assert _fingerprint(SK.read_observations(spark, path)) == before
    assert {f for f, y in files.items() if y != 1998} == {f for f, y in after.items() if y != 1998}
    assert not {f for f, y in files.items() if y == 1998} & set(after)
    assert res["files_after"] == res["partitions"] == sum(y == 1998 for y in after.values()) < res["files_before"]
    again = MT.compact(spark, path, SK.OBSERVATIONS_SCHEMA, ["year", "month"])
    assert again["partitions"] == 0
    one = next(f for f, y in after.items() if y == 1998)
    rows = [(r["station_id"], r["date"]) for r in spark.read.parquet(one).collect()]
    assert rows == sorted(rows)


def test_files_are_packed_by_size(spark):
    path = _small_files(spark)
    sizes = [r["file_size"] for r in TB.table_files(spark, path, ["year", "month"]).filter("year = 1998 and month = 5").collect()]
    plan = MT.small_file_plan(spark, path, ["year", "month"], 3 * max(sizes))
    bins = plan.filter("year = 1998 and month = 5").groupBy("bin").count().collect()
    assert len(bins) > 1 and all(1 <= r["count"] <= 4 for r in bins) and sum(r["count"] for r in bins) == len(sizes)
    assert plan.filter("year <> 1998").count() == 0


def test_an_interrupted_compaction_is_finished(spark, monkeypatch):
    import pytest
    path = _small_files(spark)
    before = _fingerprint(SK.read_observations(spark, path))
    calls = []

    def crash(*a, _real=MT.finish_compaction):
        calls.append(a)
        if len(calls) == 2:  # staged and checked, not yet in place
            raise RuntimeError("lost driver")
        return _real(*a)

    monkeypatch.setattr(MT, "finish_compaction", crash)
    with pytest.raises(RuntimeError):
        MT.compact(spark, path, SK.OBSERVATIONS_SCHEMA, ["year", "month"])
    monkeypatch.undo()
    assert _fingerprint(SK.read_observations(spark, path)) == before
    # a crash while partitions are replaced: one of them is gone from the table
    gone = SK.read_observations(spark, path).filter("year = 1998").select("month").first()["month"]
    from stationlake.sinks.version_log import remove, subfolders
    remove(spark, f"{path}/year=1998/month={gone}")
    MT.finish_compaction(spark, path, SK.OBSERVATIONS_SCHEMA, ["year", "month"])
    assert _fingerprint(SK.read_observations(spark, path)) == before
    assert subfolders(spark, f"{path}_compaction") == []
    assert MT.compact(spark, path, SK.OBSERVATIONS_SCHEMA, ["year", "month"])["partitions"] == 0


def test_daily_run_compacts_and_reads_what_it_compacted(spark, tmp_path):
    st, wh = FX.station_file(spark, SF_SMALL), scratch_path(spark, "wh")
    a = _one_line_file(tmp_path, "a.csv", *[f"S{i},1999010{i},TMAX,100,,,a," for i in range(1, 6)])
    first = daily_run(spark, st, a, wh, dt.date(2000, 6, 15), compact=True)
    path = first["observations"]
    # the load now lies in several files
    stored = spark.read.schema(LOADED_SCHEMA).parquet(path)
    rows = stored.collect()
    load = rows[0]["load_id"]
    (spark.createDataFrame(rows, stored.schema).drop("load_id", "year", "month").coalesce(1).write.mode("overwrite")
     .option("maxRecordsPerFile", 1).parquet(f"{path}/load_id={load}/year=1999/month=1"))
    b = _one_line_file(tmp_path, "b.csv", "S9,19990209,TMIN,-20,,,a,")
    second = daily_run(spark, st, b, wh, dt.date(2000, 6, 16), compact=True)
    assert second["compacted"][0]["files_before"] == 5 and second["compacted"][0]["files_after"] == 1
    assert second["observations"] == path and SK.read_observations(spark, path).count() == 6
    third = daily_run(spark, st, b, wh, dt.date(2000, 6, 17), compact=True)
    assert third["compacted"][0]["partitions"] == 0 and SK.read_observations(spark, path).count() == 6
    files = TB.table_files(spark, path, LOADED_PARTITIONS).count()
    assert files == 2
    assert {r["table_name"]: r["row_count"] for r in third["dq"].collect()}["stations"] > 0


def test_stations_are_compacted_too(spark):
    path = scratch_path(spark, "stations")
    FX.st_sup(spark, SF_SMALL).coalesce(1).write.option("maxRecordsPerFile", 2).parquet(f"{path}/load_id=2000-01-01")
    from stationlake.plans.jobs import STORED_STATIONS_SCHEMA
    before = _fingerprint(SK.read_stations(spark, path))
    res = MT.compact(spark, path, STORED_STATIONS_SCHEMA, ["load_id"], sort_by=["station_id"])
    assert res["files_after"] == 1 < res["files_before"] and _fingerprint(SK.read_stations(spark, path)) == before


def test_a_source_loaded_for_all_years_and_then_for_one_adds_nothing(spark, tmp_path):
    st, wh, run = FX.station_file(spark, SF_SMALL), scratch_path(spark, "wh"), dt.date(2000, 6, 15)
    lines = ["S1,19990105,TMAX,100,,,a,", "S1,19980105,TMAX,100,,,a,", "S1,19980106,TMAX,120,,,a,"]
    a = _one_line_file(tmp_path, "a.csv", *lines)
    daily_run(spark, st, a, wh, run, all_years=True)
    res = daily_run(spark, st, a, wh, run, year=1998)
    assert SK.read_observations(spark, res["observations"]).count() == 3
    _one_line_file(tmp_path, "a.csv", lines[0])  # the file lost its rows of 1998
    res = daily_run(spark, st, a, wh, run, year=1998)
    assert [r["year"] for r in SK.read_observations(spark, res["observations"]).collect()] == [1999]
    res = daily_run(spark, st, a, wh, run, all_years=True)
    assert SK.read_observations(spark, res["observations"]).count() == 1


def test_every_loaded_year_is_refreshed_also_when_it_became_empty(spark, tmp_path):
    st, wh, run = FX.station_file(spark, SF_SMALL), scratch_path(spark, "wh"), dt.date(2000, 6, 15)
    ids = [r["station_id"] for r in FW.accepted(FW.read_stations_fixed_width(spark, st)).limit(1).collect()]
    lines = [f"{ids[0]},{y}0105,TMAX,100,,,a," for y in (1997, 1998, 1999)]
    a = _one_line_file(tmp_path, "a.csv", *lines)
    annual = daily_run(spark, st, a, wh, run, all_years=True)["annual"]
    years = lambda: sorted(r["year"] for r in spark.read.parquet(annual).collect())
    assert years() == [1997, 1998, 1999]
    _one_line_file(tmp_path, "a.csv", lines[0].replace(",100,", ",300,"), lines[2])
    daily_run(spark, st, a, wh, run, year=1997)  # neither the run's previous year nor a new one
    got = {r["year"]: r["yearly_highest_max_temp"] for r in spark.read.parquet(annual).collect()}
    assert got == {1997: 30.0, 1998: 10.0, 1999: 10.0}
    daily_run(spark, st, a, wh, run, year=1998)
    assert years() == [1997, 1999]


def test_bad_values_fail_before_anything_is_written(spark, tmp_path):
    import pytest
    st, wh = FX.station_file(spark, SF_SMALL), scratch_path(spark, "wh")
    a = _one_line_file(tmp_path, "a.csv", "S1,19990105,TMAX,abc,,,a,", "S1,19990106,TMAX,1,,,a,")
    with pytest.raises(ValueError):
        daily_run(spark, st, a, wh, dt.date(2000, 6, 15), on_bad_value="fail")
    from stationlake.sinks.version_log import exists
    assert not exists(spark, f"{wh}/observations")
    res = daily_run(spark, st, a, wh, dt.date(2000, 6, 15))
    assert SK.read_observations(spark, res["observations"]).count() == 1


def test_the_default_year_is_the_one_before_the_run(spark, tmp_path):
    a = _one_line_file(tmp_path, "a.csv", "S1,19990105,TMAX,100,,,a,", "S1,20000105,TMAX,100,,,a,")
    res = daily_run(spark, FX.station_file(spark, SF_SMALL), a, scratch_path(spark, "wh"), dt.date(2000, 6, 15))
    assert [r["year"] for r in SK.read_observations(spark, res["observations"]).collect()] == [1999]

"""Plan shape: pruning, pushdown, broadcast, no Python in the plans."""

import pytest

import __spark_entry__ as E
from stationlake.plans.registry import REGISTRY
from tests.conftest import SF_SMALL


def plan(df, mode="formatted"):
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_no_python_udf(spark, key):
    if key in {"stream_ingest", "sink_create_table", "sink_register_files", "sink_register_outside", "annual_refresh", "annual_table",
               "annual_materialize", "compact_files", "sink_append_stations", "sink_append_partitioned", "daily_job", "daily_job_rerun",
               "monthly_summary_ordered", "temp_anomaly_ordered", "expire_older_than", "expire_retain_last"}:
        pytest.skip("writes before it returns: its plan only reads back what was written")
    p = plan(E.queries()[key](spark, SF_SMALL), "extended")
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in p, (key, node)


def test_partition_filter_reaches_scan(spark):
    p = plan(E.queries()["scan_partition_filter"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(year" in p and "(year" in p and "(month" in p
    assert "ReadSchema: struct<station_id:string,date:date,element:string,value:double>" in p


def test_asof_timestamp_prunes_commit_folders(spark):
    p = plan(E.queries()["asof_timestamp"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(commit_id" in p and "<= Subquery subquery" in p


def test_date_filter_adds_partition_predicates(spark):
    df = E.queries()["dq_row_counts"](spark, SF_SMALL)
    p = plan(df)
    assert "PartitionFilters" in p and "(year" in p


def test_dimension_joins_are_broadcast(spark):
    p = plan(E.queries()["daily_summary"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p
    p = plan(E.queries()["semi_join_stations"](spark, SF_SMALL))
    assert "LeftSemi" in p


def test_column_pruning_on_lineitem(spark):
    p = plan(E.queries()["monthly_summary"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_extendedprice:double,l_shipdate:timestamp_ntz>" in p


def test_refresh_input_is_pruned_to_one_year(spark):
    from pyspark.sql import functions as F

    from stationlake.operators import summaries as S
    from stationlake.sinks import tables as SK
    from stationlake.sources import fixtures as FX
    obs = SK.read_observations(spark, FX.observations_table(spark, SF_SMALL))
    st = FX.st_sup(spark, SF_SMALL)
    annual = S.annual_summary(S.monthly_summary(S.daily_summary(obs.filter(F.col("year") == 1999), st)))
    p = plan(annual)
    import re
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\d+\), \(year#\d+ = 1999\)\]", p)


def test_anomaly_year_filters_reach_partition_column(spark):
    from stationlake.operators import summaries as S
    from stationlake.sinks import tables as SK
    from stationlake.sources import fixtures as FX
    obs = SK.read_observations(spark, FX.observations_table(spark, SF_SMALL))
    st = FX.st_sup(spark, SF_SMALL)
    monthly = S.monthly_summary(S.daily_summary(obs, st, keep_partitions=True))
    p = plan(S.temp_anomaly(monthly, 1995, 1997, 1999))
    import re
    assert re.search(r"PartitionFilters: \[[^\]]*\(year#\d+ >= 1999\)", p)
    assert re.search(r"PartitionFilters: \[[^\]]*\(year#\d+ >= 1995\)[^\]]*\(year#\d+ <= 1997\)", p)

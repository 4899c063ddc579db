"""A hot key holding a third of all rows: same answers, partial aggregation
before the shuffle (so the hot key moves one row per map task)."""

import pandas as pd
from pyspark.sql import functions as F

from stationlake.operators import summaries as S
from stationlake.operators import versions as V
from stationlake.sources import fixtures as FX
from tests.conftest import SF_SMALL


def explain(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_hot_station_daily_pivot(spark):
    obs = FX.obs_li(spark, SF_SMALL).withColumn(
        "station_id", F.when(F.col("value") % 3 < 1, F.lit("HOT")).otherwise(F.col("station_id")))
    hot_share = obs.filter("station_id = 'HOT'").count() / obs.count()
    assert 0.25 < hot_share < 0.45
    pivot = S.daily_pivot(obs)
    assert "partial_max" in explain(pivot)
    got = pivot.toPandas().sort_values(["station_id", "date"]).reset_index(drop=True)
    p = obs.filter(F.col("element").isin("TMAX", "TMIN", "TAVG", "PRCP", "SNOW", "SNWD")).toPandas()
    want = (p.pivot_table(index=["station_id", "date"], columns="element", values="value", aggfunc="max")
            .reset_index().sort_values(["station_id", "date"]).reset_index(drop=True))
    assert len(got) == len(want)
    for el, col in (("TMAX", "max_temp_celsius"), ("PRCP", "precipitation_mm")):
        a = got[col].fillna(-1).to_numpy()
        b = want[el].fillna(-1).to_numpy() if el in want else -1
        assert (a == b).all()


def test_hot_key_version_fold(spark):
    # key 0 is written in every commit (a third of the log), others once
    rows = [(0, float(c), "append" if c == 1 else "update", c) for c in range(1, 301)]
    rows += [(k, float(k), "append", 1 + k % 300) for k in range(1, 601)]
    chg = spark.createDataFrame(rows, "k bigint, v double, op string, commit_id bigint")
    state = V.as_of(chg, ["k"], F.lit(150))
    assert "partial_max_by" in explain(state)
    got = dict(state.select("k", "v").collect())
    df = pd.DataFrame(rows, columns=["k", "v", "op", "commit_id"])
    df = df[df.commit_id <= 150].sort_values("commit_id").groupby("k").last()
    assert got == {k: r.v for k, r in df.iterrows() if r.op != "delete"}

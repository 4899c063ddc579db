"""Work that grows with the rows, not with files or tasks: message files, small files, raw files, commits."""

import base64
import json

from pyspark.sql import functions as F

import __spark_entry__ as E
from stationlake.operators import tables as TB
from stationlake.plans import maintenance as MT
from stationlake.plans.registry import REGISTRY
from stationlake.session import scratch_path
from stationlake.sinks import tables as SK
from stationlake.sources import fixtures as FX
from stationlake.sources import messages as M
from tests.conftest import SF_SMALL
from tests.oracle_util import compare, duck


def lineitem(spark, tmp_path, n=6000):
    """A folder with a lineitem table of n rows in two months, some of them twice and one order without a date."""
    k = F.col("id")
    li = spark.range(n).select(
        F.floor(k / 7).alias("l_orderkey"), (k % 7 + 1).cast("int").alias("l_linenumber"), (k % 50).alias("l_suppkey"),
        F.when(k != 11, F.make_timestamp_ntz(F.lit(1997) + (k % 2).cast("int"), F.lit(3), (k % 28 + 1).cast("int"), F.lit(0), F.lit(0), F.lit(0))).alias("l_shipdate"),
        (k % 40).cast("double").alias("l_quantity"), (k * 1.25).cast("double").alias("l_extendedprice"),
        F.when(k % 3 == 0, "N").otherwise("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"))
    li.unionByName(li.limit(40)).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_a_file_holds_one_document_or_a_sequence(spark, tmp_path):
    good = {"station_id": "XK07", "date": "2021-11-23", "element": "TMIN", "value": -4.25}
    docs = [json.dumps(good), json.dumps(good, indent=2), "{bad", json.dumps([good]), '{"Records": []}',
            json.dumps({"message": {"data": base64.b64encode(json.dumps(good).encode()).decode()}}),
            json.dumps({"Records": [{"messageId": "a", "body": json.dumps(good)}, {"messageId": "b"}]}, indent=1)]
    (tmp_path / "alone").mkdir()
    (tmp_path / "together").mkdir()
    for i, text in enumerate(docs):
        (tmp_path / "alone" / f"{i}.json").write_text(text)
    (tmp_path / "together" / "all.json").write_text("".join(M.RECORD_MARK + text for text in docs))
    rows = lambda d: sorted(map(str, M.validate_messages(M.read_message_files(spark, str(tmp_path / d))).collect()))
    assert rows("together") == rows("alone") and len(rows("alone")) == len(docs) + 1


def test_message_files_hold_many_documents(spark):
    path = FX.message_files(spark, SF_SMALL)
    files = spark.read.text(path, wholetext=True)
    documents = FX.messages(spark, SF_SMALL).count() // FX.QUEUE_BATCH_SIZE
    assert files.count() < documents / 4
    compare(REGISTRY["src_json_file"](spark, SF_SMALL), duck(SF_SMALL), E.oracle_sql()["src_json_file"])


def test_described_tables_count_their_values(spark):
    rows = REGISTRY["describe_table"](spark, SF_SMALL).collect()
    obs = FX.obs_li(spark, SF_SMALL)
    assert {r["column_name"]: r["non_null_count"] for r in rows} == {c: obs.filter(F.col(c).isNotNull()).count() for c in obs.columns}
    compare(REGISTRY["describe_table"](spark, SF_SMALL), duck(SF_SMALL), E.oracle_sql()["describe_table"])


def test_small_files_do_not_multiply_with_the_rows(spark, tmp_path, monkeypatch):
    sf = lineitem(spark, tmp_path)
    assert FX.small_file_rows(spark, sf) == FX.SMALL_FILE_ROWS
    monkeypatch.setattr(FX, "SMALL_FILES", 6)
    path = FX.observations_table(spark, sf, max_records_per_file=FX.small_file_rows(spark, sf))
    per_folder = [r["count"] for r in TB.table_files(spark, path, ["year", "month"]).groupBy("year", "month").count().collect()]
    assert len(per_folder) == 3 and max(per_folder) > 2 and sum(per_folder) < 12  # 250 rows a file would be 25
    counted = REGISTRY["table_files"](spark, sf).agg(F.sum("row_count")).first()[0]
    assert counted == FX.obs_li(spark, sf).filter("year is not null").count()
    assert REGISTRY["compact_files"](spark, sf).count() == 6040


def test_compaction_lists_the_files_once(spark, monkeypatch):
    path = scratch_path(spark, "observations")
    SK.append_observations(FX.obs_li(spark, SF_SMALL), path, max_records_per_file=9)
    seen = []
    monkeypatch.setattr(MT, "_stage", lambda *a, _real=MT._stage: (seen.append(a[3].inputFiles()), _real(*a)))
    done = MT.compact(spark, path, SK.OBSERVATIONS_SCHEMA, ["year", "month"])
    assert done["files_before"] > done["files_after"] == done["partitions"]
    assert seen and not any(f.startswith(f"file:{path}/") or f.startswith(f"{path}/") for files in seen for f in files)


def test_raw_files_grow_in_number_and_stay_in_order(spark, tmp_path, monkeypatch):
    sf = lineitem(spark, tmp_path)
    monkeypatch.setattr(FX, "FILE_LINES", 500)
    path = FX.observation_files(spark, sf)
    files = spark.read.text(path).inputFiles()
    assert len(files) >= 13  # 6,040 lines; as many as cores before
    li = FX.table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    want = [r["value"] for r in FX.observation_lines(li.filter("year = 1998").orderBy(*FX.LINE_ORDER)).collect()]
    got = [r["value"] for f in sorted(f for f in files if "year=1998" in f) for r in spark.read.text(f).collect()]
    assert got == want
    assert spark.read.text(path).count() == 6040


def test_a_commit_is_written_by_several_tasks_in_whole_files(spark, tmp_path):
    path = str(tmp_path / "log")
    sizes = {1: 10_530, 2: 2_300, 3: 99, 4: 100, 5: 1}
    rows = None
    for commit, n in sizes.items():
        some = spark.range(n).select((F.col("id") % 500).alias("k"), F.lit(commit).cast("long").alias("commit_id"))
        rows = some if rows is None else rows.unionByName(some)
    dealt = FX.dealt_to_files(rows, "commit_id", 100, slots=8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt.write.option("maxRecordsPerFile", 100).partitionBy("commit_id").parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(path).groupBy("commit_id", F.col("_metadata.file_name").alias("f")).count().collect()
    assert {c: sum(r["commit_id"] == c for r in files) for c in sizes} == {c: -(-n // 100) for c, n in sizes.items()}
    assert len({r["f"].split("-")[1] for r in files if r["commit_id"] == 1}) > 1
    same = lambda df: sorted(map(tuple, df.select("k", "commit_id").collect()))
    assert same(spark.read.parquet(path)) == same(rows)

"""Streaming ingest: restart and replay leave each message once."""

from pyspark.sql import functions as F

from stationlake.session import scratch_path
from stationlake.sources import fixtures as FX
from stationlake.sources import messages as M
from stationlake.streaming import ingest as STR
from tests.conftest import SF_SMALL


def test_restart_and_replay_are_idempotent(spark):
    src = FX.queue_event_dir(spark, SF_SMALL)
    log, ckpt = scratch_path(spark, "log"), scratch_path(spark, "ckpt")
    q = STR.start_ingest(spark, src, log, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    first = STR.read_log(spark, log).count()
    # a restart on the same checkpoint finds nothing new
    q = STR.start_ingest(spark, src, log, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert STR.read_log(spark, log).count() == first
    # replaying batch 0 (at-least-once delivery) rewrites only its partitions
    batch0 = STR.read_log(spark, log).filter("batch_id = 0").select("message_id")
    n0 = batch0.count()
    ids = [r["message_id"] for r in batch0.collect()]
    STR.write_batch(M.read_queue_events(spark, src).filter(F.col("message_id").isin(ids)), 0, log,
                    stream_id=STR.stream_identity(ckpt))
    assert n0 > 0 and STR.read_log(spark, log).filter("batch_id = 0").count() == n0
    assert STR.read_log(spark, log).count() == first
    total = M.read_queue_events(spark, src).count()
    assert first == total
    status = STR.micro_batch_status(spark, log).agg(F.sum("processed"), F.sum("failed")).first()
    assert status[0] + status[1] == total


def test_streamed_rows_reach_the_summaries(spark):
    from stationlake.operators import summaries as S
    from stationlake.sinks import tables as SK
    obs, log = scratch_path(spark, "observations"), scratch_path(spark, "log")
    loaded = FX.obs_li(spark, SF_SMALL).limit(50)
    SK.conform(loaded, SK.OBSERVATIONS_SCHEMA).write.partitionBy("year", "month").parquet(f"{obs}/load_id=file")
    events = M.read_queue_events(spark, FX.queue_event_dir(spark, SF_SMALL))
    for _ in range(2):  # the same batch twice
        STR.write_batch(events, 3, log, obs)
    streamed = STR.accepted_observations(spark, log).count()
    table = SK.read_observations(spark, obs)
    assert streamed > 0 and table.count() == 50 + streamed
    days = S.daily_summary(table, FX.st_sup(spark, SF_SMALL))
    assert days.count() >= S.daily_summary(table.filter("measurement_flag is not null"), FX.st_sup(spark, SF_SMALL)).count() > 0


def test_clean_source_removes_consumed_files(spark):
    src = scratch_path(spark, "landing")
    spark.read.text(FX.queue_event_dir(spark, SF_SMALL)).repartition(4).write.text(src)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(src)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def data_files():
        return [s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")]

    before = len(data_files())
    total = spark.read.text(src).count()
    log, ckpt = scratch_path(spark, "log"), scratch_path(spark, "ckpt")
    q = STR.start_ingest(spark, src, log, ckpt, max_files_per_trigger=1, clean_source="delete")
    q.awaitTermination()
    assert STR.read_log(spark, log).count() == M.read_queue_events(spark, FX.queue_event_dir(spark, SF_SMALL)).count()
    assert total > 0 and before > 1
    assert len(data_files()) < before


def test_processing_time_trigger(spark):
    src = FX.queue_event_dir(spark, SF_SMALL)
    log, ckpt = scratch_path(spark, "log"), scratch_path(spark, "ckpt")
    q = STR.start_ingest(spark, src, log, ckpt, max_files_per_trigger=2, available_now=False,
                         processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert STR.read_log(spark, log).count() == M.read_queue_events(spark, src).count()
    assert STR.dead_letters(spark, log).count() + STR.accepted_observations(spark, log).count() \
        == M.read_queue_events(spark, src).count()


def test_two_streams_into_one_table_keep_all_rows(spark):
    from stationlake.sinks import tables as SK
    src = scratch_path(spark, "landing")
    spark.read.text(FX.queue_event_dir(spark, SF_SMALL)).coalesce(1).write.text(src)
    obs, log = scratch_path(spark, "observations"), scratch_path(spark, "log")
    assert STR.read_log(spark, log).count() == 0  # before the first batch
    checkpoints = [scratch_path(spark, "ckpt") for _ in range(2)]
    counts = []
    for ckpt in checkpoints:
        q = STR.start_ingest(spark, src, log, ckpt, observations_path=obs)
        q.awaitTermination()
        counts.append((STR.read_log(spark, log).count(), SK.read_observations(spark, obs).count()))
    assert counts[0][0] > 0 and counts[1] == (2 * counts[0][0], 2 * counts[0][1])
    assert STR.micro_batch_status(spark, log).select("stream_id").distinct().count() == 2
    # a replay of one stream's batch replaces its own rows only
    STR.write_batch(M.read_queue_events(spark, src), 0, log, obs, STR.stream_identity(checkpoints[1] + "/"))
    assert (STR.read_log(spark, log).count(), SK.read_observations(spark, obs).count()) == counts[1]


def test_a_batch_is_written_in_few_files(spark):
    from stationlake.operators.tables import table_files
    log = scratch_path(spark, "log")
    STR.write_batch(M.read_queue_events(spark, FX.queue_event_dir(spark, SF_SMALL)), 0, log)
    assert table_files(spark, log, STR.LOG_PARTITIONS).groupBy("year", "month", "outcome").count().filter("count > 2").count() == 0

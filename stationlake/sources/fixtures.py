"""Adapters that present the shared test tables as stations, observations,
raw files, messages and a change log.

Every adapter is a Spark plan over the given parquet tables, so its work
grows with them. Written adapters (raw text files, messages, change log)
go to the shared scratch folder and are reused within one session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlake.schemas import STATION_COLUMNS
from stationlake.session import scratch_path

_WRITTEN: dict[tuple, str] = {}


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A read-only test table. The DataFrame (with its file listing and
    footer schema) is reused within a session; every action still plans and
    reads it afresh."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def spread(df: DataFrame, key: str) -> DataFrame:
    """Each test table is one Parquet row group, i.e. one scan task. Before
    CPU-heavy per-row work (JSON rendering and parsing), hash-spread the rows
    on ``key`` when the scan gives fewer tasks than there are cores. Inputs
    with enough splits -- any real input at scale -- are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if cores > 1 and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, key)
    return df


def station_id(key: Column) -> Column:
    return F.concat(F.lit("ST"), F.lpad(key.cast("string"), 9, "0"))


def obs_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as long-form observations (one row per station, date, element)."""
    li = table(spark, sf_dir, "lineitem")
    o = obs_li_raw_columns(li)
    date = F.to_date(F.col("l_shipdate"))
    return li.select(
        o["station_id"].alias("station_id"),
        date.alias("date"),
        o["element"].alias("element"),
        F.col("l_extendedprice").cast("double").alias("value"),
        F.lit(None).cast("string").alias("measurement_flag"),
        o["quality_flag"].alias("quality_flag"),
        o["source_flag"].alias("source_flag"),
        F.lit(None).cast("timestamp_ntz").alias("observation_time"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
    )


def st_sup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stations as a stored table, whose size Spark knows when it plans a join."""
    from stationlake.sinks.tables import append_stations, read_stations

    def build():
        path = scratch_path(spark, "stations")
        append_stations(supplier_stations(spark, sf_dir), path)
        return path
    return read_stations(spark, _written(spark, ("stations", sf_dir), build))


def supplier_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier x nation x region as stations."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (s.join(n, s.s_nationkey == n.n_nationkey)
         .join(r, F.col("n_regionkey") == r.r_regionkey))
    return j.select(
        station_id(F.col("s_suppkey")).alias("station_id"),
        F.col("s_name").alias("name"),
        ((F.col("s_suppkey") * 37) % 180 - 90).cast("double").alias("latitude"),
        ((F.col("s_suppkey") * 53) % 360 - 180).cast("double").alias("longitude"),
        F.col("s_acctbal").cast("double").alias("elevation"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("state"),
        F.lit(1995).alias("first_year"),
        F.lit(2001).alias("last_year"),
    ).select(*STATION_COLUMNS)


# Regions whose stations form the "filtered" station load of the semi join.
SELECTED_REGIONS = ["AMERICA", "EUROPE"]


def st_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st_sup(spark, sf_dir).filter(F.col("state").isin(SELECTED_REGIONS))


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations rendered as fixed-width lines, with defects by s_suppkey % 10:
    7 cut to 84 characters, 3 latitude 'x', 5 first_year 'HCN', 9 blank
    elevation. Even keys are US stations (state = first two letters of the
    region)."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (s.join(n, s.s_nationkey == n.n_nationkey)
         .join(r, F.col("n_regionkey") == r.r_regionkey))
    k = F.col("s_suppkey")
    defect = k % 10
    lat = F.when(defect == 3, F.lit("x")).otherwise(
        F.format_string("%.2f", ((k * 37) % 180 - 90).cast("double")))
    lon = F.format_string("%.2f", ((k * 53) % 360 - 180).cast("double"))
    elev = F.when(defect == 9, F.lit("")).otherwise(F.floor(F.col("s_acctbal")).cast("string"))
    country = F.when(k % 2 == 0, F.lit("US")).otherwise(F.lpad(F.col("s_nationkey").cast("string"), 2, "0"))
    state = F.substring(F.col("r_name"), 1, 2)
    first = F.when(defect == 5, F.lit("HCN")).otherwise(F.lit("1995"))

    def fld(c, width):
        return F.rpad(c, width, " ")

    line = F.concat(
        fld(station_id(k), 11), F.lit(" "),
        F.lpad(lat, 8, " "), F.lit(" "),
        F.lpad(lon, 9, " "), F.lit(" "),
        F.lpad(elev, 6, " "), F.lit(" "),
        fld(country, 2), F.lit(" "),
        fld(F.col("s_name"), 30),
        fld(state, 2), F.lit(" "),
        fld(first, 4), F.lit(" "),
        F.lit("2001"), F.lit("  "),
    )
    line = F.when(defect == 7, F.substring(line, 1, 84)).otherwise(line)
    return j.select(line.alias("value"))


def _written(spark: SparkSession, key: tuple, build) -> str:
    app = spark.sparkContext.applicationId
    k = (app,) + key
    if k not in _WRITTEN:
        _WRITTEN[k] = build()
    return _WRITTEN[k]


def station_file(spark: SparkSession, sf_dir: str) -> str:
    """Write the fixed-width station lines as a text file set; return its path."""
    def build():
        path = scratch_path(spark, "stations-txt")
        station_lines(spark, sf_dir).write.mode("overwrite").text(path)
        return path
    return _written(spark, ("stations-txt", sf_dir), build)


# File order of the rendered lines: every column a line depends on, so rows
# that tie render identical lines.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag",
              "l_linestatus"]


FILE_LINES = 500_000  # about how many lines a file of observations has


def observation_lines(li: DataFrame) -> DataFrame:
    """lineitem with its ``year`` as observations (year, value), row by row in its order, rendered as CSV text (no header) with defects by
    l_orderkey % 50: 0 seven fields, 1 nine fields, 2 month 13, 3 value
    'abc', 4 time 2400, 5 time 0700, 6 time 07:30, 7 time 700, 8 quoted id.
    The value is the whole number l_quantity (stored in tenths for
    TMAX/TMIN/TAVG/PRCP)."""
    o = obs_li_raw_columns(li)
    defect = F.col("l_orderkey") % 50
    date_txt = F.when(defect == 2, F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("13"),
                                            F.date_format("l_shipdate", "dd"))
                      ).otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    value_txt = F.when(defect == 3, F.lit("abc")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    time_txt = (F.when(defect == 4, "2400").when(defect == 5, "0700").when(defect == 6, "07:30")
                .when(defect == 7, "700").otherwise(""))
    sid = F.when(defect == 8, F.concat(F.lit('"'), o["station_id"], F.lit('"'))).otherwise(o["station_id"])
    fields = [sid, date_txt, o["element"], value_txt, F.lit(""),
              F.coalesce(o["quality_flag"], F.lit("")), o["source_flag"], time_txt]
    line = (F.when(defect == 0, F.concat_ws(",", *fields[:7]))
            .when(defect == 1, F.concat_ws(",", *fields, F.lit("X")))
            .otherwise(F.concat_ws(",", *fields)))
    return li.select("year", line.alias("value"))


# l_linenumber 1..7 -> element; 7 is an element the daily pivot drops.
LINE_ELEMENTS = ["TMAX", "TMIN", "TAVG", "PRCP", "SNOW", "SNWD", "WT01"]


def obs_li_raw_columns(li: DataFrame) -> dict:
    """Columns shared by the observation adapters of lineitem."""
    element = None
    for i, e in enumerate(LINE_ELEMENTS, start=1):
        cond = F.col("l_linenumber") == i
        element = F.when(cond, e) if element is None else element.when(cond, e)
    return {
        "station_id": station_id(F.col("l_suppkey")),
        "element": element,
        "quality_flag": F.nullif(F.col("l_returnflag"), F.lit("N")),
        "source_flag": F.col("l_linestatus"),
    }


def observation_files(spark: SparkSession, sf_dir: str) -> str:
    """Write the observation CSV as gzip text, one directory per year (the
    reference loads one file per year). Range partitioning keeps each part
    file sorted, so file-name order then line order equals LINE_ORDER within
    a year; no year is forced into one task. The number of files follows from
    the rows (their count is in the table's footers), as a gzip file is read by
    one task, and lines are rendered behind the sort, so neither the sample of
    the bounds nor the shuffle sees them."""
    def build():
        path = scratch_path(spark, "observations-csv")
        li = table(spark, sf_dir, "lineitem")
        n = max(1, spark.sparkContext.defaultParallelism, -(-li.count() // FILE_LINES))
        ordered = (li.select(F.year("l_shipdate").alias("year"), *LINE_ORDER)
                   .repartitionByRange(n, "year", *LINE_ORDER)
                   .sortWithinPartitions("year", *LINE_ORDER))
        (observation_lines(ordered).write.mode("overwrite").option("compression", "gzip")
         .partitionBy("year").text(path))
        return path
    return _written(spark, ("observations-csv", sf_dir), build)


# Message defect classes by event_id % 20 (see messages oracle).
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events rendered as JSON message bodies (event_id, body)."""
    ev = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"),
                "event_id")
    cls = F.col("event_id") % 20
    sid = station_id(F.col("user_id"))
    element = (F.when(F.col("event_type") == "purchase", "TMAX").when(F.col("event_type") == "signup", "TMIN")
               .when(F.col("event_type") == "view", "TAVG").when(F.col("event_type") == "click", "PRCP")
               .when(F.col("event_type") == "error", "SNOW"))
    day = F.date_format("ts", "yyyy-MM-dd")
    hhmm = F.date_format("ts", "HH:mm")

    def obj(pairs):
        parts = [F.concat(F.lit(f'"{k}": '), v) for k, v in pairs]
        return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))

    def q(c):
        return F.concat(F.lit('"'), c, F.lit('"'))

    value_num = F.col("value").cast("string")
    sid_v = F.when(cls == 4, F.col("user_id").cast("string")).otherwise(q(sid))
    date_v = (F.when(cls == 3, q(F.date_format("ts", "yyyy/MM/dd")))
              .when(cls == 11, F.date_format("ts", "yyyyMMdd"))
              .when(cls == 13, q(F.date_format("ts", "yyyy-M-d")))
              .otherwise(q(day)))
    value_v = (F.when(cls == 2, q(F.lit("abc"))).when(cls == 7, F.lit("null"))
               .when(cls == 9, q(value_num)).when(cls == 10, F.lit("true"))
               .otherwise(value_num))
    time_v = (F.when(cls == 6, q(F.lit(""))).when(cls == 8, q(F.lit("2400"))).otherwise(q(hhmm)))
    pairs = [("station_id", sid_v), ("date", date_v), ("element", q(element)), ("value", value_v),
             ("measurement_flag", q(F.lit(""))), ("quality_flag", q(F.lit(""))),
             ("source_flag", q(F.lit(""))), ("observation_time", time_v)]
    full = obj(pairs)
    no_station = obj(pairs[1:])
    body = (F.when(cls == 0, F.substring(full, 1, 25))
            .when(cls == 1, no_station)
            .when(cls == 5, F.concat(F.lit('{"message": {"data": "'), F.regexp_replace(F.base64(F.encode(full, "UTF-8")), "[\\r\\n]", ""),
                                     F.lit('"}}')))
            .when(cls == 12, F.concat(F.lit("["), full, F.lit("]")))
            .otherwise(full))
    return ev.select("event_id", body.alias("body"))


# Change log over orders --------------------------------------------------------
ORDER_KEY = ["o_orderkey"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as a change log: commits 1..7 append the orders of 1995..2001;
    commit 8 deletes status 'P' orders with o_orderkey % 4 = 0; commit 9 adds
    1 to the price of o_orderkey % 10 = 1 orders not deleted by commit 8."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))
    appends = o.select(*ORDER_COLUMNS, F.lit("append").alias("op"),
                       (F.year("o_orderdate") - 1994).cast("long").alias("commit_id"))
    deleted = (F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 4 == 0)
    deletes = o.filter(deleted).select(*ORDER_COLUMNS, F.lit("delete").alias("op"),
                                       F.lit(8).cast("long").alias("commit_id"))
    updates = (o.filter((F.col("o_orderkey") % 10 == 1) & ~deleted)
               .withColumn("o_totalprice", F.col("o_totalprice") + 1)
               .select(*ORDER_COLUMNS, F.lit("update").alias("op"), F.lit(9).cast("long").alias("commit_id")))
    return appends.unionByName(deletes).unionByName(updates)


ORDER_SCHEMA = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
                "o_orderdate TIMESTAMP_NTZ")
COMMIT_FILE_ROWS = 1000  # most rows of a file of the order log


def order_commits(spark: SparkSession, changes: DataFrame) -> DataFrame:
    """When and what the commits of the order log are: (commit_id, parent_id, committed_at, operation)."""
    per = changes.groupBy("commit_id").agg(F.min("op").alias("first_op"))
    committed = (F.when(F.col("commit_id") <= 7,
                        F.make_timestamp_ntz((F.col("commit_id") + 1994).cast("int"), F.lit(12), F.lit(31),
                                             F.lit(0), F.lit(0), F.lit(0)))
                 .otherwise(F.make_timestamp_ntz(F.lit(2002), F.lit(1), (F.col("commit_id") - 7).cast("int"),
                                                 F.lit(0), F.lit(0), F.lit(0))))
    operation = (F.when(F.col("first_op") == "append", "append").when(F.col("first_op") == "delete", "delete")
                 .otherwise("overwrite"))
    return per.select("commit_id", F.when(F.col("commit_id") > 1, F.col("commit_id") - 1).cast("long").alias("parent_id"),
                      committed.alias("committed_at"), operation.alias("operation"))


WRITE_SLOTS = 64  # tasks that may share one commit's rows


def dealt_to_files(df: DataFrame, column: str, file_rows: int, slots: int = WRITE_SLOTS) -> DataFrame:
    """df with the rows of each value of ``column`` dealt to ``slots`` tasks in whole files of ``file_rows`` rows; what is
    over in a slot (less than a file) is gathered in one more. Written with at most that many rows a file, a value
    has ceil(rows / file_rows) files, as from one task."""
    dealt = df.withColumn("_at", F.monotonically_increasing_id()).withColumn("_slot", F.col("_at") % slots)
    slot = Window.partitionBy(column, "_slot")
    over = F.row_number().over(slot.orderBy("_at")) > F.floor(F.count("*").over(slot) / file_rows) * file_rows
    return dealt.withColumn("_slot", F.when(over, slots).otherwise(F.col("_slot"))).repartition(column, "_slot").drop("_at", "_slot")


def write_version_table(spark: SparkSession, sf_dir: str) -> str:
    """The orders as a new versioned table (see ``sinks.version_log``); returns its path."""
    from stationlake.sinks import version_log as VL
    path = scratch_path(spark, "orders-versions")
    (dealt_to_files(order_changes(spark, sf_dir), "commit_id", COMMIT_FILE_ROWS).write.option("maxRecordsPerFile", COMMIT_FILE_ROWS)
     .partitionBy("commit_id").parquet(f"{path}/log"))
    log = spark.read.schema(VL.log_schema(ORDER_SCHEMA)).parquet(f"{path}/log")
    VL.record_commits(spark, path, order_commits(spark, log.select("op", "commit_id")))
    return path


def version_table(spark: SparkSession, sf_dir: str) -> str:
    """The versioned order table that read-only queries share."""
    return _written(spark, ("orders-versions", sf_dir), lambda: write_version_table(spark, sf_dir))


def bag_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log without a key, with many equal rows: commits 1..7 append the line items of 1995..2001, 8 deletes
    the first line of returned orders, 9 appends the second line of accepted ones once more."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_linenumber", F.col("l_suppkey").alias("suppkey"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.col("l_linestatus").alias("status"), F.col("l_returnflag"), (F.year("l_shipdate") - 1994).cast("long").alias("commit_id"))
    cols = ["suppkey", "flag", "status"]
    gone = li.filter((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1))
    again = li.filter((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 2))
    return (li.select(*cols, F.lit("append").alias("op"), "commit_id")
            .unionByName(gone.select(*cols, F.lit("delete").alias("op"), F.lit(8).cast("long").alias("commit_id")))
            .unionByName(again.select(*cols, F.lit("append").alias("op"), F.lit(9).cast("long").alias("commit_id"))))


BAG_SCHEMA = "suppkey BIGINT, flag STRING, status STRING, op STRING, commit_id BIGINT"


def bag_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written log without a key, partitioned by commit_id."""
    def build():
        path = scratch_path(spark, "bag-changes")
        bag_changes(spark, sf_dir).hint("rebalance", "commit_id").write.partitionBy("commit_id").parquet(path)
        return path
    return spark.read.schema(BAG_SCHEMA).parquet(_written(spark, ("bag-changes", sf_dir), build))


def observations_table(spark: SparkSession, sf_dir: str, max_records_per_file: int | None = None) -> str:
    """obs_li appended to a year/month partitioned Parquet folder; returns the
    path. With ``max_records_per_file`` it is written as many small files
    (the state compaction starts from)."""
    from stationlake.sinks.tables import append_observations

    def build():
        path = scratch_path(spark, "observations")
        append_observations(obs_li(spark, sf_dir), path, max_records_per_file=max_records_per_file)
        return path
    return _written(spark, ("observations", sf_dir, max_records_per_file), build)


SMALL_FILE_ROWS, SMALL_FILES = 250, 4096


def small_file_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows a file of a table of many small files: SMALL_FILE_ROWS, or as many more as keep the table near SMALL_FILES
    files, so that the work of a file does not outgrow that of the rows (the count is in the table's footers)."""
    return max(SMALL_FILE_ROWS, -(-table(spark, sf_dir, "lineitem").count() // SMALL_FILES))


# Queue batches: a queue delivers at most this many records per event.
QUEUE_BATCH_SIZE = 10
MESSAGE_FILE_DOCUMENTS = 1000  # most documents of a message file


def message_files(spark: SparkSession, sf_dir: str) -> str:
    """JSON documents in sequence files (see ``sources.messages``): of every ten
    queue batches one as plain messages, the others as queue events
    pretty-printed over several lines (so only a whole-file read sees a complete
    document). A file a document would be one file for a few KB of any input."""
    from stationlake.sources.messages import RECORD_MARK

    def build():
        path = scratch_path(spark, "message-files")
        batch = F.floor(F.col("event_id") / QUEUE_BATCH_SIZE)
        plain = messages(spark, sf_dir).filter(batch % 10 == 0).select(F.col("body").alias("value"))
        events = queue_events(spark, sf_dir).filter(F.col("batch") % 10 != 0) \
            .select(F.regexp_replace("value", '\\},\\{"messageId"', '},\n  {"messageId"').alias("value"))
        (plain.unionByName(events).select(F.concat(F.lit(RECORD_MARK), "value").alias("value"))
         .write.mode("overwrite").option("maxRecordsPerFile", MESSAGE_FILE_DOCUMENTS).text(path))
        return path
    return _written(spark, ("message-files", sf_dir), build)


def queue_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages grouped into queue events of at most QUEUE_BATCH_SIZE records:
    one JSON line ``{"eventId": .., "Records": [{"messageId": .., "body": ..}, ..]}`` each."""
    m = messages(spark, sf_dir)
    rec = F.struct(F.col("event_id").cast("string").alias("messageId"), F.col("body"))
    return (m.groupBy(F.floor(F.col("event_id") / QUEUE_BATCH_SIZE).alias("batch"))
            .agg(F.sort_array(F.collect_list(F.struct(F.col("event_id"), rec.alias("r")))).alias("rs"))
            .select("batch", F.to_json(F.struct(F.col("batch").cast("string").alias("eventId"),
                                                F.col("rs.r").alias("Records"))).alias("value")))


def queue_event_dir(spark: SparkSession, sf_dir: str) -> str:
    def build():
        path = scratch_path(spark, "queue-events")
        n = max(1, spark.sparkContext.defaultParallelism)
        queue_events(spark, sf_dir).repartitionByRange(n, "batch").select("value") \
            .write.mode("overwrite").text(path)
        return path
    return _written(spark, ("queue-events", sf_dir), build)

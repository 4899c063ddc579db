"""Session settings and the shared scratch folder.

Intermediate tables are written under the folder the cluster names in
``spark.checkpoint.dir`` (a shared file system on a real cluster). Only when
that setting is unset -- local tests -- do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Sizes are for a large cluster; tests override
# shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 512 << 20,
                   shuffle_fraction: float = 0.25) -> dict[str, str]:
    """Sizing for a large cluster: scan splits of ``target_partition_bytes``
    (a task's data fits executor memory with room to spill); reduce
    partitions sized from the expected shuffle volume (``shuffle_fraction``
    of the input: the big aggregations combine map-side), at least 3 per core;
    AQE merges
    small partitions and splits skewed ones at run time. For 100 TB on 1000
    executors x 8 cores: 512 MB splits (~200k scan tasks), ~51k shuffle
    partitions."""
    wanted = int(input_bytes * shuffle_fraction) // target_partition_bytes
    parts = max(3 * total_cores, wanted)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(8 << 20),
    }


def get_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                app_name: str = "stationlake", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Apply the runtime (non-static) settings to an existing session."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.ui.") or k == "spark.driver.memory":
            continue
        spark.conf.set(k, v)
    checkpoint_dir(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``; set only when unset."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = jdir.get() if jdir.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(intermediate tables are written there)")
        d = tempfile.mkdtemp(prefix="stationlake-ckpt-")  # local mode (tests) only
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table under the shared folder."""
    return f"{checkpoint_dir(spark)}/stationlake/{name}-{uuid.uuid4().hex[:12]}"

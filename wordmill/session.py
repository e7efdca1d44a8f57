"""Session helpers: building a session, the shared checkpoint folder, shuffle sizes and
checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of a table we are willing to ship to every executor.
MAX_BROADCAST_BYTES = 64 << 20

# Input bytes per shuffle partition before AQE merges small ones, and the bytes a token
# table takes per byte of compressed text.
SHUFFLE_PARTITION_BYTES = 64 << 20
EXPANSION = 4

# An input below this many bytes per core is spread over all cores.
SPREAD_BYTES_PER_CORE = 16 << 20

# Partitions per core that keep the cores evenly busy, and the bytes of a file split.
EVEN_TASKS_PER_CORE = 3
SPLIT_BYTES = 128 << 20


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "wordmill") -> SparkSession:
    """A session with AQE on and the UI off. On a cluster, pass master=None and let
    spark-submit decide; set ``spark.checkpoint.dir`` there."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Where the setting is unset: a single-JVM ``local`` session gets a temporary folder;
    a cluster gets one in the home folder of its default file system; a cluster whose
    default file system is a local disk has no shared folder, which is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or _default_dir(spark)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def _default_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if sc.master == "local" or sc.master.startswith("local["):
        return os.path.join(tempfile.gettempdir(), "wordmill-checkpoints")
    fs = sc._jvm.org.apache.hadoop.fs.FileSystem.get(sc._jsc.hadoopConfiguration())
    if fs.getScheme() == "file":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{fs.getHomeDirectory().toString().rstrip('/')}/.wordmill-checkpoints"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/wordmill-{name}-{uuid.uuid4().hex[:12]}"


def plan_bytes(df: DataFrame) -> int:
    """The planner's size estimate: file bytes for a scan. Runs no job."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))


def size_shuffles(df: DataFrame) -> DataFrame:
    """Raise the session's initial number of shuffle partitions to what the bytes of
    this input need. AQE merges partitions that turn out small, but never splits one."""
    conf = df.sparkSession.conf
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(conf.get(key, None) or conf.get("spark.sql.shuffle.partitions"))
    need = -(-plan_bytes(df) * EXPANSION // SHUFFLE_PARTITION_BYTES)
    if need > now:
        conf.set(key, str(min(need, 1_000_000)))
    return df


def table_bytes(df: DataFrame) -> int:
    """Bytes of a small, written table: string lengths plus 16 bytes per value."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a measured size; otherwise leave the join to the
    planner (sort-merge with AQE skew splitting). ``df`` should be a written table: it is
    read once to measure it."""
    return F.broadcast(df) if table_bytes(df) <= max_bytes else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over the cluster's cores when the planner's size estimate is
    too small to give each core a file split. A large input adds no shuffle."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if plan_bytes(df) < target * SPREAD_BYTES_PER_CORE else df


def even(df: DataFrame) -> DataFrame:
    """Round-robin the rows of an input for work that is repeated many times, where ``spread``
    leaves an input alone that has too few file splits for every core to get several. Of a
    larger input, whose splits even out, and a smaller one nothing is shuffled."""
    cores, size = df.sparkSession.sparkContext.defaultParallelism, plan_bytes(df)
    tasks = cores * EVEN_TASKS_PER_CORE
    return df.repartition(tasks) if cores * SPREAD_BYTES_PER_CORE <= size < tasks * SPLIT_BYTES else df


def hold(rows: DataFrame, source: DataFrame, name: str) -> DataFrame:
    """``rows``, made from ``source``, for several readers. Those of an input that is small for
    its cores are persisted (memory and disk). Others are written once to the shared folder, in
    Parquet: a persisted table fills the half of an executor's heap that Spark reserves for it,
    and its blocks are arrays of 1 MB and more, of which the heap loses up to as much again, so
    that tasks beside a full cache run out of memory."""
    spark = rows.sparkSession
    if plan_bytes(source) < spark.sparkContext.defaultParallelism * SPREAD_BYTES_PER_CORE:
        return rows.persist(StorageLevel.MEMORY_AND_DISK)
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

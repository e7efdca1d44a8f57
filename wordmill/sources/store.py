"""Result stores (S4-S7): write and read result tables, compute-or-read, and
parameter-keyed output locations. Paths live on the cluster file system (the shared
folder in tests); existence is checked through the Hadoop FileSystem API."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_SCHEMA = "method string, percentage double, metric string, value double"
SAMPLES_SCHEMA = "text string, label int"


# S4
def write_table(df: DataFrame, path: str, *, fmt: str = "csv", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    """CSV with a header (no index column) or parquet."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


# S5
def read_table(spark: SparkSession, path: str, schema: str = RESULT_SCHEMA, *, fmt: str = "csv") -> DataFrame:
    """Read a stored table with an explicit schema (no inference pass)."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", True).csv(path)
    return r.format(fmt).load(path)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one small file through the Hadoop FileSystem, replacing what is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def _publish(spark: SparkSession, df: DataFrame, path: str, fmt: str) -> None:
    """Write aside, then rename: a table is at ``path`` whole or not at all."""
    jvm = spark.sparkContext._jvm
    aside, target = f"{path.rstrip('/')}.writing-{uuid.uuid4().hex[:12]}", jvm.org.apache.hadoop.fs.Path(path)
    write_table(df, aside, fmt=fmt)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
    had = bool(fs.exists(target))
    if had:
        fs.rename(target, old)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(aside), target):
        raise OSError(f"cannot publish {path}")
    if had:
        fs.delete(old, True)


# S6
def materialize(spark: SparkSession, df_fn: Callable[[], DataFrame], path: str, *, reload: bool = False,
                fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """Reuse the table at ``path`` unless it is missing (no ``_SUCCESS`` marker) or
    ``reload`` is set; otherwise compute, write aside, rename, and read back. Reading back cuts
    the lineage, so later failures never recompute the source job. Reuse depends on the path
    alone: ``materialize_for`` makes a path of the input and the parameters. CSV needs its
    ``schema``."""
    if fmt == "csv" and not schema:
        raise ValueError("a CSV store needs an explicit schema")
    if reload or not exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        _publish(spark, df_fn(), path, fmt)
    return read_table(spark, path, schema, fmt=fmt) if schema else spark.read.format(fmt).load(path)


def fingerprint(spark: SparkSession, inputs: Sequence[str]) -> str:
    """A digest of the files under ``inputs``: names, lengths and modification times, taken by
    a Spark job over the listing (no content is read)."""
    files = None
    for p in inputs:
        f = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p)
             .select(F.lit(p).alias("root"), "path", "length", "modificationTime"))
        files = f if files is None else files.unionByName(f)
    if files is None:
        return "none"
    name = F.element_at(F.split("path", "/"), -1)
    one = F.xxhash64("root", name, "length", F.col("modificationTime").cast("string")).cast("decimal(20,0)")
    r = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b"),
                  F.coalesce(F.sum(one), F.lit(0)).cast("string").alias("h")).first()
    return f"{r['n']}-{r['b']}-{r['h']}"


def materialize_for(spark: SparkSession, df_fn: Callable[[], DataFrame], root: str, name: str, *, inputs: Sequence[str] = (),
                    reload: bool = False, fmt: str = "parquet", schema: str | None = None, **params) -> DataFrame:
    """``materialize`` at a path made of ``name``, every parameter and a digest of the input
    files: changed parameters or input are computed anew, beside what is there."""
    digest = hashlib.md5(repr((sorted(params.items()), fingerprint(spark, inputs))).encode()).hexdigest()
    return materialize(spark, df_fn, keyed_path(root, name, **params) + f"/input={digest[:16]}/table", reload=reload, fmt=fmt, schema=schema)


# S7
def keyed_path(root: str, name: str, **params) -> str:
    """An output location keyed by every parameter (sorted), e.g.
    ``root/zeroshot/num_samples=32/temperature=0.2``. Characters that paths cannot hold are
    percent-encoded."""
    parts = [f"{k}={quote(str(params[k]), safe='.-_')}" for k in sorted(params)]
    return "/".join([root.rstrip("/"), name] + parts)

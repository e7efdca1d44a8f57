"""Dataset sources (S1, S2, S3, S8): labelled datasets by split, injected datasets,
inline document lists, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _check_columns(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


# S2
def labelled(df: DataFrame, *, id_cols: Sequence[str] | str, text_col: str = "text",
             label_col: str = "label", split_col: str | None = None) -> DataFrame:
    """Any DataFrame as a labelled dataset ``(ids..., text, label[, split])``; column
    names are arguments and are checked eagerly against the schema."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    _check_columns(df, ids + [text_col, label_col] + ([split_col] if split_col else []))
    cols = [F.col(c) for c in ids] + [F.col(text_col).alias("text"), F.col(label_col).alias("label")]
    if split_col:
        cols.append(F.col(split_col).alias("split"))
    return df.select(*cols)


# S1
def read_split(source: DataFrame | str, split: str, *, spark: SparkSession | None = None,
               split_col: str = "split", fmt: str = "parquet") -> DataFrame:
    """Rows of one split. A path is read with partition discovery, so a
    ``split=<name>`` directory layout is pruned at planning time. A missing split
    raises ``ValueError`` (checked with a one-row probe, not a count)."""
    if isinstance(source, str):
        if spark is None:
            raise ValueError("a SparkSession is needed to read a path")
        df = spark.read.format(fmt).load(source)
    else:
        df = source
    if split_col not in df.columns:
        raise ValueError(f"{split.capitalize()} split is empty or absent")
    out = df.filter(F.col(split_col) == split)
    if not out.take(1):
        raise ValueError(f"{split.capitalize()} split is empty or absent")
    return out


# S3
def from_texts(spark: SparkSession, texts: Sequence[str], *, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """An inline document list; the position in the list is the id."""
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"{id_col} long, {text_col} string")


# S8
def preview(df: DataFrame, n: int = 5, *, order_by: Sequence[str] | str = "doc_id") -> DataFrame:
    """First ``n`` rows by id (a top-k, planned as TakeOrderedAndProject)."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*cols).limit(n)

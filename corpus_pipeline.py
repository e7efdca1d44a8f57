"""The corpus pipeline: quality, language, near duplicates, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of their input. ``run`` applies them to
``documents``. No SQL can express the stages (compression, kernels, tokenisers), so
``ORACLE_SQL`` is None; tests compare each stage with a plain version.

Null and empty texts are rejected by the first stage. A null ``doc_id`` cannot be a
duplicate and stays; of rows with one id and equal texts one stays. Extra columns go
through unchanged, whatever their names. Empty tables give empty results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordmill.llm import language_id, near_dups, packing, quality_classifier
from wordmill.session import broadcast_if_small, cut_lineage, scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _free(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "text"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the compression classifier accepts; it learns from ``labels``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.fit(docs, labels, ~quality_classifier.held_out())
    name = _free(docs, "quality_score")
    scored = quality_classifier.score(docs, model, _others(docs), name)
    return scored.filter(F.col(name) >= quality_classifier.THRESHOLD).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that was learned from the ``lang`` column: texts without
    a letter go, and texts whose trigrams are strange to all learned languages."""
    model = language_id.fit(docs, ~language_id.held_out())
    pred, score, strange = _free(docs, "lang_pred"), _free(docs, "lang_score"), _free(docs, "lang_strange")
    known = language_id.predict(docs, model, _others(docs), pred, score, strange)
    return known.filter((F.col(pred) != language_id.UNKNOWN) & ~F.col(strange)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates, the one with the smallest id.
    Rows that share an id but not the text are documents of their own."""
    node, many, keep, row = (_free(docs, c) for c in ("node", "many_id", "keep_node", "row_of_node"))
    ided = docs.filter("doc_id IS NOT NULL")
    digest = F.xxhash64("text")
    several = cut_lineage(ided.groupBy("doc_id").agg(F.min(digest).alias("lo"), F.max(digest).alias("hi"))
                          .filter("lo <> hi").select(F.col("doc_id").alias(many)))
    noded = ided.join(broadcast_if_small(several), F.col("doc_id") == F.col(many), "left").select(
        *docs.columns, F.when(F.col(many).isNull(), F.col("doc_id")).otherwise(F.xxhash64("doc_id", "text")).alias(node))
    found = near_dups.near_duplicates(noded, node).select(F.col("doc_id").alias(node), "component_id").distinct()
    kept = (found.join(noded.select(node, "doc_id").distinct(), node).groupBy("component_id")
            .agg(F.min(F.struct("doc_id", node))[node].alias(keep)))
    left = noded.join(kept, F.col(node) == F.col(keep), "left_semi")
    first = Window.partitionBy(node).orderBy(F.col("text").asc_nulls_last())
    once = left.withColumn(row, F.row_number().over(first)).filter(F.col(row) == 1).select(*docs.columns)
    return once.unionByName(docs.filter("doc_id IS NULL"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, with their places in sequences."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("language", language), ("near_dedup", near_dedup), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; returns the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Jobs that run a caller-supplied function across partitions, and pair generation
(L6, L7, L10, L11, T13).

The caller's function (a model scorer or a reply generator) is a Python step, as are the
matrix products over pairs: it runs under ``mapInPandas`` on Arrow batches, with as many rows to a call as the caller
says. Replies are kept in a store that only grows, so no prompt is asked twice. Everything around it - prompts, few-shot blocks,
parsing, cleaning, metrics - stays in JVM column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from wordmill.functions import fixed
from wordmill.functions import text as T
from wordmill.functions.hashing import hash_int, id_string, seeded_hash
from wordmill.operators import metrics as MT
from wordmill.session import broadcast_if_small, cut_lineage, scratch_path
from wordmill.sources import store as ST

ScoreFn = Callable[[pd.DataFrame], pd.Series]
Responder = Callable[[pd.DataFrame], pd.Series]


# Rows of a few-shot table: pairs are made from drawn examples, not from a corpus.
MAX_FEW_SHOT_ROWS = 1_000_000


# L6
def contrastive_pairs(few: DataFrame, k: int = fixed.CONTRASTIVE_ITERATIONS, *, id_col: str = "vec_id",
                      label_col: str = "label", seed=fixed.BASELINE_SEED,
                      max_rows: int = MAX_FEW_SHOT_ROWS) -> DataFrame:
    """``(a_id, b_id, similar)``: for every anchor, ``min(k, m-1)`` positives from its own
    class and ``min(k, N-m)`` negatives from the other classes (m = class size, N = all).

    No pair enumeration: rows are ranked by hash inside their class and laid out class
    after class. The j-th positive of the anchor at rank r is rank ``(r+j) mod m`` of its
    class. Negatives stride over all other rows: from a start hashed from the anchor, by
    ``floor((N-m)/k)``, so they are distinct and reach every class a stride does not jump
    over. Each partner is found by an equi-join on position. Input above ``max_rows``
    (a class is ranked by one task) is refused."""
    x = cut_lineage(few.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_lab"),
                               seeded_hash(seed, id_col).alias("_h")))
    if x.count() > max_rows:
        raise ValueError(f"contrastive pairs need a few-shot table of at most {max_rows} rows")
    x = x.withColumn("_r", F.row_number().over(Window.partitionBy("_lab").orderBy("_h", "_id")) - 1)
    sizes = x.groupBy("_lab").agg(F.count(F.lit(1)).alias("_m"))
    w = Window.orderBy("_lab").rowsBetween(Window.unboundedPreceding, 0)
    offs = cut_lineage(sizes.withColumn("_o", F.sum("_m").over(w) - F.col("_m"))
                       .withColumn("_n", F.sum("_m").over(Window.partitionBy())))
    x = cut_lineage(x.join(broadcast_if_small(offs), "_lab").withColumn("_g", F.col("_o") + F.col("_r")))
    pos = x.filter(F.col("_m") > 1).withColumn(
        "_j", F.explode(F.sequence(F.lit(1), F.least(F.lit(k), F.col("_m") - 1))))
    pos = pos.select(F.col("_id").alias("a_id"), "_lab",
                     ((F.col("_r") + F.col("_j")) % F.col("_m")).alias("_r"))
    pos = pos.join(x.select("_lab", "_r", F.col("_id").alias("b_id")), ["_lab", "_r"]) \
        .select("a_id", "b_id", F.lit(True).alias("similar"))
    others = F.col("_n") - F.col("_m")
    step = F.greatest(F.floor(others / k), F.lit(1))
    neg = x.filter(others > 0).withColumn(
        "_j", F.explode(F.sequence(F.lit(0), F.least(F.lit(k), others) - 1)))
    neg = neg.select(F.col("_id").alias("a_id"),
                     ((F.col("_o") + F.col("_m") + (hash_int(F.col("_h")) + F.col("_j") * step) % others)
                      % F.col("_n")).alias("_g"))
    neg = neg.join(x.select("_g", F.col("_id").alias("b_id")), "_g") \
        .select("a_id", "b_id", F.lit(False).alias("similar"))
    return pos.unionByName(neg)


# L6 used by L5
def pair_scatter(pairs: DataFrame, vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(similar, i, j, value)``: the scatter matrices of the pairs, ``sum (a - b)(a - b)^T``
    over the similar and over the other ones, ``i <= j``.

    Each task turns its pairs into one matrix per kind by a product of arrays, so what is
    shuffled are numbers of matrix cells, not pairs. Pairs with a null vector are left out;
    vectors of unequal widths are an error."""
    x = vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_v")).filter("_v IS NOT NULL")
    ends = (pairs.join(x.withColumnsRenamed({"_id": "a_id", "_v": "_a"}), "a_id")
            .join(x.withColumnsRenamed({"_id": "b_id", "_v": "_b"}), "b_id").select("similar", "_a", "_b"))

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[bool, np.ndarray] = {}
        for pdf in batches:
            if not len(pdf):
                continue
            d = np.stack(pdf["_a"].to_numpy()) - np.stack(pdf["_b"].to_numpy())
            for kind in (True, False):
                part = d[pdf["similar"].to_numpy(dtype=bool) == kind]
                if len(part):
                    sums[kind] = sums.get(kind, 0.0) + part.T @ part
        for kind, m in sums.items():
            i, j = np.triu_indices(len(m))
            yield pd.DataFrame({"similar": kind, "i": i.astype(np.int32), "j": j.astype(np.int32), "value": m[i, j]})

    return (ends.mapInPandas(products, "similar boolean, i int, j int, value double")
            .groupBy("similar", "i", "j").agg(F.sum("value").alias("value")))


def pair_projection(scatter: DataFrame, dims: int, ridge: float = 1e-3) -> np.ndarray:
    """A ``width x dims`` matrix whose columns pull dissimilar pairs apart and similar ones
    together: the leading generalised eigenvectors of the two scatter matrices (each divided
    by its trace; ``ridge`` times the mean diagonal keeps the similar one regular). The driver
    holds ``width`` squared numbers. Without pairs of either kind there is nothing to learn,
    which is an error."""
    rows = scatter.collect()
    if {r["similar"] for r in rows} != {True, False}:
        raise ValueError("a projection needs similar and dissimilar pairs")
    width = 1 + max(r["j"] for r in rows)
    m = {kind: np.zeros((width, width)) for kind in (True, False)}
    for r in rows:
        m[r["similar"]][r["i"], r["j"]] = m[r["similar"]][r["j"], r["i"]] = r["value"]
    within, between = (x / (np.trace(x) or 1.0) for x in (m[True], m[False]))
    root = np.linalg.cholesky(within + ridge / width * np.eye(width))
    half = np.linalg.solve(root, between)
    values, vectors = np.linalg.eigh(np.linalg.solve(root, half.T))
    order = np.argsort(-values, kind="stable")[:dims]
    return np.linalg.solve(root.T, vectors[:, order])


def project(df: DataFrame, matrix: np.ndarray, *, vec_col: str = "embedding", out_col: str = "projected") -> DataFrame:
    """Add ``out_col``: the vector times ``matrix``, by Arrow batches; null stays null."""
    @F.pandas_udf("array<double>")
    def times(v: pd.Series) -> pd.Series:
        there = v.notna().to_numpy()
        out = np.empty(len(v), dtype=object)
        if there.any():
            for at, row in zip(np.flatnonzero(there), np.stack(v[there].to_numpy()).astype(np.float64) @ matrix):
                out[at] = row
        return pd.Series(out, index=v.index)

    return df.withColumn(out_col, times(F.col(vec_col)))


# L7 (a model from a file)
def publish_artefact(spark, data: bytes, name: str) -> str:
    """Write a model's bytes into the shared folder under a name of their own; returns the
    path to give to ``score_with_model``."""
    path = f"{scratch_path(spark, 'artefact')}-{name}"
    ST.write_bytes(spark, path, data)
    return path


def score_with_model(df: DataFrame, artefact: str, load: Callable[[str], Callable[[np.ndarray], np.ndarray]], *,
                     keep: Sequence[str], vec_col: str, width: int, batch_rows: int = 1024,
                     scores_col: str = "scores") -> DataFrame:
    """``(keep..., scores, prediction)``: score vectors with a model that every Python worker
    loads once.

    ``artefact`` is a file on the cluster file system; Spark ships it to the executors.
    ``load`` gets its local path and returns the scorer of a ``(rows, width)`` array, called
    with at most ``batch_rows`` rows. The model never travels with the plan or a task. A row
    with a null vector has null scores and no prediction."""
    spark = df.sparkSession
    spark.sparkContext.addFile(artefact)
    name = artefact.rstrip("/").rsplit("/", 1)[-1]

    def make():
        scorer = load(SparkFiles.get(name))
        return lambda vectors: np.asarray(scorer(vectors), dtype=np.float64)

    score = predict_batch_udf(make, return_type=ArrayType(DoubleType()), batch_size=batch_rows, input_tensor_shapes=[[width]])
    nothing = F.array_repeat(F.lit(0.0), width)
    vec = F.coalesce(F.col(vec_col).cast("array<double>"), nothing)
    out = df.withColumn("_wm_there", F.col(vec_col).isNotNull()).withColumn(scores_col, score(vec))
    out = out.withColumn(scores_col, F.when(F.col("_wm_there"), F.col(scores_col)))
    return out.select(*keep, scores_col).withColumn("prediction", T.argmax(scores_col))


# L7 (a function)
def score_batches(df: DataFrame, score_fn: ScoreFn, *, keep: Sequence[str],
                  scores_col: str = "scores") -> DataFrame:
    """Run ``score_fn`` (pandas batch -> Series of score lists) over Arrow batches and
    add ``prediction`` = argmax of the scores, computed JVM-side."""
    keep = list(keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keep)
    schema += f", {scores_col} array<double>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[keep].copy()
            out[scores_col] = list(score_fn(pdf))
            yield out

    return df.mapInPandas(run, schema).withColumn("prediction", T.argmax(scores_col))


# Examples that one prompt may hold.
MAX_EXAMPLES = 1_000


# T13 (few-shot block)
def few_shot_block(few: DataFrame, *, text_col: str = "text", label_col: str = "label",
                   id_cols="doc_id", seed=fixed.BASELINE_SEED, max_rows: int = MAX_EXAMPLES) -> Column:
    """The examples of a few-shot table joined into one string in hash order, as a scalar
    subquery: no join with the item table and nothing on the driver. All examples are used;
    a table of more than ``max_rows`` is refused, as no prompt could hold it."""
    few = cut_lineage(few.select(*{text_col, label_col, *([id_cols] if isinstance(id_cols, str) else id_cols)}))
    if few.count() > max_rows:
        raise ValueError(f"a prompt takes at most {max_rows} examples; draw fewer first")
    line = T.few_shot_line(text_col, label_col)
    parts = F.array_sort(F.collect_list(F.struct(seeded_hash(seed, id_cols).alias("h"),
                                                 id_string(id_cols).alias("i"), line.alias("s"))))
    return few.agg(F.array_join(F.transform(parts, lambda p: p["s"]), "")).scalar()


# Prompts answered by one job before their replies are stored.
PROMPTS_PER_STEP = 100_000
_REPLIES = "prompt_key string, reply string, error string"


def _respond(df: DataFrame, responder: Responder, key_col: str, call_rows: int) -> DataFrame:
    """``(prompt_key, reply, error)``: ``call_rows`` rows to a call, every row in one call only.
    Rows of a failing call get a NULL reply and the error's text, and the job goes on."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies: list[tuple[str | None, str | None]] = []
            for i in range(0, len(pdf), call_rows):
                part = pdf.iloc[i:i + call_rows]
                try:
                    got = list(responder(part.drop(columns=[key_col])))
                    if len(got) != len(part):
                        raise ValueError(f"{len(got)} replies to {len(part)} prompts")
                    replies += [(r, None) for r in got]
                except Exception as e:  # noqa: BLE001 - the caller's function may raise anything
                    replies += [(None, f"{type(e).__name__}: {e}")] * len(part)
            yield pd.DataFrame({"prompt_key": pdf[key_col], "reply": pd.Series([r for r, _ in replies], index=pdf.index, dtype=object),
                                "error": pd.Series([e for _, e in replies], index=pdf.index, dtype=object)})

    return df.mapInPandas(run, _REPLIES)


def ask(rows: DataFrame, responder: Responder, key_col: str, path: str | None = None, *, call_rows: int = 1,
        per_step: int = PROMPTS_PER_STEP, rendered: dict[str, Column] | None = None) -> DataFrame:
    """``(prompt_key, reply, error)`` for every distinct value of ``key_col``, which must
    determine what the responder reads: the other columns or, if given, ``rendered``, computed
    from them where the call is made, so that no long prompt is shuffled or stored.

    The store at ``path`` only grows. Keys that have a reply there are not asked again; the
    others are asked in steps of about ``per_step`` prompts, each appended to the store when it
    ends. So a job that dies loses the step it was in, a rerun asks what is missing or failed,
    and a changed prompt, having another key, is asked anew. Without ``path`` the store is a
    fresh folder."""
    spark = rows.sparkSession
    path = path or scratch_path(spark, "replies")

    def stored() -> DataFrame:
        if not ST.exists(spark, path):
            return spark.createDataFrame([], _REPLIES)
        return spark.read.schema(_REPLIES).parquet(path)

    done = stored().filter("error IS NULL").select(F.col("prompt_key").alias(key_col)).distinct()
    other = [c for c in rows.columns if c != key_col]
    new = rows.join(done, key_col, "left_anti").groupBy(key_col).agg(*[F.any_value(c).alias(c) for c in other])
    todo = scratch_path(spark, "prompts")
    steps = 64
    new.withColumn("_step", F.pmod(F.xxhash64(key_col), F.lit(steps))).write.partitionBy("_step").parquet(todo)
    waiting = spark.read.schema(StructType([*new.schema.fields, StructField("_step", IntegerType())])).parquet(todo)
    # so many of the 64 parts are answered by one job
    together = max(1, min(steps, steps * per_step // max(waiting.count(), 1)))
    for first in range(0, steps, together):
        part = waiting.filter(F.col("_step").between(first, first + together - 1)).drop("_step")
        if rendered is not None:
            part = part.select(key_col, *[c.alias(n) for n, c in rendered.items()])
        _respond(part, responder, key_col, call_rows).write.mode("append").parquet(path)
    # of several rows of a key the one without an error counts
    return stored().groupBy("prompt_key").agg(F.max_by(F.struct("reply", "error"), F.col("error").isNull()).alias("r")).select(
        "prompt_key", "r.reply", "r.error")


# L10
def prompt_classify(items: DataFrame, few: DataFrame | None, responder: Responder, *,
                    id_cols: Sequence[str] = ("doc_id",), text_col: str = "text",
                    label_col: str = "label", seed=fixed.BASELINE_SEED, path: str | None = None,
                    call_rows: int = 1, per_step: int = PROMPTS_PER_STEP) -> DataFrame:
    """``(ids..., label, reply, error, prediction)``: render the prompt per item (few-shot
    block included when ``few`` has rows), call ``responder`` with ``call_rows`` distinct prompts
    at a time, store the replies (see ``ask``; ``path`` keeps them for a rerun), parse each to an
    int label (NULL when unparsable). An item without text has no prompt and no reply."""
    ids = list(id_cols)
    block = few_shot_block(few, text_col=text_col, label_col=label_col, id_cols=ids, seed=seed) \
        if few is not None else None
    prompt = T.classification_prompt(text_col, block)
    key = F.sha2(prompt.cast("binary"), 256).alias("prompt_key")
    # the text travels, not the prompt, which repeats the examples for every item
    replies = ask(items.filter(F.col(text_col).isNotNull()).select(text_col, key), responder, "prompt_key", path,
                  call_rows=call_rows, per_step=per_step, rendered={"prompt": prompt})
    keyed = items.select(*ids, label_col, key)
    return keyed.join(replies, "prompt_key", "left").select(*ids, label_col, "reply", "error").withColumn(
        "prediction", T.parse_int_reply("reply"))


def prompt_metrics(classified: DataFrame, *, label_col: str = "label") -> DataFrame:
    return MT.weighted(classified, label_col=label_col, pred_col="prediction")


# L11
def generate(contexts: DataFrame, responder: Responder, *, id_col: str = "item_id",
             classes: Sequence[str] = fixed.EMOTIONS, n_per_class: int = 1, json_prompt: bool = True,
             names: bool = False, path: str | None = None, call_rows: int = 1,
             per_step: int = PROMPTS_PER_STEP) -> DataFrame:
    """``(id, emotion, sample, text, label, error)``: ``n_per_class`` prompts per (context
    row, class), the responder's reply cleaned (strip, lower, newlines) and the class as its
    code, or its name with ``names``. The responder sees the context's columns, ``emotion``,
    ``sample`` and ``prompt``; together they are the key under which a reply is stored (see
    ``ask``)."""
    rows = (contexts.withColumn("emotion", F.explode(F.array(*[F.lit(c) for c in classes])))
            .withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(n_per_class - 1)))))
    prompt = T.json_generation_prompt("emotion") if json_prompt else T.plain_generation_prompt("emotion")
    rows = rows.withColumn("prompt", prompt)
    rows = rows.withColumn("prompt_key", F.sha2(F.to_json(F.struct(*rows.columns)).cast("binary"), 256))
    replies = ask(rows, responder, "prompt_key", path, call_rows=call_rows, per_step=per_step)
    label = F.col("emotion") if names else MT.name_to_code("emotion")
    return rows.select(id_col, "emotion", "sample", "prompt_key").join(replies, "prompt_key").select(
        id_col, "emotion", "sample", T.clean_generated("reply").alias("text"), label.alias("label"), "error")

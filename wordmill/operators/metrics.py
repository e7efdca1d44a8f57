"""Classification metrics, result tables and label helpers
(A1-A5, A7, A8, R1-R5, K3, F1-F7).

Metrics are computed in SQL form from the confusion counts: one partially aggregated
pass over the predictions gives ``(by..., label, prediction, n)`` - at most
classes x classes rows per group - and everything after that works on that small
table. Many runs (methods x shares) are scored by the same single job. A NULL
prediction (unparsable reply) counts as wrong and is reported as ``n_invalid``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.functions import fixed
from wordmill.functions.hashing import hash_int, seeded_hash

METRICS = ["f1", "precision", "recall", "accuracy"]


# A1
def label_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


# A2
def distinct_labels(*parts: DataFrame, label_col: str = "label") -> DataFrame:
    out = parts[0].select(label_col)
    for p in parts[1:]:
        out = out.unionByName(p.select(label_col))
    return out.distinct()


# A3
def confusion(pred: DataFrame, *, label_col: str = "label", pred_col: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    return pred.groupBy(*by, label_col, pred_col).agg(F.count(F.lit(1)).alias("n"))


# A4 / A5
def weighted(pred: DataFrame, *, label_col: str = "label", pred_col: str = "prediction",
             by: Sequence[str] = ()) -> DataFrame:
    """``(by..., f1, precision, recall, accuracy, n_invalid)``, support-weighted over the
    true classes; precision of a class never predicted is 0."""
    return weighted_of(confusion(pred, label_col=label_col, pred_col=pred_col, by=by),
                       label_col=label_col, pred_col=pred_col, by=by)


def weighted_of(conf: DataFrame, *, label_col: str = "label", pred_col: str = "prediction",
                by: Sequence[str] = ()) -> DataFrame:
    """``weighted`` from a table of confusion counts ``(by..., label, prediction, n)``."""
    by = list(by)
    # every confusion row counts once for its true class and once for its predicted one:
    # all that follows is one aggregation of that small table, so predictions are made once
    kind = conf.schema[label_col].dataType
    label, guess, n = F.col(label_col), F.col(pred_col).cast(kind), F.col("n")
    none = F.lit(0).cast("long")

    def role(cls, sup, tp, prd, inv):
        return F.struct(cls.alias("_c"), sup.alias("_sup"), tp.alias("_tp"), prd.alias("_prd"), inv.alias("_inv"))

    true = role(label, n, F.when(label == guess, n).otherwise(none), none, F.when(guess.isNull(), n).otherwise(none))
    said = F.when(guess.isNotNull(), role(guess, none, none, n, none))
    pc = (conf.select(*by, F.explode(F.array_compact(F.array(true, said))).alias("_r")).select(*by, "_r.*")
          .groupBy(*by, "_c").agg(*[F.sum(c).alias(c) for c in ("_sup", "_tp", "_prd", "_inv")]))
    sup, tp, prd = F.col("_sup"), F.col("_tp"), F.col("_prd")
    prec = F.when(prd == 0, F.lit(0.0)).otherwise(F.try_divide(tp, prd))
    f1 = F.try_divide(2.0 * tp, sup + prd)
    # a NULL label has support but cannot be predicted
    total = F.sum("_sup")
    return pc.groupBy(*by).agg(
        F.try_divide(F.sum(sup * f1), total).alias("f1"), F.try_divide(F.sum(sup * prec), total).alias("precision"),
        F.try_divide(F.sum(tp), total).alias("recall"), F.try_divide(F.sum(tp), total).alias("accuracy"),
        F.coalesce(F.sum("_inv"), none).alias("n_invalid"))


# R1
def to_long(wide: DataFrame, id_cols: Sequence[str] = ("percentage",),
            metrics: Sequence[str] = METRICS) -> DataFrame:
    """``(id_cols..., metric, value)``; an empty input gives an empty table."""
    return wide.select(*id_cols, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        list(id_cols), list(metrics), "metric", "value")


# A7
def max_percentage(long: DataFrame, by: Sequence[str] = ("method",)) -> DataFrame:
    return long.groupBy(*by).agg(F.max("percentage").alias("max_percentage"))


# R2
def percent_scale(long: DataFrame, by: Sequence[str] = ("method",)) -> DataFrame:
    """Multiply ``percentage`` by 100 within each group whose maximum is at most 1."""
    mx = F.max("percentage").over(Window.partitionBy(*by))
    return long.withColumn("percentage", F.when(mx <= 1.0, F.col("percentage") * 100.0)
                           .otherwise(F.col("percentage")))


# R3
def stack(results: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for method, df in results.items():
        d = df.withColumn("method", F.lit(method))
        out = d if out is None else out.unionByName(d)
    return out


# R4
def extend_single_points(long: DataFrame, grid: Sequence[float] | None = None,
                         by: Sequence[str] = ("method",)) -> DataFrame:
    """A method with one point per metric becomes a constant line over ``grid``
    (default 0, 10, ..., 100); other methods are unchanged."""
    grid = list(grid) if grid is not None else [float(x) for x in range(0, 101, 10)]
    keys = list(by) + ["metric"]
    n_pts = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    x = long.withColumn("_pts", n_pts)
    single = (x.filter(F.col("_pts") == 1)
              .withColumn("percentage", F.explode(F.array(*[F.lit(float(g)) for g in grid]))))
    return x.filter(F.col("_pts") > 1).unionByName(single).drop("_pts")


# A8
def metric_names(long: DataFrame) -> DataFrame:
    return long.select("metric").distinct()


# F6
def filter_metric(long: DataFrame, metric: str) -> DataFrame:
    return long.filter(F.col("metric") == metric)


# K3
def sort_results(long: DataFrame, by: Sequence[str] = ("method",)) -> DataFrame:
    return long.orderBy(*by, "percentage", "metric")


# F7
def invalid_counts(pred: DataFrame, *, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    return pred.groupBy(label_col).agg(
        F.sum(F.col(pred_col).isNull().cast("long")).alias("n_invalid"),
        F.count(F.lit(1)).alias("n"))


# F1
def rows_of_class(df: DataFrame, label: object, label_col: str = "label") -> DataFrame:
    return df.filter(F.col(label_col) == F.lit(label))


# F2
def declared_classes(df: DataFrame, classes: Sequence[object], label_col: str = "label") -> DataFrame:
    return df.filter(F.col(label_col).isin(list(classes)))


# F3
def project_text_label(df: DataFrame, text_col: str = "text", label_col: str = "label",
                       id_col: str | None = None) -> DataFrame:
    cols = ([F.col(id_col)] if id_col else []) + [F.col(text_col).alias("text"), F.col(label_col).alias("label")]
    return df.select(*cols)


def _map_lit(mapping: Mapping) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


# F4
def code_to_name(code: str | Column, names: Mapping[int, str] = fixed.LABEL_NAMES) -> Column:
    c = F.col(code) if isinstance(code, str) else code
    return F.element_at(_map_lit(names), c)


# F5
def name_to_code(name: str | Column, codes: Mapping[str, int] = fixed.EMOTION_CODES) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.element_at(_map_lit(codes), c)


def standin_prediction(seed, id_col: str, label_col: str = "label", n_classes: int = 10) -> Column:
    """A deterministic stand-in classifier for testing metrics: right for about 60% of
    rows, a hashed class otherwise, NULL (invalid reply) for about 1 row in 13."""
    hx = hash_int(seeded_hash(seed, id_col))
    return (F.when(hx % 13 == 0, F.lit(None).cast("int"))
            .when(hx % 10 < 6, F.col(label_col).cast("int"))
            .otherwise((hx % n_classes).cast("int")))

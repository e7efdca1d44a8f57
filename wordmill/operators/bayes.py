"""Multinomial naive Bayes whose model is a table (an estimator for L2 and L3).

Fitting is one aggregate: the tokens of the training rows, weighted, counted per (term,
class). Scoring is a join with that table and a sum per row. With ``V`` distinct training
terms, ``N_c`` tokens and ``W_c`` rows of class ``c``, and smoothing ``alpha``, a row whose
terms have the counts ``t`` scores

    log(W_c / W) + sum_t t * (log(n_ct + alpha) - log(N_c + alpha * V))

over the terms that occur in training; others are dropped, as they are for a TF-IDF model.
The largest score wins; ties go to the label first in order.

The driver holds two numbers per class. The term table is broadcast only below the
measured limit and else joined by a shuffle. A row's tokens are counted within the row, and
its sums are formed where the row was read, so the one shuffle of scoring carries a row of
numbers per document, never a text."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from wordmill.functions import text as T
from wordmill.session import broadcast_if_small, cut_lineage

ALPHA = 1.0
#: Classes a model may have: a column each in the term table.
MAX_CLASSES = 500
#: A term table of at most this size is broadcast: a learning curve scores all its shares in one
#: job, and the driver builds the tables of all of them.
MAX_TABLE_BYTES = 16 << 20
#: Decimal places at which scores are compared, so that sums taken in another order cannot
#: swap two equal classes.
PLACES = 6


class NaiveBayesTable(Estimator):
    """``fit`` takes labelled texts (rows without a label are dropped), and weights if
    ``weight_col`` is given; the model adds ``predicted``."""

    def __init__(self, *, text_col: str = "text", label_col: str = "label", weight_col: str | None = None,
                 alpha: float = ALPHA, tokenizer: Callable[[Column], Column] = T.word_tokens):
        super().__init__()
        if alpha <= 0:
            raise ValueError("alpha must be positive")
        self.text_col, self.label_col, self.weight_col = text_col, label_col, weight_col
        self.alpha, self.tokenizer = alpha, tokenizer

    def prepared(self, df: DataFrame) -> DataFrame:
        """``df`` with its texts replaced by their counted terms, which ``fit`` and the model
        take in their place: a caller that fits several models persists it once."""
        return df.withColumn(self.text_col, self._counts(df))

    def _counts(self, df: DataFrame) -> Column:
        text = F.col(self.text_col)
        return text if isinstance(df.schema[self.text_col].dataType, ArrayType) else T.counted_terms(self.tokenizer(text))

    def counted(self, df: DataFrame, *keep: str) -> DataFrame:
        """``keep``, a term of the row and its count; a row without terms has one row."""
        cells = df.select(*keep, F.explode_outer(self._counts(df)).alias("c"))
        return cells.select(*keep, F.col("c.term").alias("_nb_term"), F.col("c.tf").cast("double").alias("_nb_tf"))

    def _fit(self, dataset: DataFrame) -> Model:
        weight = F.col(self.weight_col).cast("double") if self.weight_col else F.lit(1.0)
        rows = dataset.filter(F.col(self.label_col).isNotNull()).select(
            F.col(self.label_col).alias("_nb_label"), weight.alias("_nb_weight"), self.text_col)
        cells = self.counted(rows, "_nb_label", "_nb_weight").filter("_nb_term IS NOT NULL")
        counts = cut_lineage(cells.groupBy(F.col("_nb_term").alias("term"), F.col("_nb_label").alias("label"))
                             .agg(F.sum(F.col("_nb_tf") * F.col("_nb_weight")).alias("n")))
        n_terms = counts.select("term").distinct().count()
        weights = {r["_nb_label"]: r["w"] for r in rows.groupBy("_nb_label").agg(F.sum("_nb_weight").alias("w")).collect()}
        tokens = {r["label"]: r["n"] for r in counts.groupBy("label").agg(F.sum("n").alias("n")).collect()}
        if not weights or len(weights) > MAX_CLASSES:
            raise ValueError(f"naive Bayes needs 1 to {MAX_CLASSES} classes, not {len(weights)}")
        labels, total = sorted(weights), sum(weights.values())
        return NaiveBayesModel(self, counts, labels, [math.log(weights[c] / total) for c in labels],
                               [math.log(tokens.get(c, 0.0) + self.alpha * n_terms) if n_terms else 0.0 for c in labels])


class NaiveBayesModel(Model):
    """``counts`` ``(term, label, n)`` is a written table of the pairs that occur; ``priors``
    and ``sizes`` are log shares and log token totals by ``labels``."""

    def __init__(self, of: NaiveBayesTable, counts: DataFrame, labels: list, priors: list[float], sizes: list[float]):
        super().__init__()
        self.of, self.counts, self.labels, self.priors, self.sizes = of, counts, labels, priors, sizes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """All columns but the text, with ``predicted``."""
        alpha = self.of.alpha
        # what a term adds to a class beyond log(alpha), which it adds to every class
        gains = [F.coalesce(F.max(F.when(F.col("label") == F.lit(c), F.log(F.col("n") + alpha) - math.log(alpha))), F.lit(0.0))
                 .alias(f"_nb_g{i}") for i, c in enumerate(self.labels)]
        known = broadcast_if_small(cut_lineage(self.counts.groupBy(F.col("term").alias("_nb_term")).agg(*gains)), MAX_TABLE_BYTES)
        others = [c for c in dataset.columns if c != self.of.text_col]
        row = dataset.select(F.monotonically_increasing_id().alias("_nb_row"), F.struct(F.lit(1).alias("_nb"), *others).alias("_nb_kept"),
                             self.of.text_col)
        met = self.of.counted(row, "_nb_row", "_nb_kept").join(known, "_nb_term", "left")
        used = F.coalesce(F.sum(F.when(F.col("_nb_g0").isNotNull(), F.col("_nb_tf"))), F.lit(0.0)).alias("_nb_used")
        sums = [F.coalesce(F.sum(F.col("_nb_tf") * F.col(f"_nb_g{i}")), F.lit(0.0)).alias(f"_nb_s{i}") for i in range(len(self.labels))]
        total = met.groupBy("_nb_row").agg(F.any_value("_nb_kept").alias("_nb_kept"), used, *sums)
        scores = F.array(*[F.round(F.lit(p) + F.col(f"_nb_s{i}") + F.col("_nb_used") * F.lit(math.log(alpha) - z), PLACES)
                           for i, (p, z) in enumerate(zip(self.priors, self.sizes))])
        best = F.get(F.array(*[F.lit(c) for c in self.labels]), T.argmax("_nb_scores"))
        return total.withColumn("_nb_scores", scores).select("_nb_kept.*", best.alias("predicted")).drop("_nb")

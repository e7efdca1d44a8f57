"""Learning and scoring with pyspark.ml.

The text classifier is a ``pyspark.ml`` pipeline: lowercased runs of two or more word
characters, hashed counts (``HashingTF``), smooth idf ``ln((1+n)/(1+df)) + 1``, L2 rows and
multinomial ``LogisticRegression``. Spark's ``IDF`` omits the ``+ 1``, so the fitted idf
vector is shifted and applied with ``ElementwiseProduct``. The penalty is that of C = 1 on the
summed (weighted) loss: ``regParam = 1 / sum of weights``, ``standardization=False``.

The feature space has a stated width (``WIDTH``, a parameter), so the driver and every task
hold one number per class and feature however many terms the corpus has. Terms that share a
feature share a coefficient; ``term_index`` is the table of terms and features, ``collisions``
measures how many share one. Spark's solver divides features by their standard deviation
while it works, also with ``standardization=False``; rare features then converge slowly, so
it is given ``MAX_ITER`` steps rather than the reference's 100 and stops by its tolerance.
``objective_history`` of the fitted model shows where it ended.

A learning curve fits one model per share (the driver loop is over a handful of
shares, never over rows) on texts cut and hashed once, two models at a time where their
rows fit in memory side by side; all predictions are unioned and scored by one grouped metrics job. Any other estimator can be injected (``bayes`` has one
whose model is a table).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import ElementwiseProduct, HashingTF, IDF, Normalizer, RegexTokenizer, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.functions import fixed
from wordmill.functions import text as T
from wordmill.operators import jobs
from wordmill.operators import metrics as MT
from wordmill.operators import sampling as M
from wordmill.session import cut_lineage, even, hold, spread

EstimatorFn = Callable[..., Estimator]

# Features of the hashed space, and the solver's tolerance and steps.
WIDTH = 1 << 12
LR_TOL = 1e-5
MAX_ITER = 1_000

# Bytes of cached tokens per partition seen by the iterative solver, and bytes of a token.
SOLVER_PARTITION_BYTES = 16 << 20
TOKEN_BYTES = 24

# Models of a learning curve fitted at the same time: a solver step ends with its slowest
# task, and the steps of another model fill the cores until then. A larger table, of more
# hashed counts (at most ``CELL_BYTES`` per token) per core, is fitted a share after the other:
# the solver keeps the rows of every model it works on in memory.
PARALLELISM = 2
CELL_BYTES = 12
PARALLEL_BYTES_PER_CORE = 512 << 20


class SmoothIdf(Estimator):
    """Fits Spark's IDF and applies ``idf + 1`` (the smooth-idf convention)."""

    def __init__(self, inputCol: str, outputCol: str):
        super().__init__()
        self.inputCol, self.outputCol = inputCol, outputCol

    def _fit(self, dataset: DataFrame) -> Model:
        idf = IDF(inputCol=self.inputCol, outputCol="_wm_unused", minDocFreq=0).fit(dataset)
        scale = DenseVector([v + 1.0 for v in idf.idf.toArray()])
        return _ScaleModel(ElementwiseProduct(scalingVec=scale, inputCol=self.inputCol,
                                              outputCol=self.outputCol))


class _ScaleModel(Model):
    def __init__(self, product: ElementwiseProduct):
        super().__init__()
        self.product = product

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.product.transform(dataset)


def _tokenizer(text_col: str, tokens_col: str) -> RegexTokenizer:
    return RegexTokenizer(inputCol=text_col, outputCol=tokens_col, pattern=T.WORD2_TOKEN, gaps=False, toLowercase=True)


class LabelledLogistic(Model):
    """A fitted ``LogisticRegressionModel`` that answers with the labels themselves: adds
    ``probability`` (array, in order of ``labels``) and ``predicted``."""

    def __init__(self, model: LogisticRegressionModel, labels: list, weight_sum: float, features_col: str = "_x"):
        super().__init__()
        self.model, self.labels, self.weight_sum, self.features_col = model, list(labels), weight_sum, features_col
        self.objective_history = list(model.summary.objectiveHistory)

    def coefficients(self, spark) -> DataFrame:
        """``(label, feature, coefficient)``, classes times width rows."""
        matrix = self.model.coefficientMatrix.toArray()
        if len(matrix) == 1 < len(self.labels):  # a binomial model has one row
            matrix = [-matrix[0] / 2, matrix[0] / 2]
        return spark.createDataFrame([(c, [float(v) for v in w]) for c, w in zip(self.labels, matrix)],
                                     "label string, w array<double>").select("label", F.posexplode("w").alias("feature", "coefficient"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.model.transform(dataset).drop("_raw")
        names = F.array(*[F.lit(v) for v in self.labels])
        return out.withColumn("probability", vector_to_array("_p")).withColumn(
            "predicted", F.get(names, F.col("_best").cast("int"))).drop("_p", "_best")


class TextClassifier(Estimator):
    """L1: hashed TF-IDF + multinomial logistic regression.

    ``fit`` drops rows without a label, tokenises once (or takes ``tokens_col``), persists
    label, hashed counts and weight for the idf and solver passes (memory and disk; lost
    blocks are recomputed) and merges them, without a shuffle, into partitions sized by the
    bytes of the tokens: every solver step aggregates a gradient per partition. Texts that
    come in fewer partitions than keep the cores evenly busy are dealt out before
    (``session.even``). The output of ``prepared``, which the caller persists, is taken in
    place of the texts and is not copied. The model is
    a ``PipelineModel`` from text (or tokens) to ``predicted``, the label itself; it never
    sees labels, so rows with a label unknown to it are scored like any other.
    ``max_fit_rows`` (unlimited by default) takes the first rows in hash order."""

    def __init__(self, *, text_col: str = "text", label_col: str = "label", max_iter: int = MAX_ITER, tol: float = LR_TOL,
                 width: int = WIDTH, weight_col: str | None = None, tokens_col: str | None = None,
                 max_fit_rows: int | None = None):
        super().__init__()
        self.text_col, self.label_col, self.max_iter, self.tol, self.width = text_col, label_col, max_iter, tol, width
        self.weight_col, self.tokens_col, self.max_fit_rows = weight_col, tokens_col, max_fit_rows

    def _hashing(self) -> list:
        """The stages from text (or tokens) to hashed counts."""
        tokens = self.tokens_col or "_tok"
        return [*([] if self.tokens_col else [_tokenizer(self.text_col, tokens)]),
                HashingTF(inputCol=tokens, outputCol="_tf", numFeatures=self.width)]

    def prepared(self, df: DataFrame) -> DataFrame:
        """``df`` with its texts (or tokens) replaced by ``_tf``, their hashed counts, and
        ``_size``, their number of tokens; ``fit`` and the model take them in their place: a
        caller that fits several models persists it once."""
        tokens = self.tokens_col or "_tok"
        for stage in self._hashing():
            df = stage.transform(df)
        return df.withColumn("_size", F.size(tokens)).drop(tokens, self.text_col)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        rows, known = dataset.filter(F.col(self.label_col).isNotNull()), "_tf" in dataset.columns
        if self.max_fit_rows is not None:
            key = F.col("_tf").cast("string") if known else F.col(self.tokens_col).cast("string") if self.tokens_col else F.col(self.text_col)
            rows = rows.orderBy(F.md5(key)).limit(self.max_fit_rows)
        stages = [] if known else self._hashing()
        weight = F.col(self.weight_col).cast("double") if self.weight_col else F.lit(1.0)
        if known:
            counted = rows
        else:
            keep = [c for c in (self.label_col, self.tokens_col or self.text_col, self.weight_col) if c]
            counted = self.prepared(even(rows.select(*dict.fromkeys(keep))))
        held = counted.select(F.col(self.label_col).alias("_label"), "_tf", weight.alias("_weight"), "_size")
        if not known:
            held = held.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            size = held.agg(F.sum("_weight").alias("w"), F.sum("_size").alias("t")).first()
            total = size["w"] or 0.0
            data = held.drop("_size").coalesce(max(1, -(-(size["t"] or 0) * TOKEN_BYTES // SOLVER_PARTITION_BYTES)))
            indexer = StringIndexer(inputCol="_label", outputCol="_y", stringOrderType="alphabetAsc").fit(data)
            data = indexer.transform(data)
            for stage in (SmoothIdf(inputCol="_tf", outputCol="_tfidf"), Normalizer(inputCol="_tfidf", outputCol="_x", p=2.0)):
                stages.append(stage.fit(data) if isinstance(stage, Estimator) else stage)
                data = stages[-1].transform(data)
            lr = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="_weight", family="multinomial", rawPredictionCol="_raw",
                                    probabilityCol="_p", predictionCol="_best", maxIter=self.max_iter, tol=self.tol,
                                    regParam=1.0 / max(total, 1e-300), standardization=False)
            stages.append(LabelledLogistic(lr.fit(data.select("_x", "_y", "_weight")), indexer.labels, total))
        finally:
            if not known:
                held.unpersist()
        return PipelineModel(stages)


def text_classifier(**kw) -> TextClassifier:
    return TextClassifier(**kw)


def features(model: PipelineModel, df: DataFrame, id_cols: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``(ids..., feature, weight)``: the rows the solver sees, as a long table."""
    out = df
    for stage in model.stages[:-1]:
        out = stage.transform(out)
    x = F.unwrap_udt("_x")
    cells = out.select(*id_cols, x.alias("v")).select(*id_cols, F.explode(F.arrays_zip(
        F.col("v.indices").alias("i"), F.col("v.values").alias("w"))).alias("c"))
    return cells.filter(F.col("c.w") != 0).select(*id_cols, F.col("c.i").alias("feature"), F.col("c.w").alias("weight"))


def term_index(model: PipelineModel, df: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``(term, df, feature)``: every term of ``df`` with its document frequency and the
    feature it is hashed to. One partial aggregate over terms; a distributed table."""
    hashing = next(s for s in model.stages if isinstance(s, HashingTF))
    terms = (T.exploded(spread(df.select(text_col)), F.array_distinct(T.word_tokens(F.col(text_col), 2)), name="term")
             .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    hashed = HashingTF(inputCol="_one", outputCol="_at", numFeatures=hashing.getNumFeatures()).transform(
        terms.withColumn("_one", F.array("term")))
    return hashed.select("term", "df", F.get(F.unwrap_udt("_at")["indices"], 0).alias("feature"))


def collisions(index: DataFrame) -> DataFrame:
    """One row about a term table: ``n_terms``, ``n_features`` used, ``n_shared`` (terms that
    share their feature with another) and their share ``shared``."""
    per = index.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    shared = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return per.agg(total.alias("n_terms"), F.count(F.lit(1)).alias("n_features"), shared.alias("n_shared"),
                   F.coalesce(F.try_divide(shared, total), F.lit(0.0)).alias("shared"))


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Scored rows with ``predicted`` by any fitted model: its column ``predicted`` is
    taken as it is, else its ``prediction``."""
    out = model.transform(df)
    return out if "predicted" in out.columns else out.withColumnRenamed("prediction", "predicted")


# L1 / L4
def cross_evaluate(model: Model, df: DataFrame, *, label_col: str = "label",
                   by: Sequence[str] = ()) -> DataFrame:
    """Score ``df`` with a fitted model and compute weighted metrics."""
    pred = predict(model, df).select(*by, label_col, "predicted")
    return MT.weighted(pred, label_col=label_col, pred_col="predicted", by=by)


def curve_parts(df: DataFrame, fractions: Sequence[float] | None = None, *, seed=fixed.BASELINE_SEED, id_cols="doc_id",
                valid_share: float = fixed.BASELINE_VALID_SHARE, out_col: str = "_wm_parts") -> DataFrame:
    """``df`` with an array of its part ('train', 'valid' or NULL) at every share."""
    return M.ladder_splits(df, M.ladder(fractions), valid_share, seed=seed, split_seed=f"{seed}/split",
                           id_cols=id_cols, out_col=out_col)


def steps_so_far(parts_col: str, i: int):
    """How many of the first ``i + 1`` shares hold a row: its weight when models are
    trained step after step."""
    return F.size(F.filter(F.slice(parts_col, 1, i + 1), lambda p: p.isNotNull())).cast("double")


def at_a_time(counted: DataFrame) -> int:
    """How many models are fitted at the same time on rows with hashed counts."""
    tokens = counted.agg(F.sum("_size")).first()[0] or 0
    room = counted.sparkSession.sparkContext.defaultParallelism * PARALLEL_BYTES_PER_CORE
    return PARALLELISM if tokens * CELL_BYTES <= room else 1


# L2 / L3 / L8 / L9
def learning_curve(df: DataFrame, *, fractions: Sequence[float] | None = None, seed=fixed.BASELINE_SEED,
                   id_cols="doc_id", label_col: str = "label", text_col: str = "text",
                   estimator_fn: EstimatorFn | None = None,
                   valid_share: float = fixed.BASELINE_VALID_SHARE, sampling: str = "simple",
                   holdout: DataFrame | None = None, cumulative: bool = False) -> DataFrame:
    """Long results ``(percentage, metric, value)``.

    Per share: sample (simple M1 or stratified M4), split train/valid (M2) unless a
    fixed ``holdout`` is given, fit on train, predict. ``estimator_fn(**kw)`` makes any
    estimator; it is given ``weight_col`` in a cumulative curve. ``cumulative=True``
    trains the way a model trained step after step would: a row weighs as many times as
    earlier shares included it. If the estimators have a method ``prepared`` (as the built-in
    one and ``bayes`` have), texts are cut and counted once. The built-in estimator fits
    ``at_a_time`` shares at the same time, an injected one a share after the other."""
    fr = M.ladder(fractions)
    keys = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    base, held = spread(df.select(*keys, text_col, label_col)), []

    def make(**kw) -> Estimator:
        return estimator_fn(**kw) if estimator_fn is not None else TextClassifier(label_col=label_col, text_col=text_col, **kw)

    def prepared(d: DataFrame) -> DataFrame:
        prepare = getattr(make(), "prepared", None)
        if prepare is None:
            return d
        # a solver passes over its rows again and again, an injected estimator a few times
        held.append(hold(prepare(d), d, "prepared") if estimator_fn is not None else
                    prepare(even(d)).persist(StorageLevel.MEMORY_AND_DISK))
        return held[-1]

    try:
        if sampling != "stratified" and holdout is None:
            base = curve_parts(base, fr, seed=seed, id_cols=keys, valid_share=valid_share)
        base = prepared(base)
        fixed_valid = prepared(spread(holdout.select(*keys, text_col, label_col))) if holdout is not None else None
        strata = M.stratified_ladder(base, fr, label_col=label_col, seed=seed, id_cols=keys) if sampling == "stratified" else None

        def scored(i: int) -> DataFrame:
            kw = {}
            if "_wm_parts" in base.columns:
                part = F.col("_wm_parts")[i]
                train, valid = base.filter(part == "train"), base.filter(part == "valid")
                if cumulative:
                    train, kw = train.withColumn("_w", steps_so_far("_wm_parts", i)), {"weight_col": "_w"}
            else:
                train = strata[i] if strata is not None else M.sample_fraction(base, fr[i], seed=seed, id_cols=keys)
                valid = fixed_valid
                if valid is None:
                    parts = M.split(train, valid_share, seed=f"{seed}/split", id_cols=keys)
                    train, valid = parts.filter(F.col("part") == "train"), parts.filter(F.col("part") == "valid")
            model = make(**kw).fit(train)
            # a model may take what it keeps of a row through shuffles of the row's terms
            valid = valid.drop("_wm_parts")
            return predict(model, valid).select(label_col, "predicted").withColumn("percentage", F.lit(float(fr[i])))

        if estimator_fn is None:
            # the largest share first; results in the order of the ladder
            order = sorted(range(len(fr)), key=lambda i: -fr[i])
            with ThreadPool(at_a_time(base)) as pool:
                done = dict(zip(order, pool.map(inheritable_thread_target(base.sparkSession)(scored), order, chunksize=1)))
            preds = [done[i] for i in range(len(fr))]
        else:
            preds = [scored(i) for i in range(len(fr))]
        allp = preds[0]
        for p in preds[1:]:
            allp = allp.unionByName(p)
        # one row per share and pair of classes: written while the tokens are held
        conf = cut_lineage(MT.confusion(allp, label_col=label_col, pred_col="predicted", by=["percentage"]))
    finally:
        for h in held:
            h.unpersist()
    wide = MT.weighted_of(conf, label_col=label_col, pred_col="predicted", by=["percentage"])
    return MT.to_long(wide, ["percentage"])


# L5
def few_shot_parts(df: DataFrame, n: int, *, id_col: str = "vec_id", label_col: str = "label", seed=fixed.BASELINE_SEED,
                   valid_share: float = fixed.FEW_SHOT_VALID_SHARE) -> tuple[DataFrame, DataFrame]:
    """``n`` rows per class of the train half, and the whole other half."""
    parts = M.split(df, valid_share, seed=f"{seed}/split", id_cols=id_col)
    return (M.per_class(parts.filter(F.col("part") == "train"), n, label_col=label_col, seed=seed, id_cols=id_col),
            parts.filter(F.col("part") == "valid"))


def few_shot_head(emb: DataFrame, n: int, *, id_col: str = "vec_id", label_col: str = "label",
                  vec_col: str = "embedding", seed=fixed.BASELINE_SEED,
                  valid_share: float = fixed.FEW_SHOT_VALID_SHARE,
                  pair_dims: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Split the embeddings in halves, draw ``n`` rows per class from the train half,
    fit a linear head, score the other half. Returns (wide metrics, predictions).

    With ``pair_dims`` the contrastive pairs of the drawn rows (L6) are learned from first:
    their scatter matrices give a projection to so many dimensions, on which the head is fitted.
    Projected vectors are scaled to the mean length of the drawn ones."""
    train, valid = few_shot_parts(emb.select(id_col, label_col, vec_col), n, id_col=id_col, label_col=label_col,
                                  seed=seed, valid_share=valid_share)
    train = cut_lineage(train)
    n_train = train.count()
    if pair_dims is not None:
        pairs = jobs.contrastive_pairs(train, id_col=id_col, label_col=label_col, seed=seed)
        matrix = jobs.pair_projection(jobs.pair_scatter(pairs, train, id_col=id_col, vec_col=vec_col), pair_dims)
        length = F.sqrt(F.aggregate(F.col(vec_col), F.lit(0.0), lambda a, v: a + v.cast("double") * v))
        before = train.agg(F.avg(length)).first()[0]
        train, valid = (jobs.project(d, matrix, vec_col=vec_col, out_col=vec_col) for d in (train, valid))
        train = cut_lineage(train)
        after = train.agg(F.avg(length)).first()[0]
        scale = F.lit(before / after if after else 1.0)
        train, valid = (d.withColumn(vec_col, F.transform(vec_col, lambda v: v * scale)) for d in (train, valid))
    train, valid = (d.withColumn("_x", array_to_vector(F.col(vec_col))) for d in (train, valid))
    lr = LogisticRegression(featuresCol="_x", labelCol=label_col, predictionCol="_p", family="multinomial",
                            maxIter=fixed.LR_MAX_ITER, regParam=1.0 / max(n_train, 1), standardization=False,
                            tol=LR_TOL)
    model = lr.fit(train.withColumn(label_col, F.col(label_col).cast("double")))
    pred = model.transform(valid.withColumn(label_col, F.col(label_col).cast("double")))
    pred = pred.select(id_col, F.col(label_col).cast("int").alias(label_col),
                       F.col("_p").cast("int").alias("prediction"))
    return MT.weighted(pred, label_col=label_col), pred


# L12
def top_coefficients(model: PipelineModel, df: DataFrame, k: int = 10, *, text_col: str = "text") -> DataFrame:
    """``(label, term, coefficient, rank, sharing)``: the k features of largest coefficient
    per class, named by their most frequent term in ``df``; ``sharing`` terms are hashed to
    that feature. The coefficients are classes times width rows; terms stay distributed."""
    fitted = next(s for s in model.stages if isinstance(s, LabelledLogistic))
    index = term_index(model, df, text_col=text_col)
    named = index.groupBy("feature").agg(F.min(F.struct((-F.col("df")).alias("d"), "term"))["term"].alias("term"),
                                         F.count(F.lit(1)).alias("sharing"))
    rows = named.join(F.broadcast(fitted.coefficients(df.sparkSession)), "feature")
    order = Window.partitionBy("label").orderBy(F.col("coefficient").desc(), "term")
    return (rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("label", "term", "coefficient", "rank", "sharing"))


def disagreement(a: DataFrame, b: DataFrame, *, id_cols, pred_a: str = "prediction",
                 pred_b: str = "prediction") -> DataFrame:
    """``(pred_a, pred_b, n)``: how two models' predictions pair up on the same rows."""
    keys = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    j = a.select(*keys, F.col(pred_a).alias("pred_a")).join(
        b.select(*keys, F.col(pred_b).alias("pred_b")), keys)
    return j.groupBy("pred_a", "pred_b").agg(F.count(F.lit(1)).alias("n"))

"""The text classifier and learning curves on the 1,000 documents of sf0.01."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import Estimator, Model
from pyspark.sql import functions as F

from wordmill import session
from wordmill.operators import learn as LN
from wordmill.operators import metrics as MT
from wordmill.operators import sampling as M
from wordmill.operators import terms
from wordmill.operators.bayes import NaiveBayesTable

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 3000")
    return d.select("doc_id", "text", F.col("lang").alias("label"))


@pytest.fixture(scope="module")
def fitted(docs):
    parts = M.split(docs, 0.2, seed="t", id_cols="doc_id")
    train = parts.filter("part = 'train'")
    return LN.text_classifier().fit(train), train, parts.filter("part = 'valid'")


def test_beats_the_majority_class(fitted):
    model, _, valid = fitted
    rows = LN.predict(model, valid).select("label", "predicted").collect()
    right = sum(r["label"] == r["predicted"] for r in rows) / len(rows)
    majority = max(sum(r["label"] == x for r in rows) for x in {r["label"] for r in rows}) / len(rows)
    assert right > majority + 0.1


def test_no_class_beyond_the_labels(fitted):
    model, train, _ = fitted
    labels = {r["label"] for r in train.select("label").distinct().collect()}
    top = LN.top_coefficients(model, train, 10).collect()
    assert len(top) == 10 * len(labels) and {r["label"] for r in top} == labels
    assert all(r["sharing"] >= 1 and r["coefficient"] > 0 for r in top)
    assert {(r["label"], r["rank"]) for r in top} == {(x, i) for x in labels for i in range(1, 11)}


def test_unseen_and_null_labels_are_scored(fitted):
    model, train, valid = fitted
    odd = valid.limit(4).withColumn("label", F.when(F.col("doc_id") % 2 == 0, "xx"))
    assert LN.predict(model, odd).filter("predicted IS NOT NULL").count() == odd.count()
    # rows without a label are no training rows
    some = train.limit(60).withColumn("label", F.when(F.col("doc_id") % 3 > 0, F.col("label")))
    m = LN.text_classifier(max_iter=1).fit(some)
    assert None not in m.stages[-1].labels


def test_features_are_the_hashed_relational_tfidf(fitted):
    """Counts of terms that share a feature add up; idf and norm follow from the sums."""
    _, train, _ = fitted
    small = train.limit(40).select("doc_id", "text", "label")
    m = LN.text_classifier(max_iter=1).fit(small)
    got = {(r["doc_id"], r["feature"]): r["weight"] for r in LN.features(m, small.select("doc_id", "text")).collect()}
    place = {r["term"]: r["feature"] for r in LN.term_index(m, small).collect()}
    cells = Counter()
    for r in terms.term_counts(small).collect():
        cells[r["doc_id"], place[r["term"]]] += r["tf"]
    df = Counter(f for _, f in cells)
    n = small.count()
    w = {k: tf * (math.log((1 + n) / (1 + df[k[1]])) + 1) for k, tf in cells.items()}
    norm = Counter()
    for (d, _), x in w.items():
        norm[d] += x * x
    assert got.keys() == w.keys()
    assert all(abs(got[k] - x / math.sqrt(norm[k[0]])) < 1e-9 for k, x in w.items())
    said = LN.collisions(LN.term_index(m, small)).first()
    per = Counter(place.values())
    assert said["n_terms"] == len(place) and said["n_features"] == len(per) <= LN.WIDTH
    assert said["n_shared"] == sum(k for k in per.values() if k > 1) and abs(said["shared"] - said["n_shared"] / len(place)) < 1e-12
    wide = LN.text_classifier(max_iter=1, width=1 << 20).fit(small)
    assert LN.collisions(LN.term_index(wide, small)).first()["shared"] < 0.02


class Constant(Estimator):
    """An injected estimator that has nothing in common with the built-in one."""

    def __init__(self, weight_col=None):
        super().__init__()
        self.weight_col = weight_col

    def _fit(self, dataset):
        w = F.sum(self.weight_col) if self.weight_col else F.count(F.lit(1))
        top = dataset.groupBy("label").agg(w.alias("w")).orderBy(F.desc("w"), "label").first()["label"]

        class Fitted(Model):
            def _transform(self, df):
                return df.withColumn("prediction", F.lit(top))
        return Fitted()


def test_injected_estimator(docs):
    out = LN.learning_curve(docs, fractions=[0.5, 1.0], estimator_fn=Constant).collect()
    assert {r["percentage"] for r in out} == {0.5, 1.0}
    assert {r["metric"] for r in out} == set(MT.METRICS)
    cumulative = LN.learning_curve(docs, fractions=[0.5, 1.0], estimator_fn=Constant, cumulative=True)
    assert cumulative.count() == 8


def solver(model):
    return next(s for s in model.stages if isinstance(s, LN.LabelledLogistic))


def test_the_fit_converges(fitted):
    """The objective is flat at the end, below the step limit; with free intercepts the
    predicted probabilities of the training rows then sum to the class counts."""
    model, train, _ = fitted
    labels, h = solver(model).labels, solver(model).objective_history
    assert len(h) < LN.MAX_ITER and h[-11] - h[-1] < 2e-3 * h[-1]
    probs = model.transform(train).select("label", *[F.col("probability")[i].alias(f"p{i}") for i in range(len(labels))])
    rows = probs.collect()
    for i, x in enumerate(labels):
        assert abs(sum(r[f"p{i}"] for r in rows) - sum(r["label"] == x for r in rows)) <= 0.01 * len(rows)


def test_a_weight_of_two_is_a_repeated_row(docs):
    some = docs.filter("doc_id < 120")
    a = LN.text_classifier(weight_col="w").fit(some.withColumn("w", F.lit(2.0)))
    b = LN.text_classifier().fit(some.unionByName(some))
    # the same rows for both: idf counts rows, not weights
    rows = [{r["doc_id"]: r["probability"] for r in m.stages[-1].transform(_features(b, some)).collect()} for m in (a, b)]
    assert np.isclose(solver(a).weight_sum, solver(b).weight_sum)
    assert len(rows[0]) == some.count()
    assert all(np.abs(np.array(rows[0][i]) - np.array(rows[1][i])).max() < 0.05 for i in rows[0])


def _features(model, df):
    for s in model.stages[:-1]:
        df = s.transform(df)
    return df


WORD2 = re.compile(r"\w{2,}")


def plain_bayes(train, texts, alpha=1.0):
    """train: (label, text, weight)."""
    count, rows, n = {}, Counter(), Counter()
    for y, t, w in train:
        rows[y] += w
        for x in WORD2.findall((t or "").lower()):
            count.setdefault(x, Counter())[y] += w
            n[y] += w
    out = []
    for t in texts:
        known = [x for x in WORD2.findall((t or "").lower()) if x in count]
        score = {y: round(math.log(rows[y] / sum(rows.values())) + sum(
            math.log(count[x][y] + alpha) - math.log(n[y] + alpha * len(count)) for x in known), 6) for y in rows}
        out.append(min(score, key=lambda y: (-score[y], y)))
    return out


def test_naive_bayes_equals_a_plain_one(spark, docs):
    rows = [(r["doc_id"], r["text"], r["label"]) for r in docs.filter("doc_id < 160").collect()]
    odd = [(900, None, "xx"), (901, "", "de"), (902, "unheard ofwords", "en"), (903, "aa aa aa", None), (904, "a b c", "fr")]
    for alpha, weight in ((1.0, None), (0.1, "w")):
        d = spark.createDataFrame([(*r, 1.0 + r[0] % 3) for r in rows + odd], "doc_id long, text string, label string, w double")
        model = NaiveBayesTable(alpha=alpha, weight_col=weight).fit(d.filter("doc_id % 2 = 0"))
        got = {r["doc_id"]: r["predicted"] for r in model.transform(d).select("doc_id", "predicted").collect()}
        train = [(y, t, 1.0 + i % 3 if weight else 1.0) for i, t, y in rows + odd if i % 2 == 0 and y is not None]
        assert got == dict(zip([r[0] for r in rows + odd], plain_bayes(train, [r[1] for r in rows + odd], alpha)))
    assert model.transform(d).columns == ["doc_id", "label", "w", "predicted"]
    with pytest.raises(ValueError):
        NaiveBayesTable().fit(d.filter("label = 'none'"))


def test_naive_bayes_shuffles_no_text(spark, docs):
    model = NaiveBayesTable().fit(docs.filter("doc_id < 50"))
    plan = model.transform(docs)._jdf.queryExecution().executedPlan().toString()
    exchange = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len(exchange) == 1 and "_nb_row" in exchange[0]


def test_few_shot_head_scores_every_row(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    wide, pred = LN.few_shot_head(emb, 16)
    r = wide.first()
    assert 0.0 <= r["f1"] <= 1.0 and r["n_invalid"] == 0
    assert pred.filter("prediction IS NULL").count() == 0


def test_contrastive_pairs_teach_the_few_shot_head(spark):
    """Classes differ in three weak components beside thirty loud ones."""
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(4, 3))
    rows = [(i, i % 4, (centres[i % 4] + 0.2 * rnd.normal(size=3)).tolist() + (6 * rnd.normal(size=30)).tolist()) for i in range(800)]
    d = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    raw, _ = LN.few_shot_head(d, 30)
    taught, pred = LN.few_shot_head(d, 30, pair_dims=3)
    assert taught.first()["accuracy"] >= raw.first()["accuracy"] and taught.first()["accuracy"] > 0.5
    assert pred.count() == 400


def test_a_curve_cuts_texts_once_for_estimators_that_prepare_them(spark):
    from wordmill.operators.bayes import NaiveBayesTable
    rows = [(i, f"{'good nice' if i % 2 else 'bad poor'} w{i % 7}" if i % 11 else None, "ab"[i % 2]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(4)
    seen = []

    class Plain(NaiveBayesTable):
        prepared = None

    class Watched(NaiveBayesTable):
        def _fit(self, dataset):
            seen.append(dataset.schema["text"].dataType.simpleString())
            return super()._fit(dataset)

    def curve(cls):
        got = LN.learning_curve(docs, estimator_fn=lambda **kw: cls(**kw), cumulative=True).collect()
        return sorted((r["percentage"], r["metric"], round(r["value"], 9)) for r in got)
    assert curve(Watched) == curve(Plain)
    assert len(seen) == 5 and set(seen) == {"array<struct<term:string,tf:bigint>>"}


def test_the_built_in_curve_hashes_texts_once(spark, monkeypatch):
    """Every share is fitted on hashed counts, two at a time or one, and gives what fits on
    the tokens of every share give."""
    rows = [(i, f"{'good nice' if i % 2 else 'bad poor'} w{i % 7} w{i % 5}", "ab"[i % 2 if i % 9 else 0]) for i in range(90)]
    docs, seen = spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(3), []
    fit = LN.TextClassifier._fit

    def watched(self, dataset):
        seen.append({"_tf", "_size"} <= set(dataset.columns) and "text" not in dataset.columns)
        self.max_iter = 4
        return fit(self, dataset)
    monkeypatch.setattr(LN.TextClassifier, "_fit", watched)

    class Plain(Estimator):
        def _fit(self, dataset):
            return fit(LN.TextClassifier(max_iter=4), dataset)

    def curve(**kw):
        got = LN.learning_curve(docs, fractions=[0.5, 1.0], **kw).collect()
        return sorted((r["percentage"], r["metric"], round(r["value"], 6)) for r in got)
    plain = curve(estimator_fn=Plain)
    assert not seen
    assert curve() == plain and seen == [True] * 2
    monkeypatch.setattr(LN, "PARALLEL_BYTES_PER_CORE", 0)
    assert curve(cumulative=True) and seen == [True] * 4


def test_models_side_by_side_only_where_their_rows_fit(spark):
    counted = spark.range(4).selectExpr("1000 * id AS _size")
    room = spark.sparkContext.defaultParallelism * LN.PARALLEL_BYTES_PER_CORE
    assert LN.at_a_time(counted) == LN.PARALLELISM == 2
    assert LN.at_a_time(spark.range(1).selectExpr(f"CAST({room} AS BIGINT) AS _size")) == 1


def test_few_file_splits_are_dealt_out(spark, tmp_path):
    from wordmill import session as S
    spark.range(100).write.parquet(str(tmp_path / "t"))
    d = spark.read.parquet(str(tmp_path / "t"))
    cores, size = spark.sparkContext.defaultParallelism, S.plan_bytes(d)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(S, "SPREAD_BYTES_PER_CORE", 0)
        assert S.even(d).rdd.getNumPartitions() == S.EVEN_TASKS_PER_CORE * cores
        m.setattr(S, "SPLIT_BYTES", size // (S.EVEN_TASKS_PER_CORE * cores))
        assert S.even(d) is d
    assert S.even(d) is d


def test_a_curve_of_a_large_input_keeps_no_rows_in_memory(spark, monkeypatch):
    """Beyond a small input, counted terms for an injected estimator are written, not persisted."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 120").select("doc_id", "text", F.col("lang").alias("label"))
    plans = []

    class Watched(NaiveBayesTable):
        def _fit(self, dataset):
            plans.append(dataset._jdf.queryExecution().executedPlan().toString())
            return super()._fit(dataset)

    def curve():
        plans.clear()
        got = LN.learning_curve(docs, fractions=[0.5, 1.0], estimator_fn=lambda **kw: Watched(**kw), cumulative=True).collect()
        return sorted((r["percentage"], r["metric"], round(r["value"], 9)) for r in got)
    small = curve()
    assert len(plans) == 2 and all("InMemoryTableScan" in p for p in plans)
    monkeypatch.setattr(session, "plan_bytes", lambda d: 1 << 50)
    assert curve() == small
    assert len(plans) == 2 and not any("InMemoryTableScan" in p or "regexp_extract_all" in p for p in plans)


def test_term_tables_of_a_curve_are_broadcast_only_while_small(spark, docs, monkeypatch):
    from wordmill.operators import bayes
    model = NaiveBayesTable().fit(docs.filter("doc_id < 50"))

    def scored():
        out = model.transform(docs.filter("doc_id < 100"))
        return out._jdf.queryExecution().executedPlan().toString(), sorted(tuple(r) for r in out.collect())
    assert bayes.MAX_TABLE_BYTES < session.MAX_BROADCAST_BYTES
    plan, inside = scored()
    assert "BroadcastHashJoin" in plan
    monkeypatch.setattr(bayes, "MAX_TABLE_BYTES", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan, met = scored()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" not in plan and met == inside

"""Metrics properties, result reshaping, jobs with fixed stand-in functions, and the
ported contract of the reference's only test (generated samples)."""

import os
import uuid
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from wordmill.functions import fixed
from wordmill.operators import jobs as JB
from wordmill.operators import metrics as MT
from wordmill.operators import sampling as M

EMB = "/root/testdata/sf0.01/embeddings.parquet"


def test_weighted_matches_evaluator_and_recall_is_accuracy(spark):
    e = spark.read.parquet(EMB).select("vec_id", "label")
    p = e.withColumn("prediction", MT.standin_prediction("t", "vec_id")).filter("prediction IS NOT NULL")
    m = MT.weighted(p).first()
    assert abs(m["recall"] - m["accuracy"]) < 1e-12
    pd_ = p.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    for name, metric in [("f1", "f1"), ("precision", "weightedPrecision"), ("accuracy", "accuracy")]:
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)
        assert abs(ev.evaluate(pd_) - m[name]) < 1e-9


def test_null_prediction_counts_as_wrong(spark):
    df = spark.createDataFrame([(0, 0), (0, None), (1, 1), (1, 0)], "label int, prediction int")
    m = MT.weighted(df).first()
    assert m["accuracy"] == 0.5 and m["n_invalid"] == 1


def test_to_long_empty_and_grid(spark):
    empty = spark.createDataFrame([], "percentage double, f1 double, precision double, recall double, accuracy double")
    assert MT.to_long(empty).count() == 0
    wide = spark.createDataFrame([("a", 0.05, 1.0, 1.0, 1.0, 1.0), ("a", 0.25, 1.0, 1.0, 1.0, 1.0),
                                  ("b", 0.06, 0.5, 0.5, 0.5, 0.5)],
                                 "method string, percentage double, f1 double, precision double, "
                                 "recall double, accuracy double")
    long = MT.percent_scale(MT.to_long(wide, ["method", "percentage"]))
    assert {r["percentage"] for r in long.filter("method = 'a'").collect()} == {5.0, 25.0}
    ext = MT.extend_single_points(long)
    assert ext.filter("method = 'b'").count() == 4 * 11
    assert ext.filter("method = 'a'").count() == 8


def test_contrastive_pairs_properties(spark):
    e = spark.read.parquet(EMB).select("vec_id", "label")
    few = M.per_class(e, 8, label_col="label", seed=1, id_cols="vec_id")
    pairs = JB.contrastive_pairs(few, 5).collect()
    lab = {r["vec_id"]: r["label"] for r in few.collect()}
    assert all(r["a_id"] != r["b_id"] for r in pairs)
    assert all((lab[r["a_id"]] == lab[r["b_id"]]) == r["similar"] for r in pairs)
    per = pd.DataFrame([(r["a_id"], r["similar"]) for r in pairs], columns=["a", "s"]).value_counts()
    assert set(per.values) == {5}
    assert len({(r["a_id"], r["b_id"]) for r in pairs}) == len(pairs)


def test_score_batches_argmax(spark):
    df = spark.createDataFrame([(1, [0.1, 0.9, 0.9]), (2, [3.0, 1.0, 2.0])], "id long, v array<double>")
    out = JB.score_batches(df, lambda pdf: pdf["v"], keep=["id"]).collect()
    assert {r["id"]: r["prediction"] for r in out} == {1: 1, 2: 0}


def test_prompt_classify_with_fixed_responder(spark):
    items = spark.createDataFrame([(1, "I feel great", 1), (2, "so sad", 0)], "doc_id long, text string, label int")
    few = spark.createDataFrame([(9, "yay", 1)], "doc_id long, text string, label int")

    def responder(pdf):
        return pd.Series(["1" if "great" in p else "sadness" for p in pdf["prompt"]], index=pdf.index)

    out = {r["doc_id"]: r for r in JB.prompt_classify(items, few, responder).collect()}
    assert out[1]["prediction"] == 1 and out[2]["prediction"] is None
    m = JB.prompt_metrics(JB.prompt_classify(items, few, responder)).first()
    assert m["n_invalid"] == 1 and m["accuracy"] == 0.5


def test_generate_contract(spark):
    """Ported contract: n rows per class, text and label present, label is the class name."""
    ctx = spark.createDataFrame([(0, "Some TEXT\nmore")], "item_id long, text string")
    out = JB.generate(ctx, lambda pdf: "  " + pdf["text"] + "\r\n", n_per_class=5, names=True).collect()
    assert len(out) == 5 * 6
    assert {r["label"] for r in out} == set(fixed.EMOTIONS)
    assert all(r["text"] == r["text"].lower() and "\n" not in r["text"] and r["error"] is None for r in out)
    coded = JB.generate(ctx, lambda pdf: pdf["text"]).collect()
    assert sorted(r["label"] for r in coded) == sorted(fixed.EMOTION_CODES.values())


def test_each_row_is_answered_once_and_failures_stay_rows(spark):
    calls = spark.sparkContext.accumulator(0)
    items = spark.createDataFrame([(i, f"text {i}", i % 2) for i in range(40)], "doc_id long, text string, label int")

    def responder(pdf):
        calls.add(len(pdf))
        return pd.Series(["1"] * len(pdf), index=pdf.index)

    m = JB.prompt_metrics(JB.prompt_classify(items, None, responder)).first()
    assert calls.value == 40 and m["accuracy"] == 0.5

    def fails_on_seven(pdf):
        if pdf["prompt"].str.contains("text 7\n").any():
            raise ValueError("no answer")
        return pd.Series(["1"] * len(pdf), index=pdf.index)

    out = {r["doc_id"]: r for r in JB.prompt_classify(items, None, fails_on_seven).collect()}
    assert len(out) == 40 and out[7]["reply"] is None and "no answer" in out[7]["error"]
    assert all(r["reply"] == "1" and r["error"] is None for i, r in out.items() if i != 7)


def test_negatives_reach_every_class(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "label")
    few = M.per_class(e, 32, label_col="label", seed=1, id_cols="vec_id")
    label = {r["vec_id"]: r["label"] for r in few.collect()}
    classes: dict = {}
    for r in JB.contrastive_pairs(few, 20).filter("NOT similar").collect():
        classes.setdefault(r["a_id"], set()).add(label[r["b_id"]])
    assert len(classes) == len(label)
    assert all(len(c) == 9 and label[a] not in c for a, c in classes.items())
    with pytest.raises(ValueError):
        JB.contrastive_pairs(few, 20, max_rows=10)


def test_one_scan_of_the_predictions(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "label")
    plan = MT.weighted(e.withColumn("prediction", MT.standin_prediction("t", "vec_id")))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1


def test_every_example_is_in_the_prompt_or_the_table_is_refused(spark):
    few = spark.range(1_001).select(F.col("id").alias("doc_id"), F.format_string("example %d", "id").alias("text"),
                                    (F.col("id") % 2).cast("int").alias("label"))
    items = spark.createDataFrame([(1, "the item", 0)], "doc_id long, text string, label int")
    with pytest.raises(ValueError, match="1000"):
        JB.few_shot_block(few)
    with pytest.raises(ValueError):
        JB.prompt_classify(items, few, lambda pdf: pdf["prompt"])
    block = spark.range(1).select(JB.few_shot_block(few.limit(1_000)).alias("b")).first()["b"]
    assert block.count("Text: example ") == 1_000


def test_no_prompt_is_asked_twice_across_failures_and_reruns(spark):
    from wordmill.session import scratch_path
    asked = spark.sparkContext.accumulator(0)
    path = scratch_path(spark, "test-replies")
    items = spark.createDataFrame([(i, f"text {i % 30}", 0) for i in range(40)] + [(99, None, 0)],
                                  "doc_id long, text string, label int")

    def flaky(broken):
        def responder(pdf):
            asked.add(len(pdf))
            if broken and pdf["prompt"].str.contains("text 7\n").any():
                raise ValueError("busy")
            return pd.Series(["1"] * len(pdf), index=pdf.index)
        return responder

    first = JB.prompt_classify(items, None, flaky(True), path=path, per_step=5)
    assert first.filter("error LIKE '%busy%'").count() == 2 and asked.value == 30  # 30 distinct prompts, one fails
    again = JB.prompt_classify(items, None, flaky(False), path=path, per_step=5)
    assert again.filter("reply = '1'").count() == 40 and again.count() == 41 and asked.value == 31
    JB.prompt_classify(items, None, flaky(False), path=path).count()
    assert asked.value == 31
    changed = items.withColumn("text", F.when(F.col("doc_id") == 3, "another").otherwise(F.col("text")))
    assert JB.prompt_classify(changed, None, flaky(False), path=path).filter("reply IS NULL").count() == 1
    assert asked.value == 32


def test_a_step_that_dies_leaves_the_earlier_ones(spark):
    from wordmill.session import scratch_path
    asked = spark.sparkContext.accumulator(0)
    path = scratch_path(spark, "test-steps")
    items = spark.createDataFrame([(i, f"text {i}", 0) for i in range(64)], "doc_id long, text string, label int")

    def dies(pdf):
        if pdf["prompt"].str.contains("text 41\n").any():
            raise SystemExit("killed")
        asked.add(len(pdf))
        return pd.Series(["1"] * len(pdf), index=pdf.index)

    def works(pdf):
        asked.add(len(pdf))
        return pd.Series(["1"] * len(pdf), index=pdf.index)
    with pytest.raises(Exception):
        JB.prompt_classify(items, None, dies, path=path, per_step=8)
    stored = spark.read.parquet(path).count()
    before = asked.value
    out = JB.prompt_classify(items, None, works, path=path, per_step=8)
    assert out.filter("reply = '1'").count() == 64 and asked.value - before == 64 - stored


def test_pair_scatter_equals_a_plain_sum(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(9, 4))
    vectors = spark.createDataFrame([(i, x[i].tolist()) for i in range(9)] + [(9, None)], "vec_id int, embedding array<double>")
    pairs = [(0, 1, True), (2, 3, True), (4, 5, False), (6, 6, True), (7, 8, False), (0, 9, True)]
    got = JB.pair_scatter(spark.createDataFrame(pairs, "a_id int, b_id int, similar boolean").repartition(3), vectors).collect()
    want = {True: np.zeros((4, 4)), False: np.zeros((4, 4))}
    for a, b, kind in pairs[:-1]:
        want[kind] += np.outer(x[a] - x[b], x[a] - x[b])
    assert len(got) == 20 and all(abs(r["value"] - want[r["similar"]][r["i"], r["j"]]) < 1e-9 for r in got)
    with pytest.raises(ValueError):
        JB.pair_projection(JB.pair_scatter(spark.createDataFrame(pairs[:2], "a_id int, b_id int, similar boolean"), vectors), 2)


def test_projection_keeps_nulls_and_multiplies(spark):
    m = np.array([[1.0, 0.0], [2.0, 1.0], [0.0, -1.0]])
    d = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, None), (3, [0.0, 0.0, 1.0])], "vec_id int, embedding array<float>")
    got = {r["vec_id"]: r["projected"] for r in JB.project(d, m).collect()}
    assert got == {1: [5.0, -1.0], 2: None, 3: [0.0, -1.0]}


def test_a_model_is_loaded_once_per_worker(spark, tmp_path):
    def count_loads(path):
        """A scorer whose loading leaves a file per call, named by the process."""
        base, place = Path(path).read_text().split()
        (Path(place) / f"{os.getpid()}-{uuid.uuid4().hex}").touch()
        return lambda v: np.stack([v.sum(axis=1), v.max(axis=1) * float(base)], axis=1)

    artefact = JB.publish_artefact(spark, f"3 {tmp_path}".encode(), "model.txt")
    rows = [(i, [float(i % 5), 1.0, -2.0]) for i in range(4000)] + [(4000, None)]
    d = spark.createDataFrame(rows, "vec_id int, embedding array<float>").repartition(40)
    got = JB.score_with_model(d, artefact, count_loads, keep=["vec_id"], vec_col="embedding", width=3, batch_rows=16).collect()
    for r in got:
        v = rows[r["vec_id"]][1]
        if v is None:
            assert r["scores"] is None and r["prediction"] is None
        else:
            assert r["scores"] == [sum(v), 3 * max(v)] and r["prediction"] == int(3 * max(v) > sum(v))
    loads = [f.name.split("-")[0] for f in tmp_path.iterdir()]
    assert len(got) == 4001 and loads and len(loads) == len(set(loads)) < 40


def test_prompts_are_rendered_where_they_are_asked(spark, monkeypatch):
    """No prompt, which repeats all examples, is shuffled or stored: only texts and keys."""
    from wordmill.session import scratch_path
    paths = {}
    monkeypatch.setattr(JB, "scratch_path", lambda s, name: paths.setdefault(name, scratch_path(s, name)))
    items = spark.createDataFrame([(1, "first text", 0), (2, "first text", 1), (3, None, 1)], "doc_id long, text string, label int")
    few = spark.createDataFrame([(9, "EXAMPLE " * 50, 1)], "doc_id long, text string, label int")

    def responder(pdf):
        assert list(pdf.columns) == ["prompt"]
        return pdf["prompt"].str.count("EXAMPLE").astype(str)
    got = JB.prompt_classify(items, few, responder).collect()
    assert sorted((r["doc_id"], r["prediction"], r["error"]) for r in got) == [(1, 50, None), (2, 50, None), (3, None, None)]
    stored = spark.read.parquet(paths["prompts"])
    assert stored.count() == 1 and "EXAMPLE" not in str(stored.collect())

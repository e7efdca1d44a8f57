import pytest
from pyspark.sql import functions as F

from wordmill.session import scratch_path
from wordmill.sources import datasets as DS
from wordmill.sources import store as ST


def test_read_split_missing_raises(spark):
    df = spark.createDataFrame([(1, "a", "x", "train")], "doc_id long, text string, label string, split string")
    assert DS.read_split(df, "train").count() == 1
    with pytest.raises(ValueError):
        DS.read_split(df, "test")


def test_labelled_checks_columns(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, body string")
    with pytest.raises(ValueError):
        DS.labelled(df, id_cols="doc_id")


def test_materialize_reuses(spark):
    path = scratch_path(spark, "test-mat")
    calls = []

    def fn():
        calls.append(1)
        return spark.range(3)

    assert ST.materialize(spark, fn, path).count() == 3
    assert ST.materialize(spark, fn, path).count() == 3
    assert len(calls) == 1
    ST.materialize(spark, fn, path, reload=True)
    assert len(calls) == 2


def test_keyed_path_has_every_parameter():
    p = ST.keyed_path("/x", "zeroshot", temperature=0.2, num_samples=32)
    assert p == "/x/zeroshot/num_samples=32/temperature=0.2"


def test_csv_roundtrip(spark):
    path = scratch_path(spark, "test-csv")
    df = spark.createDataFrame([("m", 5.0, "f1", 0.123456)], ST.RESULT_SCHEMA)
    ST.write_table(df, path)
    assert ST.read_table(spark, path).collect() == df.collect()


def test_changed_input_or_parameters_are_computed_anew(spark):
    base = scratch_path(spark, "test-input")
    spark.range(5).write.parquet(f"{base}/in")
    calls = []

    def fn():
        calls.append(1)
        return spark.read.parquet(f"{base}/in").selectExpr("count(*) AS n")

    def run(**params):
        return ST.materialize_for(spark, fn, f"{base}/out", "counts", inputs=[f"{base}/in"], **params).first()["n"]
    assert (run(k=1), run(k=1), len(calls)) == (5, 5, 1)
    assert (run(k=2), run(k=1, text="a/b c"), len(calls)) == (5, 5, 3)
    spark.range(3).write.mode("append").parquet(f"{base}/in")
    assert (run(k=1), run(k=1), len(calls)) == (8, 8, 4)


def test_an_interrupted_write_is_never_read(spark):
    path = scratch_path(spark, "test-broken")
    bad = spark.range(4).selectExpr("id", "if(id = 3, raise_error('stop'), id) AS x")
    with pytest.raises(Exception, match="stop"):
        ST.materialize(spark, lambda: bad, path)
    assert not ST.exists(spark, path)
    assert ST.materialize(spark, lambda: spark.range(2), path).count() == 2
    with pytest.raises(Exception, match="stop"):
        ST.materialize(spark, lambda: bad, path, reload=True)
    assert ST.materialize(spark, lambda: spark.range(9), path).count() == 2  # the old table is still there
    assert ST.materialize(spark, lambda: spark.range(9), path, reload=True).count() == 9
    with pytest.raises(ValueError):
        ST.materialize(spark, lambda: spark.range(2), path, fmt="csv")

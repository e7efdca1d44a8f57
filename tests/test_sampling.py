"""Sampling properties: exact sizes, nesting, disjoint and complete splits, quotas,
independence from partitioning."""

import math

from pyspark.sql import functions as F

from wordmill.operators import sampling as M

DOCS = "/root/testdata/sf0.01/documents.parquet"


def ids(df, col="doc_id"):
    return {r[col] for r in df.select(col).collect()}


def test_exact_and_nested(spark):
    d = spark.read.parquet(DOCS).select("doc_id", "lang")
    n = d.count()
    small = ids(M.sample_fraction(d, 0.05, seed=1, id_cols="doc_id"))
    big = ids(M.sample_fraction(d, 0.45, seed=1, id_cols="doc_id"))
    assert len(small) == round(0.05 * n) and len(big) == round(0.45 * n)
    assert small <= big


def test_partitioning_independent(spark):
    d = spark.read.parquet(DOCS).select("doc_id", "lang")
    a = ids(M.sample_fraction(d, 0.3, seed=5, id_cols="doc_id"))
    b = ids(M.sample_fraction(d.repartition(7), 0.3, seed=5, id_cols="doc_id"))
    assert a == b


def test_split_disjoint_complete(spark):
    d = spark.read.parquet(DOCS).select("doc_id", "lang")
    s = M.split(d, 0.2, seed=3, id_cols="doc_id").collect()
    valid = [r for r in s if r["part"] == "valid"]
    assert len(s) == 1000 and len(valid) == math.ceil(0.2 * 1000)
    assert len({r["doc_id"] for r in s}) == 1000


def test_split_group_key_keeps_copies_together(spark):
    d = spark.read.parquet(DOCS).select("doc_id", "text")
    s = M.split(d, 0.2, seed=3, id_cols="doc_id", group_key=F.md5("text"))
    per_text = s.groupBy("text").agg(F.countDistinct("part").alias("k"))
    assert per_text.filter("k > 1").count() == 0


def test_stratified_quotas_sum(spark):
    d = spark.read.parquet(DOCS).select("doc_id", F.col("lang").alias("label"))
    kept = M.stratified_fraction(d, 0.1, label_col="label", seed=2, id_cols="doc_id")
    assert kept.count() == 1000 - math.ceil(0.9 * 1000)
    q = {r["label"]: r["_q"] for r in M.stratified_quotas(d, 0.1, label_col="label").collect()}
    got = {r["label"]: r["count"] for r in kept.groupBy("label").count().collect()}
    assert q == got


def test_per_class_small_class_keeps_all(spark):
    lab = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    d = lab.select("doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("label"))
    sizes = {r["label"]: r["count"] for r in d.groupBy("label").count().collect()}
    few = M.per_class(d, 5, label_col="label", seed=0, id_cols="doc_id")
    got = {r["label"]: r["count"] for r in few.groupBy("label").count().collect()}
    assert got == {k: min(5, v) for k, v in sizes.items()}


def test_first_n_caps_and_empty(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id")
    assert M.first_n(e, 10_000, seed=0, id_cols="vec_id").count() == e.count()
    assert M.first_n(e.filter("vec_id < 0"), 5, seed=0, id_cols="vec_id").count() == 0


def test_ladder_rejects_above_one():
    import pytest
    assert M.ladder() == [0.05, 0.25, 0.45, 0.65, 0.85]
    with pytest.raises(ValueError):
        M.ladder([0.5, 1.2])


def test_ladder_splits_equal_sample_then_split(spark):
    """One-pass thresholds for a whole learning curve give, per share, exactly the
    rows and parts of M1 followed by M2 (composite ids, a full share included)."""
    conv = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn")
    keys = ["conv_id", "turn"]
    shares = [0.05, 0.45, 1.0]
    lp = M.ladder_splits(conv.repartition(5), shares, 0.2, seed=7, split_seed="7/split", id_cols=keys)
    for i, f in enumerate(shares):
        want = M.split(M.sample_fraction(conv, f, seed=7, id_cols=keys), 0.2, seed="7/split", id_cols=keys)
        a = sorted(tuple(r) for r in want.select(*keys, "part").collect())
        b = sorted(tuple(r) for r in lp.filter(F.col("_wm_parts")[i].isNotNull())
                   .select(*keys, F.col("_wm_parts")[i]).collect())
        assert a == b and len(a) == round(f * conv.count())


def test_stratified_ladder_equals_stratified_fraction(spark):
    d = spark.read.parquet(DOCS).select("doc_id", F.col("lang").alias("label"))
    shares = [0.05, 0.45, 0.85, 1.0]
    outs = M.stratified_ladder(d.repartition(3), shares, label_col="label", seed=11, id_cols="doc_id")
    for f, got in zip(shares, outs):
        want = M.stratified_fraction(d, f, label_col="label", seed=11, id_cols="doc_id")
        assert (sorted(tuple(r) for r in want.select("doc_id", "label").collect())
                == sorted(tuple(r) for r in got.select("doc_id", "label").collect()))


def test_null_strata_and_groups_are_kept(spark):
    d = spark.range(100).withColumn("label", F.when(F.col("id") % 4 > 0, F.col("id") % 4))
    half = M.stratified_fraction(d, 0.5, label_col="label", seed=1, id_cols="id")
    got = {r["label"]: r["count"] for r in half.groupBy("label").count().collect()}
    assert sum(got.values()) == 50 and got[None] in (12, 13)
    s = M.split(d, 0.3, seed=1, id_cols="id", group_key="label").collect()
    assert len(s) == 100 and len({r["part"] for r in s if r["label"] is None}) == 1


def test_sample_reads_its_input_three_times(spark):
    """Counts, boundary buckets, marks: the plan of the result scans the input twice (the
    counts are written before)."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    plan = M.sample_fraction(d, 0.3, seed=1, id_cols="doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 1


def test_realised_rate(spark):
    r = M.realised_rate(spark.range(10), spark.range(40), nominal_rows=8).first()
    assert (r["percentage"], r["labelled_share"]) == (0.2, 0.25)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_approximate_strata_nest_in_the_exact_ones_without_a_shuffle(spark):
    d = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, (F.col("id") % 4).cast("string")).alias("lang"))
    shares = {None: 0.2, "1": 0.5, "2": 1.0, "3": 0.01}
    got = M.stratified_approximate(d, shares, label_col="lang", seed=4, id_cols="doc_id")
    assert "Exchange" not in plan_of(got)
    kept = {r["lang"]: r["count"] for r in got.groupBy("lang").count().collect()}
    for label, p in shares.items():
        assert abs(kept.get(label, 0) - 10_000 * p) <= 5 * math.sqrt(10_000 * p * (1 - p))
    some = ids(M.stratified_approximate(d, 0.1, label_col="lang", seed=4, id_cols="doc_id"))
    assert some <= ids(M.stratified_fraction(d, 0.2, label_col="lang", seed=4, id_cols="doc_id"))
    assert some >= ids(M.stratified_fraction(d, 0.05, label_col="lang", seed=4, id_cols="doc_id"))
    assert ids(M.stratified_approximate(d, 0.0, label_col="lang", seed=4, id_cols="doc_id")) == set()
    assert ids(M.stratified_approximate(d, {"1": 0.3}, label_col="lang", seed=4, id_cols="doc_id")) < ids(d.filter("lang = '1'"))


def test_per_class_does_not_depend_on_the_salts(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("label"))
    want = None
    for parts in (1, 13, 200):
        got = ids(M.per_class(d.repartition(parts), 7, label_col="label", seed=2, id_cols="doc_id"))
        assert len(got) == 21 and got == (want or got)
        want = got
    plan = plan_of(M.per_class(d, 7, label_col="label", seed=2, id_cols="doc_id"))
    assert plan.count("WindowGroupLimit") >= 3

"""Session helpers: spreading, shuffle sizes, broadcasts and the shared folder."""

import types

import pytest

from wordmill import session as S


def test_spread_leaves_large_inputs_alone(spark, monkeypatch):
    df = spark.range(1000)
    monkeypatch.setattr(S, "plan_bytes", lambda d: 1 << 50)
    assert S.spread(df) is df


def test_spread_round_robins_small_inputs(spark):
    out = S.spread(spark.range(1000).coalesce(1), 6)
    assert out.rdd.getNumPartitions() == 6
    assert sorted(r[0] for r in out.collect()) == list(range(1000))


def test_broadcast_only_below_the_byte_limit(spark):
    df = spark.createDataFrame([("x" * 100,)] * 10, "s string")
    assert S.table_bytes(df) == 10 * (16 + 100)
    assert S.broadcast_if_small(df, 500) is df
    hinted = S.broadcast_if_small(df, 5000)
    assert hinted is not df and hinted.count() == 10


def test_shuffle_partitions_follow_the_input_bytes(spark, monkeypatch):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    try:
        monkeypatch.setattr(S, "plan_bytes", lambda d: 100 << 40)
        S.size_shuffles(spark.range(1))
        assert int(spark.conf.get(key)) == min(1_000_000, (100 << 40) * S.EXPANSION // S.SHUFFLE_PARTITION_BYTES)
        monkeypatch.setattr(S, "plan_bytes", lambda d: 1)
        S.size_shuffles(spark.range(1))  # never lowered
        assert int(spark.conf.get(key)) > 1000
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _cluster(scheme: str):
    home = types.SimpleNamespace(toString=lambda: f"{scheme}://store/home/me")
    fs = types.SimpleNamespace(getScheme=lambda: scheme, getHomeDirectory=lambda: home)
    hadoop = types.SimpleNamespace(FileSystem=types.SimpleNamespace(get=lambda conf: fs))
    jvm = types.SimpleNamespace(org=types.SimpleNamespace(apache=types.SimpleNamespace(
        hadoop=types.SimpleNamespace(fs=hadoop))))
    jsc = types.SimpleNamespace(hadoopConfiguration=lambda: None)
    return types.SimpleNamespace(sparkContext=types.SimpleNamespace(master="yarn", _jvm=jvm, _jsc=jsc))


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        S._default_dir(_cluster("file"))
    assert S._default_dir(_cluster("hdfs")) == "hdfs://store/home/me/.wordmill-checkpoints"


def test_rows_of_a_large_input_are_not_kept_in_memory(spark, monkeypatch):
    df = spark.createDataFrame([(1, [("a", 2)]), (None, [])], "id long, terms array<struct<term:string,tf:long>>")
    monkeypatch.setattr(S, "plan_bytes", lambda d: 1)
    small = S.hold(df.filter("id IS NULL"), df, "held")
    assert small.storageLevel.useMemory
    small.unpersist()
    monkeypatch.setattr(S, "plan_bytes", lambda d: 1 << 50)
    large = S.hold(df, df, "held")
    assert not large.storageLevel.useMemory and not df.storageLevel.useMemory
    assert sorted(large.collect(), key=str) == sorted(df.collect(), key=str) and large.dtypes == df.dtypes
    assert "parquet" in large._jdf.queryExecution().executedPlan().toString().lower()

"""Hard negatives against DuckDB and a plain version."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tools.oracle_check import canon
from wordmill.llm import hard_negatives as H


def test_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    res = con.execute(H.ORACLE)
    df = H.op13_hard_negatives(spark, sf)
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) > 100
    assert canon(df.columns, rows) == canon([d[0] for d in res.description], res.fetchall())


def plain(rows, every, positives=5, negatives=3):
    """rows: (vec_id, label, integer vector)."""
    out = set()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for a, la, va in rows:
        if a % every:
            continue
        scored = sorted((-dot(va, v), b, lb) for b, lb, v in rows if b != a)
        for ns, p, _ in [x for x in scored if x[2] == la][:positives]:
            ps = -ns
            ok = [(-s, b) for s, b, lb in scored if lb != la and 50 * ps <= 100 * -s <= 95 * ps]
            out |= {(a, p, r, b, ps, s) for r, (s, b) in enumerate(ok[:negatives], 1)}
    return out


def vectors(seed, n=260, dim=5):
    """Groups of near copies, many equal vectors, zero vectors and shorter ones."""
    rnd = random.Random(seed)
    out = []
    base = [[rnd.uniform(-1, 1) for _ in range(dim)] for _ in range(6)]
    for i in range(n):
        kind = rnd.random()
        b = rnd.choice(base)
        v = ([x + rnd.gauss(0, 0.05) for x in b] if kind < 0.4 else list(b) if kind < 0.7 else
             [0.0] * dim if kind < 0.75 else [rnd.uniform(-2, 2) for _ in range(dim - (kind > 0.95))])
        out.append((i, rnd.randrange(3), v))
    return out


@pytest.mark.parametrize("per_tree,max_bytes", [(40, 64 << 20), (7, 0)])
def test_trees_and_chunks_equal_the_plain_version(spark, per_tree, max_bytes):
    rows = vectors(per_tree)
    d = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = H.hard_negatives(d, F.col("vec_id") % 5 == 0, per_tree=per_tree, per_chunk=20, max_bytes=max_bytes).collect()
    want = plain([(i, y, [math.floor(256 * x) for x in v] + [0] * (5 - len(v))) for i, y, v in rows], 5)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(300, 6)) * 256)
    t = H.build_tree(np.arange(300), rng.integers(0, 2, 300), x)
    singles = np.sort(t.row[t.count == 0])
    assert singles.tolist() == list(range(300))  # every point once
    q = np.floor(rng.normal(size=6) * 256)
    low, high = H.bounds(t.points[t.row] @ q, float(q @ q), t.norm, t.radius)

    def points(node):
        if t.count[node] == 0:
            return [t.row[node]]
        return [p for c in range(t.first[node], t.first[node] + t.count[node]) for p in points(c)]
    for node in range(len(t.row)):
        dots = t.points[points(node)] @ q
        assert low[node] <= dots.min() and dots.max() <= high[node]
        if t.only[node]:
            assert len(set(t.labels[points(node)].tolist())) == 1


def test_descent_skips_nodes():
    """Far groups are not opened."""
    rng = np.random.default_rng(6)
    centers = np.eye(8) * 1_000
    x = np.floor(np.repeat(centers, 200, 0) + rng.normal(size=(1600, 8)))
    t = H.build_tree(np.arange(1600), np.zeros(1600, np.int64), x)
    opened = []

    class Watched:
        def __getitem__(self, i):
            opened.append(len(np.atleast_1d(i)))
            return x[i]
    q = x[3]
    kids = t.row[t.first[0]:t.first[0] + t.count[0]]
    best = [H.Best(5)]
    watched = H.Tree(t.ids, t.labels, Watched(), t.norm, t.row, t.radius, t.first, t.count, t.only)
    H.search(watched, x[kids] @ q, q, 0, True, 3, [(-1e300, 1e300)], best)
    dots = x @ q
    dots[3] = -np.inf
    assert best[0].id.tolist() == sorted(range(1600), key=lambda i: (-dots[i], i))[:5]
    assert sum(opened) < 500


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 0, [1.0, 0.0], "x"), (1, 0, [0.9, 0.1], "x"), (2, 1, [0.7, 0.2], "x"), (2, 1, [0.7, 0.2], "x"),
            (None, 1, [1.0, 0.0], "x"), (3, None, [1.0, 0.0], "x"), (4, 1, None, "x"), (5, 1, [nan, 0.0], "x"),
            (6, 1, [inf, 0.0], None), (8, 1, [None, 0.0], "x"), (9, 1, [], "x"), (10, 1, [0.6], "x")]
    d = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, rank string")
    d = d.withColumn("score", F.lit(1)).withColumn("windows", F.lit(1)).withColumn("block", F.lit("b"))
    got = {tuple(r) for r in H.hard_negatives(d, F.col("vec_id") % 50 == 0).collect()}
    use = [(0, 0, [256, 0]), (1, 0, [230, 25]), (2, 1, [179, 51]), (9, 1, [0, 0]), (10, 1, [153, 0])]
    assert got == plain(use, 50) and len(got) == 2
    assert H.hard_negatives(d.filter("false"), F.col("vec_id") % 50 == 0).count() == 0
    one = d.filter("vec_id = 0")
    assert H.hard_negatives(one, F.col("vec_id") % 50 == 0).count() == 0

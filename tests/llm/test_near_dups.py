"""Near duplicates and components against plain versions."""

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from wordmill.llm import near_dups as N
from wordmill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").encode().lower().decode())
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def plain_components(rows):
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                u, v = sorted((find(a), find(b)))
                root[v] = u
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def groups_of_copies(seed, n_groups=6, size=25):
    """Groups that drift apart step by step, so that links make chains and borders."""
    rnd = random.Random(seed)
    texts = []
    for g in range(n_groups):
        words = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([6, 12, 40, 120]))]
        for _ in range(size):
            texts.append(" ".join(words))
            if rnd.random() < 0.7:
                words = list(words)
                words[rnd.randrange(len(words))] = f"n{rnd.randrange(5000)}"
    texts += ["", "one", "One", "one two three", "ONE two three", None]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,members", [(1, 512), (2, 2)])
def test_equals_all_pairs(spark, monkeypatch, seed, members):
    """With two components per bucket allowed, nearly every bucket is split by bands."""
    monkeypatch.setattr(N, "BUCKET_COMPONENTS", members)
    rows = groups_of_copies(seed)
    out = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert len(out) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in out} == plain_components(rows)


def test_query_equals_its_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    assert sorted(tuple(r) for r in N.op4_near_duplicates(spark, sf).collect()) == sorted(con.execute(N.ORACLE).fetchall())


def test_odd_and_empty_tables(spark, odd, empty):
    out = N.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    for r in out:
        if r["doc_id"] is None:
            assert r["kept"] and r["component_id"] is None
    assert N.near_duplicates(empty).count() == 0
    assert N.near_duplicates(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).filter("kept").count() == 2


def test_registers_merge_and_estimate():
    """The sketch of a union is the larger register of both; the likelihood estimate is
    near the true similarity."""
    rng = np.random.default_rng(1)
    a, b = (np.sort(rng.integers(0, 2**63, 900, dtype=np.uint64)) for _ in "ab")
    b[:600] = a[:600]
    b = np.sort(b)
    both = np.unique(np.concatenate([a, b]))
    r = [N.registers(x, np.array([0, len(x)])) for x in (a, b, both)]
    assert (np.maximum(r[0], r[1]) == r[2]).all()
    j = N.estimate(r[0], r[1], np.array([900.0]), np.array([900.0]))[0]
    assert abs(j - 600 / 1200) < 0.15
    assert N.estimate(r[0], r[0], np.array([900.0]), np.array([900.0]))[0] > 0.99


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(200, 260)] + [(7, 7), (None, 3)]
    edges += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(60)]
    root: dict = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for u, v in edges:
        if u is not None and u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    rnd.shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    groups = defaultdict(set)
    for x in root:
        groups[find(x)].add(x)
    assert got == {x: min(g) for g in groups.values() for x in g if len(g) > 1}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0

"""Toxicity by nearest labelled examples: exact cosine, evidence, held-out accuracy."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordmill.llm import toxicity as X

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_terms(text):
    out = Counter()
    for w in WORD.findall(lower(text)):
        out[w[:X.WORD_CHARS]] += 1
        for n in X.STEMS:
            if len(w) > n:
                out[w[:n] + "*"] += 1
    return out


def test_terms_equal_the_plain_version():
    texts = ["Ab abcd abcde ABCDEFG", "", None, "éàüßœ éàüßœx 世界世界世界世界 a1b2", "x" * 100, "stem stems", "1,2;3"]
    assert X.texts_terms(texts) == [set(plain_terms(t)) for t in texts]
    vocabulary = sorted({t for x in texts for t in plain_terms(x)})
    counter = X.Terms(vocabulary)
    import pyarrow as pa
    from wordmill.llm import textbytes as B
    got = [Counter() for _ in texts]
    for row, _, data, offsets in B.blocks(pa.array(texts, pa.string())):
        for r, t, n in zip(*(c.tolist() for c in counter.counts(data, offsets))):
            got[row + r][vocabulary[t]] += n
    assert got == [plain_terms(t) for t in texts]


def random_index(seed, n=700, n_terms=40):
    rnd = random.Random(seed)
    vectors = []
    for _ in range(n):
        some = sorted(rnd.sample(range(n_terms), rnd.choice([0, 1, 2, 5, 9])))
        vectors.append((some, [rnd.choice([1, 1, 2, 7]) for _ in some]))
    idf = np.array([rnd.uniform(1, 9) for _ in range(n_terms)])
    ids = rnd.sample(range(5_000), n)
    return ids, [rnd.randrange(2) for _ in ids], vectors, idf


def plain_unit(terms, counts, idf):
    w = {t: (1 + math.log(c)) * idf[t] for t, c in zip(terms, counts)}
    norm = math.sqrt(sum(x * x for x in w.values()))
    return {t: x / norm for t, x in w.items()} if norm else {}


@pytest.mark.parametrize("k", [1, 10, 200])
def test_blocked_search_is_exact(k):
    ids, toxic, vectors, idf = random_index(k)
    index = X.build_index(ids, toxic, vectors, idf)
    label = dict(zip(ids, toxic))
    units = {i: plain_unit(*v, idf) for i, v in zip(ids, vectors)}
    for terms, counts in vectors[:80]:
        q = plain_unit(terms, counts, idf)
        want = sorted((-round(sum(x * u.get(t, 0.0) for t, x in q.items()), 12), i) for i, u in units.items())
        want = [(i, -s) for s, i in want if s < 0][:k]
        t, c = np.array(terms, np.int64), np.array(counts, float)
        got = index.nearest(t, index.unit(t, c), k)
        assert np.allclose([s for s, _ in got], [s for _, s in want], atol=1e-11)
        assert [int(index.toxic[x]) for _, x in got] == [label[int(index.ids[x])] for _, x in got]
        # ids agree where cosines do not tie within rounding
        clear = [j for j in range(len(want)) if all(abs(want[j][1] - s) > 1e-9 for n, (_, s) in enumerate(want) if n != j)]
        clear = [j for j in clear if j < k - 1]
        assert all(int(index.ids[got[j][1]]) == want[j][0] for j in clear)


def test_equal_blocks_are_searched_in_a_few_array_passes(monkeypatch):
    # 2,560 examples with the same terms: no block can be ruled out, as in a table with few terms
    ids, idf = list(range(2_560)), np.array([1.0, 2.0])
    index = X.build_index(ids, [i % 2 for i in ids], [([0, 1], [1, 1 + i % 3 // 2]) for i in ids], idf)
    passes, ranges = [], X._ranges
    monkeypatch.setattr(X, "_ranges", lambda a, b: passes.append(1) or ranges(a, b))
    terms, counts = np.array([0, 1]), np.array([1.0, 1.0])
    got = index.nearest(terms, index.unit(terms, counts))
    assert [int(index.ids[x]) for _, x in got] == [i for i in ids if i % 3 != 2][:10]
    assert np.allclose([s for s, _ in got], 1.0) and len(passes) <= 6


def test_g2_column_equals_the_formula(spark):
    rows = [(a, b) for a in (0, 1, 7, 30) for b in (0, 2, 50)]
    d = spark.createDataFrame(rows, "a long, b long")
    for r in d.withColumn("g", X._g2_column(F.col("a"), 30, F.col("b"), 50)).collect():
        assert abs(r["g"] - X.g2(r["a"], 30, r["b"], 50)) < 1e-9


def test_held_out_texts_and_planted_ones(spark):
    """1,000 labelled texts of random words; toxic ones hold a slur, some only an inflected
    form of it. No clean text may be called toxic."""
    rnd = random.Random(9)
    words = ["".join(rnd.choice("aeioubdklmnrst") for _ in range(rnd.randint(3, 9))) for _ in range(900)]
    slurs = ["grumbok", "vileth", "zorptang"]
    rows = []
    for i in range(1_000):
        w = [rnd.choice(words) for _ in range(rnd.randint(5, 120))]
        toxic = int(rnd.random() < 0.2)
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                w.insert(rnd.randrange(len(w)), rnd.choice(slurs) + rnd.choice(["", "", "um", "ikex"]))
        rows.append((i, " ".join(w), toxic))
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    model = X.fit(d.select("doc_id", "text"), d.select("doc_id", "toxic"), ~X.held_out())
    out = X.score(d.select("doc_id", "text", "toxic"), model, ["doc_id", "toxic"]).withColumn("held", X.held_out()).collect()
    held = [r for r in out if r["held"]]
    assert len(held) > 150
    assert sum((r["score"] >= X.THRESHOLD) == bool(r["toxic"]) for r in held) / len(held) >= 0.99
    assert not [r for r in held if r["score"] >= X.THRESHOLD and not r["toxic"]]
    said = [r for r in held if r["toxic"] and r["score"] >= X.THRESHOLD]
    assert all(r["score_near"] and sum(r["score_label"]) > len(r["score_label"]) / 2 and r["score_cosine"][0] > 0 for r in said)
    # the score is of the text alone
    again = X.score(d.select((F.col("doc_id") + 7).alias("doc_id"), "text"), model).collect()
    assert sorted(r["score"] for r in again) == sorted(r["score"] for r in out)


def test_query_and_odd_rows(spark, sf, odd, empty):
    out = X.op11_toxicity(spark, sf)
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert out.count() == 1_000 and all(0.0 <= r["score"] <= 1.0 for r in rows)
    clean = [r for r in rows if not r["toxic"]]
    assert len(clean) > 30 and not any(r["predicted"] for r in clean)
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, 0), (5, 0), (6, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    model = X.fit(odd, labels)
    assert model.index is not None and sum(model.index.toxic) == 2 and len(model.index.ids) == 4
    got = X.score(odd, model, odd.drop("text").columns, name="tox")
    assert got.count() == odd.count()
    assert got.filter("tox IS NULL OR tox < 0 OR tox > 1").count() == 0
    assert X.score(empty, model).count() == 0
    unfitted = X.fit(odd, labels.filter("toxic = 0"))
    assert {r["score"] for r in X.score(odd, unfitted, ["doc_id"]).collect()} == {0.0}
    assert X.fit(empty, labels).index is None

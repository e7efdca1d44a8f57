"""TF-IDF properties and the example-document notebook queries."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wordmill import session
from wordmill.functions import cells as C
from wordmill.functions import fixed
from wordmill.operators import terms
from wordmill.sources import datasets as DS


def test_l2_norm_is_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    _, w = terms.tfidf(docs)
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert norms and all(abs(r["n"] - 1.0) < 1e-9 for r in norms)


def test_inline_documents_fixed_vocabulary(spark):
    docs = DS.from_texts(spark, fixed.EXAMPLE_DOCUMENTS)
    model, w = terms.tfidf(docs, vocabulary=fixed.CUSTOM_VOCAB)
    assert terms.matrix_shape(model) == (6, 6)
    idf = {r["term"]: (r["df"], r["idf"]) for r in model.table.collect()}
    # "machine" occurs in the first three paragraphs; "network" (singular) in none
    assert idf["machine"][0] == 3
    assert idf["network"] == (0, math.log(7 / 1) + 1)
    first = {r["term"]: r["weight"] for r in w.filter("doc_id = 0").collect()}
    assert set(first) == {"machine", "learning", "artificial", "intelligence"}
    assert abs(sum(v * v for v in first.values()) - 1) < 1e-12


def test_ngram_top_features_and_dense(spark):
    docs = DS.from_texts(spark, fixed.EXAMPLE_DOCUMENTS)
    tok = terms.ngram_tokenizer(fixed.ENGLISH_STOPWORDS, (1, 2))
    model, w = terms.tfidf(docs, tokenizer=tok, max_features=10)
    assert model.n_terms == 10
    top = [r["term"] for r in model.table.orderBy(F.col("cf").desc(), "term").collect()]
    assert top[0] == "learning"
    assert "machine learning" in top
    wide = terms.dense_matrix(docs.select("doc_id"), w, model)
    assert wide.count() == 6 and len(wide.columns) == 11
    melted = terms.melted_matrix(docs.select("doc_id"), w, model)
    assert melted.count() == 60
    with pytest.raises(ValueError):
        terms.melted_matrix(docs.select("doc_id"), w, model, max_terms=9)


def test_bigrams_short_arrays(spark):
    df = spark.createDataFrame([(0, ""), (1, "solo"), (2, "aa bb cc")], "doc_id long, text string")
    tok = terms.ngram_tokenizer(None, (1, 2))
    got = {(r["doc_id"], r["term"]) for r in terms.tokens_table(df, tokenizer=tok).collect()}
    assert got == {(1, "solo"), (2, "aa"), (2, "bb"), (2, "cc"), (2, "aa bb"), (2, "bb cc")}


def test_pruned_sublinear(spark):
    docs = DS.from_texts(spark, fixed.EXAMPLE_DOCUMENTS)
    model, w = terms.tfidf(docs, min_df=2, max_df=0.8, sublinear_tf=True)
    dfs = [r["df"] for r in model.table.collect()]
    assert dfs and min(dfs) >= 2 and max(dfs) <= 4.8


def test_sorted_vocabulary_index(spark):
    docs = DS.from_texts(spark, fixed.EXAMPLE_DOCUMENTS)
    model = terms.fit_idf(docs)
    v = terms.sorted_vocabulary(model).orderBy("idx").collect()
    assert [r["idx"] for r in v] == list(range(len(v)))
    assert [r["term"] for r in v] == sorted(r["term"] for r in v)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if " Exchange " in x and "BroadcastExchange" not in x]


def test_no_text_and_no_counts_are_shuffled(spark):
    """Vectors, weights and top terms stay in the rows; fitting shuffles one count per term
    and task."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, vectors = terms.tfidf_vectors(docs)
    for df in (vectors, terms.top_terms(vectors, model, 20), terms.weighted_vectors(vectors, model)):
        assert all("RoundRobin" in x for x in exchanges(df))  # a small input is spread over the cores
    stats = vectors.select(F.explode("terms").alias("c")).groupBy("c.term").agg(F.count(F.lit(1)).alias("df"))
    assert sum("hashpartitioning(term" in x or "hashpartitioning(_groupingexpression" in x for x in exchanges(stats)) == 1
    _, w = terms.tfidf(docs)
    assert all("RoundRobin" in x for x in exchanges(w))


def test_the_joined_form_equals_the_one_inside_the_rows(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model, vectors = terms.tfidf_vectors(docs, min_df=2)

    def rows(df):
        return sorted((*r[:-1], round(r["weight"], 9)) for r in df.collect())
    inside = rows(terms.transform(docs, model, vectors=vectors)), rows(terms.top_terms(vectors, model, 3))
    monkeypatch.setattr(terms, "MAX_LOOKUP_BYTES", 0)
    assert terms.weighted_vectors(vectors, model) is None
    assert inside == (rows(terms.transform(docs, model, vectors=vectors)), rows(terms.top_terms(vectors, model, 3)))


def test_repeated_and_missing_ids_are_one_document(spark):
    rows = [(1, "aa bb aa"), (2, "cc"), (1, "bb dd"), (None, "aa"), (None, "zz zz"), (3, None), (4, ""), (5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["term"]): r["tf"] for r in terms.term_counts(docs).collect()}
    assert got == {(1, "aa"): 2, (1, "bb"): 2, (1, "dd"): 1, (2, "cc"): 1, (None, "aa"): 1, (None, "zz"): 2}
    model = terms.fit_idf(docs)
    assert {r["term"]: r["df"] for r in model.table.collect()} == {"aa": 2, "bb": 1, "cc": 1, "dd": 1, "zz": 1}
    norm = terms.transform(docs, model).groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert len(norm) == 3 and all(abs(r["n"] - 1) < 1e-9 for r in norm)
    none = docs.filter("false")
    assert terms.tfidf(none)[1].count() == 0 and terms.term_counts(none).count() == 0


def test_tfidf_release_drops_the_cached_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model, w = terms.tfidf(docs)
    n = w.count()
    assert model.tf_cache is not None and model.tf_cache.storageLevel.useMemory
    cached = model.tf_cache
    model.release()
    assert model.tf_cache is None and not cached.storageLevel.useMemory
    assert w.count() == n  # recomputed from the lineage


def test_only_vocabulary_tokens_are_shuffled(spark):
    """The top-feature path filters tokens by the vocabulary where the texts were read."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = terms.top_vocabulary(docs, 5)
    model, w = terms.tfidf(docs, vocabulary=words)
    assert {r["term"] for r in w.select("term").distinct().collect()} <= set(words)
    assert "InMemoryTableScan" in w._jdf.queryExecution().executedPlan().toString()  # the texts are read once
    assert {r["term"] for r in terms._long(model.tf_cache, "doc_id").select("term").distinct().collect()} <= set(words)


def test_bag_of_words_with_a_repeated_term(spark):
    d = spark.createDataFrame([(1, ["a", "b", "a"]), (2, [])], "doc_id long, tokens array<string>")
    got = {(r["doc_id"], r["pos"]): (r["term"], r["n"]) for r in terms.bag_of_words(d, ["a", "c", "a"]).collect()}
    assert got == {(1, 0): ("a", 2), (1, 1): ("c", 0), (1, 2): ("a", 2), (2, 0): ("a", 0), (2, 1): ("c", 0), (2, 2): ("a", 0)}


def test_heavy_words_are_exact(spark):
    rows = [(f"the the of w{i} w{i % 50} rare{i}",) for i in range(3000)] + [(None,), ("",)]
    d = spark.createDataFrame(rows, "text string").repartition(9)
    full = terms.word_frequencies(d)
    for t in (0.2, 0.003, 0.0005, 1e-7, 0.0):
        want = {tuple(r) for r in full.filter(F.col("n") / F.col("total") > t).collect()}
        assert {tuple(r) for r in terms.heavy_words(d, t).collect()} == want and want
    assert terms.heavy_words(d.filter("false"), 0.01).count() == 0


def test_heavy_words_shuffle_candidates_only(spark, monkeypatch):
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    cut = terms.cut_lineage
    monkeypatch.setattr(terms, "cut_lineage", kept)
    d = spark.createDataFrame([(f"the w{i}",) for i in range(500)], "text string")
    assert [r["word"] for r in terms.heavy_words(d, 0.1).collect()] == ["the"]
    # the sketch meets in one small row; the recount is grouped by candidate
    assert len(plans) == 2 and "hashpartitioning(word" not in plans[0] + plans[1]
    assert "hashpartitioning(_cand" in plans[1]


def test_top_words_are_exact(spark):
    rows = [(w,) for i in range(400) for w in ("a", "b", f"w{i % 40}", f"x{i % 7}", f"rare{i}")]
    d = spark.createDataFrame(rows, "word string").repartition(5)
    counts = sorted(((n, w) for w, n in Counter(w for w, in rows).items()), key=lambda c: (-c[0], c[1]))
    for k, tracked in ((0, 64), (1, 8), (2, 64), (9, 16), (12, 64), (49, 64), (60, 64), (1000, 64)):
        assert terms.top_words(d, k, tracked) == [(w, n) for n, w in counts[:k]], (k, tracked)
    assert terms.top_words(d.filter("false"), 3) == []


def test_top_words_shuffle_candidates_only(spark, monkeypatch):
    plans = []

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    cut = terms.cut_lineage
    monkeypatch.setattr(terms, "cut_lineage", kept)
    docs = spark.createDataFrame([(i, f"big data w{i} v{i}") for i in range(300)], "doc_id long, text string")
    tok = terms.ngram_tokenizer(None, (1, 2))
    assert terms.top_vocabulary(docs, 3, tokenizer=tok, sketch=True) == ["big", "big data", "data"]
    assert len(plans) == 2 and not any("hashpartitioning(word" in p or "hashpartitioning(term" in p for p in plans)


def test_terms_in_reach(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model, w = terms.tfidf(docs)
    for k in (1, 20, model.n_terms + 1):
        want = [(r["term"], round(r["total_weight"], 9)) for r in terms.top_terms_overall(w, k).collect()]
        assert [(r["term"], round(r["total_weight"], 9)) for r in terms.top_terms_bounded(w, model, k).collect()] == want
    few = terms.terms_in_reach(w, model, 5).count()
    assert 5 <= few < model.n_terms / 2, (few, model.n_terms)
    model.release()


def test_a_table_beyond_the_lookup_shuffles_its_rare_terms_only(spark, monkeypatch):
    rows = [(i if i else None, f"the the big data w{i % 9} rare{i} rare{i} odd{i // 2}") for i in range(60)] + [(100, None), (101, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model, vectors = terms.tfidf_vectors(docs)

    def found(df):
        return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["term"], round(r["weight"], 9)) for r in df.collect())
    for sublinear in (False, True):
        monkeypatch.setattr(terms, "MAX_LOOKUP_BYTES", 32 << 20)
        inside = found(terms.transform(docs, model, vectors=vectors, sublinear_tf=sublinear))
        monkeypatch.setattr(terms, "MAX_LOOKUP_BYTES", 500)
        assert 2 < terms._frequent_from(model.table, 500) <= 60
        w = terms.transform(docs, model, vectors=vectors, sublinear_tf=sublinear)
        assert found(w) == inside
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "MapInArrow" in plan
    model.release()


def test_texts_are_not_cut_a_second_time_for_an_inferred_filter(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, None), (3, "")], "doc_id long, text string")
    plan = terms.tokens_table(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert sorted(tuple(r) for r in terms.tokens_table(docs, positions=True).collect()) == [(1, 0, "aa"), (1, 1, "bb"), (1, 2, "aa")]


def test_vectors_of_a_large_input_are_not_kept_in_memory(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

    def weights():
        model, w = terms.tfidf(docs)
        plan = w._jdf.queryExecution().executedPlan().toString()
        rows = sorted((r["doc_id"], r["term"], r["weight"]) for r in w.collect())
        model.release()
        return plan, rows
    plan, rows = weights()
    assert "InMemoryTableScan" in plan
    monkeypatch.setattr(session, "plan_bytes", lambda d: 1 << 50)
    plan, large = weights()
    assert "InMemoryTableScan" not in plan and "regexp_extract_all" not in plan  # the texts are still cut once
    assert large == rows


def _batches(rows, schema, size):
    whole = pa.RecordBatch.from_pylist(rows, schema)
    return [whole.slice(i, size) for i in range(0, len(rows), size)]


def test_array_passes_take_a_bounded_part_of_the_vectors(monkeypatch):
    """However the pieces of documents are dealt over batches, passes and runs."""
    cell = pa.struct([("term", pa.string()), ("tf", pa.int64())])
    schema = pa.schema([("id", pa.int64()), ("pos", pa.int32()), ("cells", pa.list_(cell))])
    docs = [(None if i == 3 else i, [(f"t{(i * 7 + j) % 40:02d}", j % 4 + 1) for j in range(i * 5 % 23)]) for i in range(40)]
    rows = []
    for i, cells in docs:
        made = [{"id": i, "pos": p, "cells": [{"term": t, "tf": n} for t, n in cells[p * 4:p * 4 + 4]]} for p in range(-(-len(cells) // 4))]
        rows += made or [{"id": i, "pos": None, "cells": None}]
    known = pa.array([f"t{k:02d}" for k in range(0, 40, 2)])
    idf = np.linspace(1, 2, 20)

    def found(run, name, size):
        out = list(run(iter(_batches(rows, schema, size))))
        assert sum(b.num_rows for b in out) == len(docs)
        return [r for b in out for r in b.to_pylist()], max(len(b.column(name).flatten()) for b in out)
    whole = {}
    for most, run_pieces in ((1 << 30, 1 << 30), (200, 3), (1, 1)):
        monkeypatch.setattr(C, "PASS_BYTES", most)
        monkeypatch.setattr(C, "RUN_PIECES", run_pieces)
        for size in (1, 5, len(rows)):
            for make, name in ((C.weigh(known, idf, False), "weights"), (C.number(known), "others")):
                got, largest = found(make, name, size)
                assert got == whole.setdefault(name, got) and [r["id"] for r in got] == [i for i, _ in docs]
                if run_pieces < 1 << 30:
                    assert largest <= 22  # a document at most, or three pieces
    want = [(t, n * (1 + int(t[1:]) / 2 / 19)) for t, n in docs[4][1] if int(t[1:]) % 2 == 0]
    norm = math.sqrt(sum(w * w for _, w in want))
    assert [(c["term"], round(c["weight"], 9)) for c in whole["weights"][4]["weights"]] == [(t, round(w / norm, 9)) for t, w in want]
    # the two parts of a document's cells meet again, whole
    rare = pa.struct([("term", pa.string()), ("tf", pa.int64()), ("idf", pa.float64())])
    schema = pa.schema([("id", pa.int64()), ("pos", pa.int32()), ("at", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32())), ("rare", pa.list_(rare))])
    rows = []
    for r in whole["others"]:
        more = [{"term": c["term"], "tf": c["tf"], "idf": 3.0} for c in r["others"]]
        n = -(-max(len(r["at"]), len(more)) // 4)
        rows += [{"id": r["id"], "pos": p, **{k: v[p * 4:p * 4 + 4] for k, v in (("at", r["at"]), ("tf", r["tf"]), ("rare", more))}} for p in range(n)]
        rows += [] if n else [{"id": r["id"], "pos": None, "at": None, "tf": None, "rare": None}]
    for most, run_pieces in ((1 << 30, 1 << 30), (200, 3), (1, 1)):
        monkeypatch.setattr(C, "PASS_BYTES", most)
        monkeypatch.setattr(C, "RUN_PIECES", run_pieces)
        for size in (1, 5, len(rows)):
            got, _ = found(C.weigh_met(known, idf, True), "weights", size)
            assert got == whole.setdefault("met", got)
    weight = {t: (math.log(n) + 1) * (3.0 if int(t[1:]) % 2 else 1 + int(t[1:]) / 2 / 19) for t, n in docs[4][1]}
    norm = math.sqrt(sum(w * w for w in weight.values()))
    assert {c["term"]: round(c["weight"], 9) for c in whole["met"][4]["weights"]} == {t: round(w / norm, 9) for t, w in weight.items()}


def test_vectors_travel_in_bounded_pieces(spark):
    d = spark.createDataFrame([(1, [(f"t{i}", i) for i in range(70)]), (2, []), (None, None)], f"doc_id long, terms {terms._CELLS}")
    got = terms._pieces(d, "doc_id", cells=F.col("terms")).collect()
    assert [(r["doc_id"], r["pos"], len(r["cells"] or [])) for r in got] == [(1, 0, 32), (1, 1, 32), (1, 2, 6), (2, None, 0), (None, None, 0)]
    assert [c["tf"] for r in got for c in r["cells"] or []] == list(range(70))

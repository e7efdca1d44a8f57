"""Registered queries: one per operator ID, each ``(spark, sf_dir) -> DataFrame``.

Each query reads the given parquet tables and runs over whole tables and whole texts.
Computed columns carry the same names as in ``wordmill.plans.oracle``; doubles are
rounded to 6 places on output only (never before ranking).
"""

from __future__ import annotations

import io
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.operators import terms
from wordmill.session import size_shuffles, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return size_shuffles(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


# ---------------------------------------------------------------- V7 / K1 / A6 / K2

@query("v7_tfidf")
def v7_tfidf(spark, sf_dir):
    _, w = terms.tfidf(documents(spark, sf_dir))
    return w.select("doc_id", "term", r6("weight").alias("weight"))


@query("k1_top_terms_per_doc")
def k1_top_terms_per_doc(spark, sf_dir):
    model, vectors = terms.tfidf_vectors(documents(spark, sf_dir))
    return terms.top_terms(vectors, model, 20).select("doc_id", "rank", "term", r6("weight").alias("weight"))


# ---------------------------------------------------------------- text: T1-T12, T14-T16

from wordmill.functions import fixed  # noqa: E402
from wordmill.functions import text as T  # noqa: E402
from wordmill.operators import tokens as TK  # noqa: E402


def _positions(df: DataFrame, id_cols: list[str], arr: Column, name: str = "token") -> DataFrame:
    return df.select(*id_cols, F.posexplode(arr).alias("pos", name))


@query("t1_lower")
def t1_lower(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.lower("text").alias("text_lower"))


@query("t2_word_split")
def t2_word_split(spark, sf_dir):
    return _positions(documents(spark, sf_dir), ["doc_id"], T.word_split("text"))


@query("t3_whitespace_tokens")
def t3_whitespace_tokens(spark, sf_dir):
    return _positions(documents(spark, sf_dir), ["doc_id"], T.whitespace_tokens("text"))


@query("t4_abbr_or_lower")
def t4_abbr_or_lower(spark, sf_dir):
    toks = _positions(documents(spark, sf_dir), ["doc_id"], T.word_split("text"))
    return toks.select("doc_id", "pos", T.abbr_or_lower("token").alias("word"))


@query("t5_strip_non_word")
def t5_strip_non_word(spark, sf_dir):
    ws = F.filter(F.split(F.col("text"), T.WS_RUN), lambda t: t != "")
    toks = _positions(documents(spark, sf_dir), ["doc_id"], ws)
    return toks.select("doc_id", "pos", T.strip_non_word("token").alias("word"))


@query("t6_ascii_letter_tokens")
def t6_ascii_letter_tokens(spark, sf_dir):
    arr = T.keep_ascii_letter_tokens(T.word_split(T.lower("text")))
    return _positions(documents(spark, sf_dir), ["doc_id"], arr)


@query("t7_alpha_tokens")
def t7_alpha_tokens(spark, sf_dir):
    arr = T.keep_alpha_tokens(T.word_split(T.lower("text")))
    return _positions(documents(spark, sf_dir), ["doc_id"], arr)


@query("t8_remove_stopwords")
def t8_remove_stopwords(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", T.word_split(T.lower("text")).alias("w"))
    d = TK.remove_stopwords(d, "w", "kept")
    return _positions(d, ["doc_id"], F.col("kept"))


def _doc_word_tokens(spark, sf_dir) -> DataFrame:
    """(doc_id, pos, token): lowercased word tokens, every position."""
    d = spread(documents(spark, sf_dir).select("doc_id", "text"))
    return _positions(d, ["doc_id"], T.word_split(T.lower("text")))


@query("t9_lexicon_join")
def t9_lexicon_join(spark, sf_dir):
    toks = _doc_word_tokens(spark, sf_dir)
    lex = TK.plural_lexicon(toks)
    return TK.apply_lexicon(toks, lex).select("doc_id", "pos", "token")


@query("t10_preprocess")
def t10_preprocess(spark, sf_dir):
    return TK.preprocess(documents(spark, sf_dir), mode=0, join=True)


@query("t10_preprocess_stem")
def t10_preprocess_stem(spark, sf_dir):
    """The default mode; the plurals of the corpus stand in for a stem lexicon."""
    docs = documents(spark, sf_dir)
    return TK.preprocess(docs, lexicon=TK.plural_lexicon(_doc_word_tokens(spark, sf_dir)), join=True)


@query("t10_preprocess_lemma")
def t10_preprocess_lemma(spark, sf_dir):
    docs = documents(spark, sf_dir)
    lex = TK.plural_lexicon(_doc_word_tokens(spark, sf_dir))
    return TK.preprocess(docs, mode=2, lexicon=lex, join=True)


@query("t11_clean_generated")
def t11_clean_generated(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", T.clean_generated("text").alias("text_clean"))


@query("t12_parse_reply")
def t12_parse_reply(spark, sf_dir):
    """Every whitespace piece of every conversation turn parsed as a reply."""
    conv = table(spark, sf_dir, "conversations")
    pieces = F.filter(F.split(F.col("text"), T.WS_RUN), lambda t: t != "")
    p = _positions(conv, ["conv_id", "turn"], pieces, "reply")
    return p.select("conv_id", "turn", "pos", T.parse_int_reply("reply").alias("prediction"))


def _first_word(spark, sf_dir) -> DataFrame:
    """Every benchmark item with its first word as the class to write about."""
    return table(spark, sf_dir, "benchmark").select(
        "item_id", F.lower(F.regexp_extract("text", r"[\p{L}\p{N}_]+", 0)).alias("emotion"))


@query("t14_json_prompt")
def t14_json_prompt(spark, sf_dir):
    return _first_word(spark, sf_dir).select(
        "item_id", "emotion", T.json_generation_prompt("emotion").alias("prompt"))


@query("t15_plain_prompt")
def t15_plain_prompt(spark, sf_dir):
    return _first_word(spark, sf_dir).select(
        "item_id", "emotion", T.plain_generation_prompt("emotion").alias("prompt"))


@query("t16_encode_ids")
def t16_encode_ids(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", T.word_split(T.lower("text")).alias("tokens"))
    vocab = TK.sorted_vocab_ids(docs.select(F.explode("tokens").alias("token")))
    enc = TK.encode_ids(docs, vocab)
    return enc.select("doc_id", F.posexplode(F.arrays_zip("input_ids", "attention_mask")).alias("pos", "z")) \
        .select("doc_id", "pos", F.col("z.input_ids").alias("input_id"),
                F.col("z.attention_mask").alias("attention_mask"))


# ---------------------------------------------------------------- sampling: M1-M9

from wordmill.operators import sampling as M  # noqa: E402

SPLIT_SEED = f"{fixed.BASELINE_SEED}/split"


def embeddings(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


@query("m1_sample_fraction")
def m1_sample_fraction(spark, sf_dir):
    return M.sample_fraction(documents(spark, sf_dir).select("doc_id", "lang"), 0.45,
                             seed=fixed.BASELINE_SEED, id_cols="doc_id")


@query("m2_train_valid_split")
def m2_train_valid_split(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.col("lang").alias("label"))
    return M.split(d, fixed.BASELINE_VALID_SHARE, seed=SPLIT_SEED, id_cols="doc_id")


@query("m3_split_composite_id")
def m3_split_composite_id(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("label"))
    return M.split(c, fixed.PROMPT_VALID_SHARE, seed=7, id_cols=["conv_id", "turn"])


@query("m4_stratified_fraction")
def m4_stratified_fraction(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.col("lang").alias("label"))
    return M.stratified_fraction(d, fixed.STRATIFIED_TEST_SHARE, label_col="label",
                                 seed=fixed.BASELINE_SEED, id_cols="doc_id")


# shares of the classes in the approximate draw
APPROXIMATE_SHARES = {"de": 0.5, "en": 0.1, "es": 0.6, "fr": 0.4}


@query("m4_approximate_fraction")
def m4_approximate_fraction(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.col("lang").alias("label"))
    return M.stratified_approximate(d, APPROXIMATE_SHARES, label_col="label", seed=fixed.BASELINE_SEED, id_cols="doc_id")


@query("m5_per_class")
def m5_per_class(spark, sf_dir):
    e = embeddings(spark, sf_dir).select("vec_id", "label")
    return M.per_class(e, 32, label_col="label", seed=fixed.BASELINE_SEED, id_cols="vec_id")


@query("m6_first_n")
def m6_first_n(spark, sf_dir):
    e = embeddings(spark, sf_dir).select("vec_id", "label")
    return M.first_n(e, 50, seed=fixed.BASELINE_SEED, id_cols="vec_id")


@query("m7_nested_ladder")
def m7_nested_ladder(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id")
    return M.nested_samples(d, M.fraction_ladder(), seed=fixed.BASELINE_SEED, id_cols="doc_id")


@query("m8_seeded_split")
def m8_seeded_split(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.col("lang").alias("label"))
    return M.split(d, fixed.GENERATED_TEST_SHARE, seed=fixed.GENERATED_SPLIT_SEED, id_cols="doc_id",
                   part_col="split", names=("train", "test"))


@query("m9_realised_rate")
def m9_realised_rate(spark, sf_dir):
    e = embeddings(spark, sf_dir).select("vec_id", "label")
    few = M.per_class(e, 32, label_col="label", seed=fixed.BASELINE_SEED, id_cols="vec_id")
    rate = M.realised_rate(few, e, nominal_rows=32)
    return rate.select(r6("percentage").alias("percentage"), r6("labelled_share").alias("labelled_share"))


# ---------------------------------------------------------------- terms: V1-V15, A6, K2

def _t10_tokens(spark, sf_dir) -> DataFrame:
    return TK.preprocess(documents(spark, sf_dir), mode=0, join=False)


def _top_words(tok: DataFrame, k: int) -> list[str]:
    """The k most frequent tokens (count desc, token asc): a bounded top-k report."""
    rows = (T.exploded(tok, F.col("tokens"), name="t").groupBy("t").count()
            .orderBy(F.col("count").desc(), F.col("t").asc()).limit(k).collect())
    return [r["t"] for r in rows]


def v1_vocabulary(tok: DataFrame) -> list[str]:
    return fixed.CUSTOM_VOCAB + _top_words(tok, 10)


@query("v1_bag_of_words")
def v1_bag_of_words(spark, sf_dir):
    tok = _t10_tokens(spark, sf_dir)
    vocab = v1_vocabulary(tok)
    return terms.bag_of_words(tok, vocab)


@query("v2_word_frequency")
def v2_word_frequency(spark, sf_dir):
    return terms.word_frequencies(documents(spark, sf_dir))


@query("v3_frequent_stopwords")
def v3_frequent_stopwords(spark, sf_dir):
    return terms.frequent_stopwords(documents(spark, sf_dir))


@query("v3_sketched_stopwords")
def v3_sketched_stopwords(spark, sf_dir):
    return terms.frequent_stopwords(documents(spark, sf_dir), sketch=True)


@query("v3_heavy_words")
def v3_heavy_words(spark, sf_dir):
    return terms.heavy_words(documents(spark, sf_dir), fixed.FREQUENCY_THRESHOLD)


@query("v4_extend_stopwords")
def v4_extend_stopwords(spark, sf_dir):
    base = terms.frequent_stopwords(documents(spark, sf_dir))
    extra = (table(spark, sf_dir, "benchmark")
             .select(F.explode(T.whitespace_tokens("text")).alias("word")))
    return terms.extend_stopwords(base, extra)


@query("v6_class_top_words")
def v6_class_top_words(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", F.col("lang").alias("label"))
    stop = terms.frequent_stopwords(docs)
    top = terms.class_top_words(docs, stop, k=100)
    return top.select("label", "word", "n", "rank", r6("weight").alias("weight"))


@query("v8_transform_unseen")
def v8_transform_unseen(spark, sf_dir):
    d = M.split(documents(spark, sf_dir).select("doc_id", "text"), fixed.GENERATED_TEST_SHARE,
                seed=fixed.GENERATED_SPLIT_SEED, id_cols="doc_id", part_col="split",
                names=("train", "test"))
    model = terms.fit_idf(d.filter(F.col("split") == "train"))
    w = terms.transform(d.filter(F.col("split") == "test"), model)
    return w.select("doc_id", "term", r6("weight").alias("weight"))


def _v9(spark, sf_dir):
    tok = terms.ngram_tokenizer(fixed.ENGLISH_STOPWORDS, (1, 2))
    docs = documents(spark, sf_dir)
    model, w = terms.tfidf(docs, tokenizer=tok, max_features=10)
    return docs, model, w


@query("v9_ngram_top_features")
def v9_ngram_top_features(spark, sf_dir):
    _, _, w = _v9(spark, sf_dir)
    return w.select("doc_id", "term", r6("weight").alias("weight"))


@query("v9_sketched_features")
def v9_sketched_features(spark, sf_dir):
    tok = terms.ngram_tokenizer(fixed.ENGLISH_STOPWORDS, (1, 2))
    docs = documents(spark, sf_dir)
    _, w = terms.tfidf(docs, tokenizer=tok, vocabulary=terms.top_vocabulary(docs, 10, tokenizer=tok, sketch=True))
    return w.select("doc_id", "term", r6("weight").alias("weight"))


def _v10(spark, sf_dir):
    docs = documents(spark, sf_dir)
    vocab = v1_vocabulary(_t10_tokens(spark, sf_dir))
    model, w = terms.tfidf(docs, vocabulary=vocab)
    return model, w


@query("v10_fixed_vocab_idf")
def v10_fixed_vocab_idf(spark, sf_dir):
    model, _ = _v10(spark, sf_dir)
    return model.table.select("idx", "term", "df", r6("idf").alias("idf"))


@query("v10_fixed_vocab_weights")
def v10_fixed_vocab_weights(spark, sf_dir):
    _, w = _v10(spark, sf_dir)
    return w.select("doc_id", "term", r6("weight").alias("weight"))


@query("v11_pruned_sublinear")
def v11_pruned_sublinear(spark, sf_dir):
    _, w = terms.tfidf(documents(spark, sf_dir), min_df=2, max_df=0.8, sublinear_tf=True)
    return w.select("doc_id", "term", r6("weight").alias("weight"))


@query("v8_merged_idf")
def v8_merged_idf(spark, sf_dir):
    """Two states, fitted on the two halves of the corpus and added up."""
    d = documents(spark, sf_dir).select("doc_id", "text", (F.col("doc_id") % 2 == 0).alias("even"))
    state = terms.merge_idf_states(terms.idf_state(d.filter("even")), terms.idf_state(d.filter("NOT even")))
    return terms.idf_of_state(state).table.select("term", "df", r6("idf").alias("idf"))


@query("v12_matrix_shape")
def v12_matrix_shape(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = terms.fit_idf(docs)
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    return model.table.select(n_docs.alias("n_docs"), F.count(F.lit(1)).alias("n_terms"))


@query("v13_sorted_vocabulary")
def v13_sorted_vocabulary(spark, sf_dir):
    return terms.sorted_vocabulary(terms.fit_idf(documents(spark, sf_dir)))


@query("v14_dense_matrix")
def v14_dense_matrix(spark, sf_dir):
    docs, model, w = _v9(spark, sf_dir)
    wide = terms.dense_matrix(docs.select("doc_id"), w.withColumn("weight", r6("weight")), model)
    return wide


@query("v15_melted_matrix")
def v15_melted_matrix(spark, sf_dir):
    docs, model, w = _v9(spark, sf_dir)
    m = terms.melted_matrix(docs.select("doc_id"), w, model)
    return m.select("doc_id", "term", r6("weight").alias("weight"))


@query("a6_term_totals")
def a6_term_totals(spark, sf_dir):
    _, w = terms.tfidf(documents(spark, sf_dir))
    return terms.term_totals(w).select("term", r6("total_weight").alias("total_weight"))


@query("k2_top_terms_overall")
def k2_top_terms_overall(spark, sf_dir):
    _, w = terms.tfidf(documents(spark, sf_dir))
    return terms.top_terms_overall(w, 20).select("term", r6("total_weight").alias("total_weight"))


@query("k2_terms_in_reach")
def k2_terms_in_reach(spark, sf_dir):
    model, w = terms.tfidf(documents(spark, sf_dir))
    return terms.top_terms_bounded(w, model, 20).select("term", r6("total_weight").alias("total_weight"))


# ---------------------------------------------------------------- metrics: A1-A5, A7, A8, R1-R5, K3, F1-F7

from wordmill.operators import metrics as MT  # noqa: E402

CURVE_METHODS = ["baseline", "bert"]
POINT_METHODS = ["setfit", "zeroshot"]


def _standin(spark, sf_dir, seed="standin") -> DataFrame:
    e = embeddings(spark, sf_dir).select("vec_id", "label")
    return e.withColumn("prediction", MT.standin_prediction(seed, "vec_id"))


def _curve_predictions(spark, sf_dir) -> DataFrame:
    """Stand-in learning-curve runs: every ladder share of the embeddings, two methods,
    plus two single-point methods scored at the realised few-shot share."""
    e = embeddings(spark, sf_dir).select("vec_id", "label")
    rows = M.nested_samples(e, M.fraction_ladder(), seed=fixed.BASELINE_SEED, id_cols="vec_id")
    rows = rows.withColumn("method", F.explode(F.array(*[F.lit(m) for m in CURVE_METHODS])))
    pred = F.when(F.col("method") == CURVE_METHODS[0], MT.standin_prediction(CURVE_METHODS[0], "vec_id"))
    for m in CURVE_METHODS[1:]:
        pred = pred.when(F.col("method") == m, MT.standin_prediction(m, "vec_id"))
    curve = rows.withColumn("prediction", pred)
    share = F.lit(32.0) / e.select(F.count(F.lit(1))).scalar()
    pts = e.withColumn("method", F.explode(F.array(*[F.lit(m) for m in POINT_METHODS])))
    ppred = F.when(F.col("method") == POINT_METHODS[0], MT.standin_prediction(POINT_METHODS[0], "vec_id"))
    for m in POINT_METHODS[1:]:
        ppred = ppred.when(F.col("method") == m, MT.standin_prediction(m, "vec_id"))
    points = pts.withColumn("percentage", share).withColumn("prediction", ppred)
    cols = ["vec_id", "label", "method", "percentage", "prediction"]
    return curve.select(*cols).unionByName(points.select(*cols))


def _results_wide(spark, sf_dir) -> DataFrame:
    return MT.weighted(_curve_predictions(spark, sf_dir), by=["method", "percentage"])


def _results_long(spark, sf_dir) -> DataFrame:
    return MT.to_long(_results_wide(spark, sf_dir), ["method", "percentage"])


def _r6_long(df: DataFrame) -> DataFrame:
    return df.select("method", r6("percentage").alias("percentage"), "metric", r6("value").alias("value"))


@query("a1_label_distribution")
def a1_label_distribution(spark, sf_dir):
    return MT.label_distribution(documents(spark, sf_dir), "lang")


@query("a2_distinct_labels")
def a2_distinct_labels(spark, sf_dir):
    s = m8_seeded_split(spark, sf_dir)
    return MT.distinct_labels(s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test"))


@query("a3_confusion")
def a3_confusion(spark, sf_dir):
    return MT.confusion(_standin(spark, sf_dir))


def _metric_cols(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *[r6(m).alias(m) for m in MT.METRICS], "n_invalid")


@query("a4_weighted_metrics")
def a4_weighted_metrics(spark, sf_dir):
    return _metric_cols(MT.weighted(_standin(spark, sf_dir)), [])


@query("a5_metrics_by_method")
def a5_metrics_by_method(spark, sf_dir):
    w = _results_wide(spark, sf_dir)
    return _metric_cols(w.withColumn("percentage", r6("percentage")), ["method", "percentage"])


@query("r1_to_long")
def r1_to_long(spark, sf_dir):
    return _r6_long(_results_long(spark, sf_dir))


@query("r2_percent_scale")
def r2_percent_scale(spark, sf_dir):
    return _r6_long(MT.percent_scale(_results_long(spark, sf_dir)))


@query("r3_stack_methods")
def r3_stack_methods(spark, sf_dir):
    long = _results_long(spark, sf_dir)
    parts = {m: long.filter(F.col("method") == m).drop("method") for m in CURVE_METHODS + POINT_METHODS}
    return _r6_long(MT.stack(parts))


@query("r4_extend_single_points")
def r4_extend_single_points(spark, sf_dir):
    scaled = MT.percent_scale(_results_long(spark, sf_dir))
    return _r6_long(MT.extend_single_points(scaled))


@query("r5_union_stopwords")
def r5_union_stopwords(spark, sf_dir):
    docs = documents(spark, sf_dir)
    conv = table(spark, sf_dir, "conversations")
    return terms.extend_stopwords(terms.frequent_stopwords(docs), terms.frequent_stopwords(conv))


@query("a7_max_percentage")
def a7_max_percentage(spark, sf_dir):
    m = MT.max_percentage(_results_long(spark, sf_dir))
    return m.select("method", r6("max_percentage").alias("max_percentage"))


@query("a8_metric_names")
def a8_metric_names(spark, sf_dir):
    return MT.metric_names(_results_long(spark, sf_dir))


@query("f6_filter_metric")
def f6_filter_metric(spark, sf_dir):
    return _r6_long(MT.filter_metric(_results_long(spark, sf_dir), "f1"))


@query("k3_sort_results")
def k3_sort_results(spark, sf_dir):
    return _r6_long(MT.sort_results(MT.percent_scale(_results_long(spark, sf_dir))))


@query("f7_invalid_predictions")
def f7_invalid_predictions(spark, sf_dir):
    return MT.invalid_counts(_standin(spark, sf_dir))


@query("f1_rows_of_class")
def f1_rows_of_class(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.col("lang").alias("label"))
    return MT.rows_of_class(d, "de")


@query("f2_declared_classes")
def f2_declared_classes(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", F.col("lang").alias("label"))
    return MT.declared_classes(d, ["en", "de", "es"])


@query("f3_project_text_label")
def f3_project_text_label(spark, sf_dir):
    return MT.project_text_label(documents(spark, sf_dir), label_col="lang", id_col="doc_id")


def _label_codes(spark, sf_dir) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    return lab.select("doc_id", (F.col("quality") * 2 + F.col("toxic")).alias("code"))


@query("f4_code_to_name")
def f4_code_to_name(spark, sf_dir):
    return _label_codes(spark, sf_dir).withColumn("name", MT.code_to_name("code"))


@query("f5_name_to_code")
def f5_name_to_code(spark, sf_dir):
    named = _label_codes(spark, sf_dir).select("doc_id", F.lower(MT.code_to_name("code")).alias("name"))
    return named.withColumn("code", MT.name_to_code("name"))


# ---------------------------------------------------------------- sources: S1, S2, S4-S8

from wordmill.session import scratch_path  # noqa: E402
from wordmill.sources import datasets as DS  # noqa: E402
from wordmill.sources import store as ST  # noqa: E402


@query("s1_read_split")
def s1_read_split(spark, sf_dir):
    data = DS.labelled(m8_split_docs(spark, sf_dir), id_cols="doc_id", label_col="lang", split_col="split")
    path = scratch_path(spark, "labelled")
    ST.write_table(data, path, fmt="parquet", partition_by=["split"])
    return DS.read_split(path, "test", spark=spark).select("doc_id", "label", "split")


def m8_split_docs(spark, sf_dir) -> DataFrame:
    return M.split(documents(spark, sf_dir).select("doc_id", "text", "lang"), fixed.GENERATED_TEST_SHARE,
                   seed=fixed.GENERATED_SPLIT_SEED, id_cols="doc_id", part_col="split",
                   names=("train", "test"))


@query("s2_injected_dataset")
def s2_injected_dataset(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    data = DS.labelled(conv, id_cols=["conv_id", "turn"], label_col="role")
    data = M.split(data, fixed.PROMPT_VALID_SHARE, seed=7, id_cols=["conv_id", "turn"],
                   part_col="split", names=("train", "test"))
    return DS.read_split(data, "train").select("conv_id", "turn", "label", "split")


@query("s4_s5_csv_roundtrip")
def s4_s5_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "results-csv")
    ST.write_table(_r6_long(_results_long(spark, sf_dir)), path, fmt="csv")
    return ST.read_table(spark, path, ST.RESULT_SCHEMA)


@query("s6_materialize")
def s6_materialize(spark, sf_dir):
    root, docs = scratch_path(spark, "label-dist"), f"{sf_dir}/documents.parquet"
    first = ST.materialize_for(spark, lambda: a1_label_distribution(spark, sf_dir), root, "labels", inputs=[docs], label="lang")
    # a second call with the same input and parameters reads the stored table
    return ST.materialize_for(spark, lambda: first.limit(0), root, "labels", inputs=[docs], label="lang")


@query("s7_keyed_output")
def s7_keyed_output(spark, sf_dir):
    """Two parameter values have outputs of their own under one root."""
    root, rows = scratch_path(spark, "keyed"), [f"{sf_dir}/embeddings.parquet"]
    for metrics, temperature in ((["f1", "accuracy"], 0.9), (MT.METRICS, 0.2)):
        back = ST.materialize_for(spark, lambda keep=metrics: _r6_long(_results_long(spark, sf_dir)).filter(F.col("metric").isin(keep)),
                                  root, "zeroshot", inputs=rows, num_samples=32, temperature=temperature)
    return back.filter(F.col("method") == "bert").select("method", "percentage", "metric", "value")


@query("s8_preview")
def s8_preview(spark, sf_dir):
    train = m8_split_docs(spark, sf_dir).filter(F.col("split") == "train")
    return DS.preview(train.select("doc_id", F.col("lang").alias("label")), 5)


# ---------------------------------------------------------------- learning and jobs: L1-L12, T13

import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402

from wordmill.operators import jobs as JB  # noqa: E402
from wordmill.operators import learn as LN  # noqa: E402
from wordmill.operators.bayes import NaiveBayesTable  # noqa: E402

# Language codes used as an int label for prompt classification (alphabetical).
LANG_CODES = {"de": 0, "en": 1, "es": 2, "fr": 3}


def _labelled_docs(spark, sf_dir, label: str = "lang") -> DataFrame:
    """Documents as a labelled dataset; a label from ``labels`` keeps the documents that
    have one."""
    docs = spread(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    if label == "lang":
        return docs.select("doc_id", "text", F.col("lang").alias("label"))
    lab = table(spark, sf_dir, "labels")
    return docs.join(lab, "doc_id").select("doc_id", "text", F.col(label).cast("string").alias("label"))


def _train_valid(spark, sf_dir) -> DataFrame:
    return M.split(_labelled_docs(spark, sf_dir), fixed.BASELINE_VALID_SHARE, seed=SPLIT_SEED, id_cols="doc_id")


@query("l1_fit_predict")
def l1_fit_predict(spark, sf_dir):
    d = _train_valid(spark, sf_dir)
    model = LN.text_classifier().fit(d.filter(F.col("part") == "train"))
    return LN.predict(model, d.filter(F.col("part") == "valid")).select("doc_id", "label", "predicted")


@query("l1_features")
def l1_features(spark, sf_dir):
    """The TF-IDF rows of ``l1_fit_predict`` before their terms are hashed to features."""
    train = _train_valid(spark, sf_dir).filter(F.col("part") == "train")
    _, w = terms.tfidf(train.select("doc_id", "text"))
    return w.select("doc_id", "term", r6("weight").alias("weight"))


def _parts_long(df: DataFrame, ids: list[str], weights: bool = False) -> DataFrame:
    """Every row's part at every share of the ladder."""
    fr = M.ladder()
    at = F.explode(F.array(*[F.struct(F.lit(float(f)).alias("percentage"), F.col("_wm_parts")[i].alias("part"),
                                      LN.steps_so_far("_wm_parts", i).alias("weight")) for i, f in enumerate(fr)]))
    out = df.select(*ids, at.alias("p")).select(*ids, "p.*").filter("part IS NOT NULL")
    return out if weights else out.drop("weight")


@query("l2_curve_parts")
def l2_curve_parts(spark, sf_dir):
    """The training and validation rows of ``l2_learning_curve``."""
    return _parts_long(LN.curve_parts(_labelled_docs(spark, sf_dir, "quality").select("doc_id")), ["doc_id"])


@query("l2_learning_curve")
def l2_learning_curve(spark, sf_dir):
    return LN.learning_curve(_labelled_docs(spark, sf_dir, "quality"))


def _conversations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.col("role").alias("label"))


@query("l3_curve_parts")
def l3_curve_parts(spark, sf_dir):
    ids = ["conv_id", "turn"]
    return _parts_long(LN.curve_parts(_conversations(spark, sf_dir).select(*ids), id_cols=ids), ids)


@query("l3_curve_conversations")
def l3_curve_conversations(spark, sf_dir):
    return LN.learning_curve(_conversations(spark, sf_dir), id_cols=["conv_id", "turn"])


def _naive_bayes(**kw):
    return NaiveBayesTable(**kw)


@query("l2_curve_naive_bayes")
def l2_curve_naive_bayes(spark, sf_dir):
    """The learning curve with an injected estimator whose model is a table."""
    curve = LN.learning_curve(_labelled_docs(spark, sf_dir, "quality"), estimator_fn=_naive_bayes)
    return curve.select(r6("percentage").alias("percentage"), "metric", r6("value").alias("value"))


@query("l3_curve_naive_bayes")
def l3_curve_naive_bayes(spark, sf_dir):
    curve = LN.learning_curve(_conversations(spark, sf_dir), id_cols=["conv_id", "turn"], estimator_fn=_naive_bayes)
    return curve.select(r6("percentage").alias("percentage"), "metric", r6("value").alias("value"))


@query("l9_cumulative_naive_bayes")
def l9_cumulative_naive_bayes(spark, sf_dir):
    """Trained step after step: a row weighs as often as the shares so far held it."""
    curve = LN.learning_curve(_labelled_docs(spark, sf_dir), estimator_fn=_naive_bayes, cumulative=True)
    return curve.select(r6("percentage").alias("percentage"), "metric", r6("value").alias("value"))


@query("l4_naive_bayes_predictions")
def l4_naive_bayes_predictions(spark, sf_dir):
    """Fitted on the documents of one half of the sources, predictions for the other."""
    d = _two_sides(spark, sf_dir)
    model = _naive_bayes().fit(d.filter("fitted"))
    return model.transform(d.filter("NOT fitted")).select("doc_id", "label", "predicted")


def _two_sides(spark, sf_dir) -> DataFrame:
    """Documents of one half of the sources, and of the other half."""
    d = spread(documents(spark, sf_dir).select("doc_id", "text", F.col("lang").alias("label"), "source"))
    return d.withColumn("fitted", F.substring(F.md5(F.col("source")), 1, 1) < "8").drop("source")


@query("l4_sides")
def l4_sides(spark, sf_dir):
    return _two_sides(spark, sf_dir).groupBy("fitted", "label").agg(F.count(F.lit(1)).alias("n"))


@query("l4_cross_dataset")
def l4_cross_dataset(spark, sf_dir):
    """Fit on the documents of one half of the sources, evaluate on the other half."""
    d = _two_sides(spark, sf_dir)
    model = LN.text_classifier().fit(d.filter("fitted"))
    return LN.cross_evaluate(model, d.filter("NOT fitted"))


@query("l5_few_shot_parts")
def l5_few_shot_parts(spark, sf_dir):
    train, valid = LN.few_shot_parts(embeddings(spark, sf_dir).select("vec_id", "label"), 32)
    return (train.select("vec_id", "label", F.lit("train").alias("part"))
            .unionByName(valid.select("vec_id", "label", F.lit("valid").alias("part"))))


@query("l5_few_shot_head")
def l5_few_shot_head(spark, sf_dir):
    wide, _ = LN.few_shot_head(embeddings(spark, sf_dir), 32)
    return wide


def _train_test(spark, sf_dir) -> DataFrame:
    return M.split(_labelled_docs(spark, sf_dir), fixed.GENERATED_TEST_SHARE, seed=fixed.GENERATED_SPLIT_SEED,
                   id_cols="doc_id", part_col="split", names=("train", "test"))


@query("l8_stratified_parts")
def l8_stratified_parts(spark, sf_dir):
    train = _train_test(spark, sf_dir).filter(F.col("split") == "train").select("doc_id", "label")
    fr = M.ladder()
    samples = M.stratified_ladder(train, fr, label_col="label", seed=fixed.BASELINE_SEED, id_cols="doc_id")
    out = None
    for f, d in zip(fr, samples):
        d = d.select("doc_id", "label", F.lit(float(f)).alias("percentage"))
        out = d if out is None else out.unionByName(d)
    return out


@query("l8_stratified_curve")
def l8_stratified_curve(spark, sf_dir):
    d = _train_test(spark, sf_dir)
    test = M.stratified_fraction(d.filter(F.col("split") == "test"), fixed.STRATIFIED_TEST_SHARE,
                                 label_col="label", seed=fixed.BASELINE_SEED, id_cols="doc_id")
    return LN.learning_curve(d.filter(F.col("split") == "train"), sampling="stratified", holdout=test)


@query("l9_cumulative_weights")
def l9_cumulative_weights(spark, sf_dir):
    """The rows of ``l9_cumulative_curve`` and their weights at every share."""
    return _parts_long(LN.curve_parts(documents(spark, sf_dir).select("doc_id")), ["doc_id"], weights=True)


@query("l9_cumulative_curve")
def l9_cumulative_curve(spark, sf_dir):
    return LN.learning_curve(_labelled_docs(spark, sf_dir), cumulative=True)


@query("l12_top_coefficients")
def l12_top_coefficients(spark, sf_dir):
    docs = _labelled_docs(spark, sf_dir)
    return LN.top_coefficients(LN.text_classifier().fit(docs), docs, 10)


@query("l12_disagreement")
def l12_disagreement(spark, sf_dir):
    e = embeddings(spark, sf_dir).select("vec_id", "label")
    a = e.withColumn("prediction", MT.standin_prediction("baseline", "vec_id"))
    b = e.withColumn("prediction", MT.standin_prediction("bert", "vec_id"))
    return LN.disagreement(a, b, id_cols="vec_id")


@query("l6_contrastive_pairs")
def l6_contrastive_pairs(spark, sf_dir):
    e = embeddings(spark, sf_dir).select("vec_id", "label")
    few = M.per_class(e, 32, label_col="label", seed=fixed.BASELINE_SEED, id_cols="vec_id")
    return JB.contrastive_pairs(few, fixed.CONTRASTIVE_ITERATIONS)


@query("l6_pair_properties")
def l6_pair_properties(spark, sf_dir):
    """Per anchor: its distinct positives and negatives, and the other classes they reach."""
    e = embeddings(spark, sf_dir).select("vec_id", "label")
    few = M.per_class(e, 32, label_col="label", seed=fixed.BASELINE_SEED, id_cols="vec_id")
    pairs = JB.contrastive_pairs(few, fixed.CONTRASTIVE_ITERATIONS)
    partner = e.select(F.col("vec_id").alias("b_id"), "label")
    return pairs.join(partner, "b_id").groupBy("a_id").agg(
        F.count_distinct(F.when(F.col("similar"), F.col("b_id"))).alias("positives"),
        F.count_distinct(F.when(~F.col("similar"), F.col("b_id"))).alias("negatives"),
        F.count_distinct(F.when(~F.col("similar"), F.col("label"))).alias("classes"))


@query("l5_pair_scatter")
def l5_pair_scatter(spark, sf_dir):
    e = embeddings(spark, sf_dir)
    few = M.per_class(e, 32, label_col="label", seed=fixed.BASELINE_SEED, id_cols="vec_id")
    pairs = JB.contrastive_pairs(few.select("vec_id", "label"), fixed.CONTRASTIVE_ITERATIONS)
    return JB.pair_scatter(pairs, e).withColumn("value", r6("value"))


@query("l5_pair_head")
def l5_pair_head(spark, sf_dir):
    """The few-shot head on what its contrastive pairs teach: nine dimensions for ten classes."""
    wide, _ = LN.few_shot_head(embeddings(spark, sf_dir), 32, pair_dims=9)
    return wide


def stride_scorer(pdf: pd.DataFrame) -> pd.Series:
    """Stand-in model over whole vectors: the score of class c is the sum of the
    components whose place leaves c when divided by ten."""
    return pd.Series([[float(sum(x.tolist())) for x in (np.asarray(v, dtype=np.float64)[c::10] for c in range(10))]
                      for v in pdf["embedding"]])


@query("l7_score_batches")
def l7_score_batches(spark, sf_dir):
    e = embeddings(spark, sf_dir).select("vec_id", "label", "embedding")
    return JB.score_batches(e, stride_scorer, keep=["vec_id", "label"]).select("vec_id", "label", "prediction")


def load_centroids(path: str):
    """The scorer of a stored matrix with one row per class: inner products."""
    centroids = np.load(path)
    return lambda vectors: vectors @ centroids.T


@query("l7_score_model")
def l7_score_model(spark, sf_dir):
    """The mean vector of every class as a model in a file, loaded once per worker."""
    e = embeddings(spark, sf_dir).select("vec_id", "label", "embedding")
    means = (e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i")
             .agg(F.avg(F.col("x").cast("double")).alias("m")).groupBy("label")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("mean"))
             .orderBy("label").collect())
    if not means:
        return e.select("vec_id", "label", F.lit(None).cast("int").alias("prediction"))
    matrix, data = np.array([r["mean"] for r in means]), io.BytesIO()
    np.save(data, matrix)
    artefact = JB.publish_artefact(spark, data.getvalue(), "centroids.npy")
    scored = JB.score_with_model(e, artefact, load_centroids, keep=["vec_id", "label"], vec_col="embedding",
                                 width=matrix.shape[1])
    return scored.select("vec_id", "label", "prediction")


def length_responder(pdf: pd.DataFrame) -> pd.Series:
    """Deterministic stand-in for a remote model: replies from the prompt length."""
    n = pdf["prompt"].str.len()
    return pd.Series(np.where(n % 9 == 0, "joy", " " + (n % 7).astype(str) + " "), index=pdf.index)


def echo_responder(pdf: pd.DataFrame) -> pd.Series:
    """Deterministic stand-in generator: echoes the context text and the class."""
    return " " + pdf["text"] + "\r\n" + pdf["emotion"] + " "


def _prompt_items(spark, sf_dir):
    codes = MT._map_lit(LANG_CODES)
    d = documents(spark, sf_dir).select("doc_id", "text", F.element_at(codes, F.col("lang")).alias("label"))
    s = M.split(d, fixed.PROMPT_VALID_SHARE, seed=7, id_cols="doc_id")
    few = M.first_n(s.filter(F.col("part") == "train"), 32, seed=fixed.BASELINE_SEED, id_cols="doc_id")
    return s.filter(F.col("part") == "valid"), few


@query("t13_classification_prompt")
def t13_classification_prompt(spark, sf_dir):
    items, few = _prompt_items(spark, sf_dir)
    block = JB.few_shot_block(few)
    return items.select("doc_id", T.classification_prompt("text", block).alias("prompt"))


@query("l10_prompt_classify")
def l10_prompt_classify(spark, sf_dir):
    items, few = _prompt_items(spark, sf_dir)
    return JB.prompt_classify(items, few, length_responder, call_rows=1_000)


@query("l10_prompt_metrics")
def l10_prompt_metrics(spark, sf_dir):
    items, few = _prompt_items(spark, sf_dir)
    m = JB.prompt_metrics(JB.prompt_classify(items, few, length_responder, call_rows=1_000))
    return _metric_cols(m, [])


@query("l11_generate")
def l11_generate(spark, sf_dir):
    return JB.generate(table(spark, sf_dir, "benchmark"), echo_responder, n_per_class=2, names=True, call_rows=1_000)

"""Vocabulary, term statistics and TF-IDF.

Representation: a document is one row with its term vector, an array of ``(term, tf)``
counted within the row (``text.counted_terms``), so no text and no (document, term) row is
shuffled. Document frequency is a partial (map-side) aggregate over the vectors: a term
present in every document is collapsed before its one shuffle. Documents that share an id
are one document; which ids repeat is found from the ids alone, and only their vectors are
merged.

The idf table is fitted eagerly (like any estimator ``fit``), written to the shared
checkpoint folder, and measured. Below ``MAX_LOOKUP_BYTES`` it travels to the tasks, and
weights, norms and the top terms of a document are computed where its row lies. Beyond, its
most frequent terms do, only the cells of the others are joined with it by a shuffle, and the
vectors are shuffled once, as arrays of numbers, to meet them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.functions import cells as C
from wordmill.functions import fixed
from wordmill.functions import text as T
from wordmill.functions.text import let
from wordmill.operators.tokens import number_sorted
from wordmill.session import MAX_BROADCAST_BYTES, broadcast_if_small, cut_lineage, hold, spread, table_bytes

Tokenizer = Callable[[Column], Column]

# An idf table of at most this size is looked up inside the rows.
MAX_LOOKUP_BYTES = 32 << 20

# Widest dense document x term table we build (V14): a column per term.
MAX_DENSE_TERMS = 2_000


def default_tokenizer(c: Column) -> Column:
    """Lowercase, runs of two or more word characters."""
    return T.word_tokens(c, 2)


def tokens_table(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
                 tokenizer: Tokenizer = default_tokenizer, positions: bool = False) -> DataFrame:
    """``(id, [pos,] term)``: one row per token; the texts stay where they were read."""
    d = spread(docs.select(id_col, text_col))
    if isinstance(tokenizer, NgramTokenizer):
        # two projections: the token array is computed once, then expanded
        d = tokenizer.based(d, id_col, text_col)
        tokenizer, text_col = tokenizer.expand, "_toks"
    if positions:
        return T.exploded(d, tokenizer(F.col(text_col)), id_col, pos="pos", name="term")
    return T.exploded(d, tokenizer(F.col(text_col)), id_col, name="term")


def term_vectors(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
                 tokenizer: Tokenizer = default_tokenizer) -> DataFrame:
    """``(id, terms)``, one row per document: its terms and their counts in term order."""
    d, tokens = spread(docs.select(id_col, text_col)), None
    if isinstance(tokenizer, NgramTokenizer):
        # two projections: the token array is computed once, then expanded
        d = tokenizer.based(d, id_col, text_col)
        tokens = let(F.col("_toks"), tokenizer.expand)
    else:
        tokens = tokenizer(F.col(text_col))
    return _merge_repeated(d.select(id_col, T.counted_terms(tokens).alias("terms")), docs.select(id_col), id_col)


def _merge_repeated(vectors: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Add up the vectors of rows that share an id (rows without id share one)."""
    many = cut_lineage(ids.groupBy(F.col(id_col).alias("_many")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_many"))
    if many.isEmpty():
        return vectors
    many = broadcast_if_small(many)
    same = F.col(id_col).eqNullSafe(F.col("_many"))
    sums = (vectors.join(many, same, "left_semi").select(id_col, F.explode("terms").alias("c"))
            .groupBy(id_col, F.col("c.term").alias("term")).agg(F.sum("c.tf").alias("tf")))
    merged = sums.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("term", "tf"))).alias("terms"))
    return vectors.join(many, same, "left_anti").unionByName(merged)


def term_counts(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
                tokenizer: Tokenizer = default_tokenizer) -> DataFrame:
    """``(id, term, tf)`` raw counts."""
    return _long(term_vectors(docs, text_col=text_col, id_col=id_col, tokenizer=tokenizer), id_col)


def _long(vectors: DataFrame, id_col: str) -> DataFrame:
    return T.exploded(vectors, F.col("terms"), id_col, name="c").select(id_col, "c.term", "c.tf")


class NgramTokenizer:
    """Base tokens with stopwords removed *before* n-grams are formed; n-grams join
    tokens by a space. The token array is materialised once (``base``) and n-grams
    are built from shifted slices of that column (``expand``), so the regex runs once
    per document, not once per position."""

    def __init__(self, stopwords: Sequence[str] | None, ngram_range: tuple[int, int] = (1, 1),
                 base: Tokenizer = default_tokenizer):
        self.stopwords = list(stopwords) if stopwords else None
        self.lo, self.hi = ngram_range
        self._base = base

    def based(self, d: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(id, _toks)``: the base tokens without stopwords."""
        d = d.select(id_col, self._base(F.col(text_col)).alias("_raw"))
        if not self.stopwords:
            return d.withColumnRenamed("_raw", "_toks")
        return StopWordsRemover(inputCol="_raw", outputCol="_toks", stopWords=self.stopwords,
                                caseSensitive=True).transform(d).select(id_col, "_toks")

    def base(self, c: Column) -> Column:
        arr = self._base(c)
        return T.remove_words(arr, self.stopwords) if self.stopwords else arr

    def expand(self, arr: Column) -> Column:
        parts = []
        for n in range(self.lo, self.hi + 1):
            if n == 1:
                parts.append(arr)
                continue
            shifted = [F.slice(arr, k + 1, F.greatest(F.size(arr) - k, F.lit(1))) for k in range(n)]
            zipped = F.arrays_zip(*[s.alias(f"g{k}") for k, s in enumerate(shifted)])
            full = F.filter(zipped, lambda z: z[f"g{n - 1}"].isNotNull())
            parts.append(F.transform(full, lambda z: F.concat_ws(" ", *[z[f"g{k}"] for k in range(n)])))
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    def __call__(self, c: Column) -> Column:
        return self.expand(self.base(c))


def ngram_tokenizer(stopwords: Sequence[str] | None, ngram_range: tuple[int, int] = (1, 1),
                    base: Tokenizer = default_tokenizer) -> NgramTokenizer:
    return NgramTokenizer(stopwords, ngram_range, base)


@dataclass
class IdfModel:
    """A fitted term table ``(term, df, idf[, idx])`` and its size."""

    table: DataFrame
    n_terms: int
    n_docs: int
    tf_cache: DataFrame | None = None

    def hinted(self, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
        return broadcast_if_small(self.table, max_bytes)

    def release(self) -> None:
        """Drop the persisted term counts of ``tfidf`` once its weights are written."""
        if self.tf_cache is not None:
            self.tf_cache.unpersist()
            self.tf_cache = None


def _doc_count(docs: DataFrame) -> int:
    return docs.count()


def fit_idf(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
            tokenizer: Tokenizer = default_tokenizer, min_df: float = 1, max_df: float = 1.0,
            max_features: int | None = None, vocabulary: Sequence[str] | None = None,
            smooth_idf: bool = True, vectors: DataFrame | None = None) -> IdfModel:
    """Fit document frequencies and smooth idf ``ln((1+n)/(1+df)) + 1``.

    ``min_df`` / ``max_df``: int = document count, float = share of documents.
    ``max_features`` keeps the top terms by corpus count ``(count desc, term asc)``
    after the df limits. ``vocabulary`` fixes the terms and their order; absent
    terms are kept with df 0."""
    n = _doc_count(docs)
    if vectors is None:
        vectors = term_vectors(docs, text_col=text_col, id_col=id_col, tokenizer=tokenizer)
    stats = T.exploded(vectors, F.col("terms"), name="c").select("c.term", "c.tf").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    if vocabulary is not None:
        if len(set(vocabulary)) != len(vocabulary):
            raise ValueError("duplicate term in vocabulary")
        vocab = docs.sparkSession.createDataFrame(
            [(i, t) for i, t in enumerate(vocabulary)], "idx int, term string")
        stats = (F.broadcast(vocab).join(stats, "term", "left")
                 .select("idx", "term", F.coalesce("df", F.lit(0)).cast("long").alias("df"),
                         F.coalesce("cf", F.lit(0)).cast("long").alias("cf")))
    else:
        lo = min_df if isinstance(min_df, int) else min_df * n
        hi = max_df if isinstance(max_df, int) else max_df * n
        if lo > 1:
            stats = stats.filter(F.col("df") >= F.lit(float(lo)))
        if not (isinstance(max_df, float) and max_df >= 1.0):
            stats = stats.filter(F.col("df") <= F.lit(float(hi)))
        if max_features is not None:
            stats = stats.orderBy(F.col("cf").desc(), F.col("term").asc()).limit(max_features)
    if smooth_idf:
        idf = F.log(F.lit(float(n + 1)) / (F.col("df") + 1)) + 1.0
    else:
        idf = F.log(F.lit(float(n)) / F.col("df")) + 1.0
    table = cut_lineage(stats.withColumn("idf", idf))
    return IdfModel(table, table.count(), n)


# Idf as a state that adds up
def idf_state(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
              tokenizer: Tokenizer = default_tokenizer) -> DataFrame:
    """``(term, df, cf)`` of a set of documents and one row without a term whose ``df`` is
    their number. States of disjoint sets of documents can be stored and added up, so new
    documents need no scan of the old ones."""
    vectors = term_vectors(docs, text_col=text_col, id_col=id_col, tokenizer=tokenizer)
    stats = T.exploded(vectors, F.col("terms"), name="c").groupBy("c.term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("c.tf").alias("cf"))
    number = docs.agg(F.lit(None).cast("string").alias("term"), F.count(F.lit(1)).alias("df"), F.lit(0).cast("long").alias("cf"))
    return stats.unionByName(number)


def merge_idf_states(*states: DataFrame) -> DataFrame:
    """The state of all documents: frequencies and numbers of documents add up."""
    every = states[0]
    for s in states[1:]:
        every = every.unionByName(s)
    return every.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def idf_of_state(state: DataFrame) -> IdfModel:
    """The smooth-idf model of a state; equal to one fit over its documents."""
    state = cut_lineage(state)
    n = state.filter("term IS NULL").agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).first()["n"]
    table = cut_lineage(state.filter("term IS NOT NULL").withColumn("idf", F.log(F.lit(float(n + 1)) / (F.col("df") + 1)) + 1.0))
    return IdfModel(table, table.count(), n)


def _frequent_from(table: DataFrame, max_bytes: int) -> int:
    """The document frequency from which on the terms of ``table`` take at most ``max_bytes``."""
    width = F.octet_length("term") + F.lit(16 * 2)
    sizes = table.groupBy("df").agg(F.sum(width).alias("b"))
    # one row per frequency that occurs
    so_far = sizes.select("df", F.sum("b").over(Window.orderBy(F.col("df").desc())).alias("b"))
    least = so_far.filter(F.col("b") <= max_bytes).agg(F.min("df")).first()[0]
    return least if least is not None else (table.agg(F.max("df")).first()[0] or 0) + 1


def weighted_vectors(vectors: DataFrame, model: IdfModel, *, id_col: str = "doc_id",
                     sublinear_tf: bool = False) -> DataFrame | None:
    """``(id, weights)``: arrays of ``(term, weight)`` in term order, weight = ``tf * idf``
    divided by the row's L2 norm, over the model's terms only. Computed batch by batch where
    the vectors lie, with the idf table at hand; None if that table is too large for it."""
    table = model.table.select("term", "idf")
    if table_bytes(table) > MAX_LOOKUP_BYTES:
        return None
    terms, idf = _held(table)
    kind = vectors.schema[id_col].dataType.simpleString()
    return _pieces(vectors, id_col, cells=F.col("terms")).mapInArrow(C.weigh(terms, idf, sublinear_tf), f"`{id_col}` {kind}, {_WEIGHTS}")


_CELLS = "array<struct<term:string,tf:bigint>>"
_RARE_CELLS = "array<struct<term:string,tf:bigint,idf:double>>"
_WEIGHTS = "weights array<struct<term:string,weight:double>>"


def _held(table: DataFrame) -> tuple[pa.Array, np.ndarray]:
    held = table.toArrow()
    return held.column("term").combine_chunks(), held.column("idf").to_numpy()


def _pieces(rows: DataFrame, id_col: str, **arrays: Column) -> DataFrame:
    """``(id, pos, arrays)``: rows of at most ``PIECE`` elements of each array; one without
    ``pos`` and arrays where all are empty."""
    n = F.greatest(F.lit(0), *[F.size(c) for c in arrays.values()])
    number = F.ceil(n / C.PIECE).cast("int")
    pieces = F.transform(F.when(number > 0, F.sequence(F.lit(0), number - 1)), lambda i: F.struct(
        *[F.slice(c, i * C.PIECE + 1, F.lit(C.PIECE)).alias(name) for name, c in arrays.items()]))
    return rows.select(id_col, F.posexplode_outer(pieces).alias("pos", "c")).select(id_col, "pos", "c.*")


def _vectors_met_by_idf(vectors: DataFrame, model: IdfModel, id_col: str, sublinear_tf: bool) -> DataFrame:
    """``weighted_vectors`` for an idf table of any size, cells in no order. The most frequent
    terms are looked up; the cells of the others, a small part of all, are joined with the
    table and brought to their vectors, which are shuffled once, as arrays of numbers."""
    least = _frequent_from(model.table, MAX_LOOKUP_BYTES)
    rest = model.table.filter(F.col("df") < least).select("term", "idf")
    terms, idf = _held(model.table.filter(F.col("df") >= least).select("term", "idf"))
    kind = vectors.schema[id_col].dataType.simpleString()
    numbered = _pieces(vectors, id_col, cells=F.col("terms")).mapInArrow(
        C.number(terms), f"`{id_col}` {kind}, at array<int>, tf array<int>, others {_CELLS}")
    rare = T.exploded(numbered, F.col("others"), id_col, name="c").select(id_col, "c.*").join(rest, "term")
    rare = rare.groupBy(F.col(id_col).alias("_of")).agg(F.collect_list(F.struct("term", "tf", "idf")).alias("_rare"))
    rows = numbered.select(id_col, "at", "tf").join(rare, F.col(id_col).eqNullSafe(F.col("_of")), "left")
    rows = _pieces(rows, id_col, at=F.col("at"), tf=F.col("tf"), rare=F.coalesce("_rare", F.array().cast(_RARE_CELLS)))
    return rows.mapInArrow(C.weigh_met(terms, idf, sublinear_tf), f"`{id_col}` {kind}, {_WEIGHTS}")


def _weights(vectors: DataFrame, model: IdfModel, id_col: str, sublinear_tf: bool) -> DataFrame:
    inside = weighted_vectors(vectors, model, id_col=id_col, sublinear_tf=sublinear_tf)
    if inside is None:
        inside = _vectors_met_by_idf(vectors, model, id_col, sublinear_tf)
    return inside.select(id_col, F.explode("weights").alias("c")).select(id_col, "c.term", "c.weight")


def transform(docs: DataFrame, model: IdfModel, *, text_col: str = "text", id_col: str = "doc_id",
              tokenizer: Tokenizer = default_tokenizer, sublinear_tf: bool = False,
              vectors: DataFrame | None = None) -> DataFrame:
    """``(id, term, weight)``: ``tf * idf`` divided by the document's L2 norm, over the
    model's terms only (unknown terms dropped; an all-zero document has no rows)."""
    if vectors is None:
        vectors = term_vectors(docs, text_col=text_col, id_col=id_col, tokenizer=tokenizer)
    return _weights(vectors, model, id_col, sublinear_tf)


def top_vocabulary(docs: DataFrame, k: int, *, text_col: str = "text", id_col: str = "doc_id",
                   tokenizer: Tokenizer = default_tokenizer, sketch: bool = False) -> list[str]:
    """The ``k`` terms with the highest corpus count ``(count desc, term asc)``: a partial
    aggregate per term, then a top-k; no text and no (document, term) pair is shuffled.
    ``sketch`` shuffles only terms that can be among them, at one or two more passes over the
    texts (see ``top_words``): for n-grams, of which a large corpus has no end."""
    tokens = tokens_table(docs, text_col=text_col, id_col=id_col, tokenizer=tokenizer)
    if sketch:
        return [w for w, _ in top_words(tokens.select(F.col("term").alias("word")), k)]
    counts = tokens.groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    return [r["term"] for r in counts.orderBy(F.col("cf").desc(), F.col("term").asc()).limit(k).collect()]


def _few_vectors(docs: DataFrame, vocabulary: Sequence[str], *, text_col: str, id_col: str, tokenizer: Tokenizer) -> DataFrame:
    """Term vectors over a small fixed vocabulary: tokens are filtered by it within the
    row, before they are counted."""
    d, words = spread(docs.select(id_col, text_col)), list(dict.fromkeys(vocabulary))
    if isinstance(tokenizer, NgramTokenizer):
        d = tokenizer.based(d, id_col, text_col)
        tokens = let(F.col("_toks"), tokenizer.expand)
    else:
        tokens = tokenizer(F.col(text_col))
    kept = F.filter(tokens, lambda t: t.isin(words))
    return _merge_repeated(d.select(id_col, T.counted_terms(kept).alias("terms")), docs.select(id_col), id_col)


def tfidf_vectors(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", tokenizer: Tokenizer = default_tokenizer,
                  **fit_kw) -> tuple[IdfModel, DataFrame]:
    """The fitted model and the term vectors it was fitted on.

    The vectors are built once and held (``session.hold``: those of a small input persisted,
    others written): the fit reads them for the document frequencies and the transform for
    the weights, so the corpus is tokenised once. ``IdfModel.release()`` drops persisted ones. With a
    fixed ``vocabulary``, or ``max_features`` and no df limits, the terms are known first and
    only their counts are built."""
    of = {"text_col": text_col, "id_col": id_col, "tokenizer": tokenizer}
    if set(fit_kw) <= {"vocabulary", "smooth_idf"} and fit_kw.get("vocabulary") is not None:
        vectors = _few_vectors(docs, fit_kw["vocabulary"], **of)
    elif set(fit_kw) <= {"max_features", "smooth_idf"} and fit_kw.get("max_features") is not None:
        vectors = _few_vectors(docs, top_vocabulary(docs, fit_kw.pop("max_features"), **of), **of)
    else:
        vectors = term_vectors(docs, **of)
    vectors = hold(vectors, docs, "vectors")
    model = fit_idf(docs, vectors=vectors, **of, **fit_kw)
    model.tf_cache = vectors
    return model, vectors


def tfidf(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
          tokenizer: Tokenizer = default_tokenizer, sublinear_tf: bool = False,
          **fit_kw) -> tuple[IdfModel, DataFrame]:
    """Fit and transform the same documents (V7, V9-V11): see ``tfidf_vectors``."""
    model, vectors = tfidf_vectors(docs, text_col=text_col, id_col=id_col, tokenizer=tokenizer, **fit_kw)
    return model, _weights(vectors, model, id_col, sublinear_tf)


# V1
def bag_of_words(docs: DataFrame, vocabulary: Sequence[str], *, id_col: str = "doc_id",
                 tokens_col: str = "tokens") -> DataFrame:
    """``(id, pos, term, n)``: counts aligned to an ordered vocabulary (a duplicate term
    has a slot of its own with the same count). Tokens are filtered by the vocabulary
    before they are counted; slots without an occurrence are 0."""
    spark = docs.sparkSession
    slots = spark.createDataFrame(list(enumerate(vocabulary)), "pos int, term string")
    hits = (T.exploded(docs, F.col(tokens_col), id_col, name="term")
            .join(broadcast_if_small(slots.select("term").distinct()), "term", "left_semi")
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("n")))
    grid = docs.select(id_col, F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(t).alias("term"))
                                                   for i, t in enumerate(vocabulary)])).alias("s"))
    return (grid.select(id_col, "s.*").join(hits, [id_col, "term"], "left")
            .select(id_col, "pos", "term", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


# V2
def word_frequencies(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``(word, n, total)`` over lowercased whitespace tokens.

    The count table is fitted once (partial aggregate, then written to the shared
    checkpoint folder); the total and every later use read that table instead of
    tokenising the corpus again."""
    counts = cut_lineage(
        T.exploded(spread(docs.select(text_col)), T.whitespace_tokens(F.col(text_col)), name="word")
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total))


# V3
def frequent_stopwords(docs: DataFrame, *, text_col: str = "text",
                       base: Sequence[str] = fixed.ENGLISH_STOPWORDS,
                       threshold: float = fixed.FREQUENCY_THRESHOLD, sketch: bool = False) -> DataFrame:
    """Base list + contractions + every word with ``n / total > threshold``.
    At most ``1/threshold`` words pass the share test, so the result is small. ``sketch``
    finds them without shuffling the other words, at a second pass over the texts (see
    ``heavy_words``)."""
    spark = docs.sparkSession
    freq = (heavy_words(docs, threshold, text_col=text_col) if sketch else
            word_frequencies(docs, text_col=text_col).filter(F.col("n") / F.col("total") > F.lit(threshold))).select("word")
    fixed_words = spark.createDataFrame([(w,) for w in list(base) + fixed.CONTRACTIONS], "word string")
    return fixed_words.unionByName(freq).distinct()


# Words a heavy-hitter sketch may track: Spark's limit.
MAX_TRACKED = 1_000_000


def heavy_words(docs: DataFrame, threshold: float, *, text_col: str = "text") -> DataFrame:
    """``(word, n, total)`` of exactly the words with ``n / total > threshold``; the other
    words of the corpus are never shuffled.

    First pass: a frequent-items sketch per task, merged. One that tracks ``m`` words is wrong
    by at most ``3.5 total / m`` and reports every word more than twice that far above 0, so
    with ``m >= 8 / threshold`` no word above the threshold is missing. Second pass: the few
    candidates are looked up in the rows and counted exactly, beside the total. A threshold too
    small for a sketch of ``MAX_TRACKED`` words is answered by the full count table."""
    if not threshold > 0 or math.ceil(8 / threshold) > MAX_TRACKED:
        return word_frequencies(docs, text_col=text_col).filter(F.col("n") / F.col("total") > F.lit(threshold))
    words = T.exploded(spread(docs.select(text_col)), T.whitespace_tokens(F.col(text_col)), name="word")
    counts = _recounted(words, max(math.ceil(8 / threshold), 64))
    total = counts.agg(F.sum("n").alias("total"))
    return (counts.filter("word IS NOT NULL").crossJoin(F.broadcast(total))
            .filter(F.col("n") / F.col("total") > F.lit(threshold)))


def _recounted(words: DataFrame, tracked: int) -> DataFrame:
    """``(word, n)``: exact counts of the words that the merged sketches of ``tracked`` words
    report, and one row without a word for all others."""
    sketch = words.agg(F.expr(f"approx_top_k_accumulate(word, {tracked})").alias("s"))
    found = cut_lineage(sketch.select(F.explode(F.expr(f"approx_top_k_estimate(s, {tracked})")).alias("c"))
                        .select(F.col("c.item").alias("_cand")))
    # words that are no candidate share one group, whose count only adds to the total
    looked = words.join(broadcast_if_small(found), F.col("word") == F.col("_cand"), "left")
    return cut_lineage(looked.groupBy(F.col("_cand").alias("word")).agg(F.count(F.lit(1)).alias("n")))


# Words the first sketch of ``top_words`` tracks.
FIRST_TRACKED = 4_096


def top_words(words: DataFrame, k: int, tracked: int = FIRST_TRACKED) -> list[tuple[str, int]]:
    """The ``k`` first of the rows' words by ``(count desc, word asc)`` with their counts,
    exactly, without a shuffle of all words.

    The words a merged sketch reports are recounted; the k-th of these counts is a lower bound
    for the k-th of all. Words that a sketch of ``m`` leaves out occur at most ``7 total / m``
    times (see ``heavy_words``): below the bound the answer is final, else one more sketch is
    made wide enough for the bound. A bound that needs more than ``MAX_TRACKED`` words (no word
    stands out) is answered by the full counts."""
    while k > 0:
        counts = _recounted(words, tracked)
        sums = counts.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("others")).first()
        best = _first_words(counts.filter("word IS NOT NULL"), k)
        bound = best[-1][1] if len(best) == k else 0
        if not sums["others"] or 7 * sums["total"] < bound * tracked:
            return best
        if not bound or 8 * sums["total"] > bound * MAX_TRACKED:
            return _first_words(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), k)
        tracked = -(-8 * sums["total"] // bound)
    return []


def _first_words(counts: DataFrame, k: int) -> list[tuple[str, int]]:
    return [tuple(r) for r in counts.select("word", "n").orderBy(F.col("n").desc(), F.col("word").asc()).limit(k).collect()]


# V4 / R5
def extend_stopwords(base: DataFrame, extra: DataFrame | Sequence[str]) -> DataFrame:
    if not isinstance(extra, DataFrame):
        extra = base.sparkSession.createDataFrame([(w,) for w in extra], "word string")
    return base.select("word").unionByName(extra.select("word")).distinct()


# V5
def default_stopwords(spark, words: Sequence[str] = fixed.ENGLISH_STOPWORDS) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], "word string")


def cloud_tokens(c: Column) -> Column:
    """Word-cloud tokens: lowercased, trailing ``'s`` removed, pure digit runs dropped."""
    toks = F.regexp_extract_all(F.lower(c), F.lit(T.APOSTROPHE_TOKEN), 0)
    toks = F.transform(toks, lambda t: F.regexp_replace(t, "'s$", ""))
    return F.filter(toks, lambda t: ~t.rlike(r"^\p{Nd}+$"))


# V6
def class_top_words(docs: DataFrame, stopwords: DataFrame, *, text_col: str = "text",
                    label_col: str = "label", k: int = 100) -> DataFrame:
    """``(label, word, n, weight, rank)``: top ``k`` words per class by
    ``(n desc, word asc)``, weight = n / the class's top count.
    ``stopwords`` is written and broadcast if its size allows."""
    words = (T.exploded(spread(docs.select(label_col, text_col)), cloud_tokens(F.col(text_col)), label_col, name="word")
             .join(broadcast_if_small(cut_lineage(stopwords.select("word"))), "word", "left_anti")
             .groupBy(label_col, "word").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy(label_col).orderBy(F.col("n").desc(), F.col("word").asc())
    ranked = words.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    top = F.max("n").over(Window.partitionBy(label_col))
    return ranked.withColumn("weight", F.col("n") / top)


# V12
def matrix_shape(model: IdfModel) -> tuple[int, int]:
    return model.n_docs, model.n_terms


# V13
def sorted_vocabulary(model: IdfModel) -> DataFrame:
    """``(idx, term)`` in term order, numbered per sorted partition."""
    return number_sorted(model.table, "term", id_col="idx").select("idx", "term")


# V15
def melted_matrix(docs_ids: DataFrame, weights: DataFrame, model: IdfModel, *, id_col: str = "doc_id",
                  max_terms: int = MAX_DENSE_TERMS) -> DataFrame:
    """Every (document, term) pair, zeros filled: by definition as many rows as documents
    times terms, so ``max_terms`` bounds the vocabulary as in ``dense_matrix``."""
    if model.n_terms > max_terms:
        raise ValueError(f"vocabulary of {model.n_terms} terms is too wide for a melted table "
                         f"(limit {max_terms}); use the long form")
    grid = docs_ids.select(id_col).crossJoin(model.hinted().select("term"))
    return (grid.join(weights, [id_col, "term"], "left")
            .select(id_col, "term", F.coalesce("weight", F.lit(0.0)).alias("weight")))


# V14
def dense_matrix(docs_ids: DataFrame, weights: DataFrame, model: IdfModel, *,
                 id_col: str = "doc_id", max_terms: int = MAX_DENSE_TERMS) -> DataFrame:
    """One column per term, ``t01``, ``t02``, ... in term order (``sorted_vocabulary``
    names them), zeros filled, every document kept. ``max_terms`` bounds the columns."""
    if model.n_terms > max_terms:
        raise ValueError(f"vocabulary of {model.n_terms} terms is too wide for a dense table "
                         f"(limit {max_terms}); use the long form")
    terms = [r["term"] for r in model.table.select("term").orderBy("term").collect()]
    width = max(2, len(str(len(terms))))
    cells = [F.coalesce(F.max(F.when(F.col("term") == t, F.col("weight"))), F.lit(0.0)).alias(f"t{i:0{width}d}")
             for i, t in enumerate(terms, 1)]
    wide = docs_ids.select(id_col).join(weights, id_col, "left").groupBy(id_col)
    return wide.agg(*cells) if cells else docs_ids.select(id_col)


# A6
def term_totals(weights: DataFrame) -> DataFrame:
    return weights.groupBy("term").agg(F.sum("weight").alias("total_weight"))


# K1
def top_terms_per_doc(weights: DataFrame, k: int = 20, *, id_col: str = "doc_id") -> DataFrame:
    """The ``k`` first rows of every document by ``(weight desc, term asc)`` with their rank."""
    w = Window.partitionBy(id_col).orderBy(F.col("weight").desc(), F.col("term").asc())
    return weights.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_terms(vectors: DataFrame, model: IdfModel, k: int = 20, *, id_col: str = "doc_id") -> DataFrame:
    """``(id, rank, term, weight)``: the top terms of every document, inside its row."""
    inside = weighted_vectors(vectors, model, id_col=id_col)
    if inside is None:
        inside = _vectors_met_by_idf(vectors, model, id_col, False)
    first = F.slice(F.sort_array(F.transform("weights", lambda c: F.struct((-c["weight"]).alias("w"), c["term"].alias("term")))), 1, k)
    return inside.select(id_col, F.posexplode(first).alias("pos", "c")).select(
        id_col, (F.col("pos") + 1).alias("rank"), "c.term", (-F.col("c.w")).alias("weight"))


# K2
def top_terms_overall(weights: DataFrame, k: int = 20) -> DataFrame:
    return (term_totals(weights)
            .orderBy(F.col("total_weight").desc(), F.col("term").asc()).limit(k))


# Terms whose totals give the bound of ``top_terms_bounded``, per term asked for.
FIRST_TERMS = 4


def terms_in_reach(weights: DataFrame, model: IdfModel, k: int) -> DataFrame:
    """``(term)``, written: the terms whose total weight can be among the ``k`` largest. A
    weight is at most 1, so a term's total is at most its document frequency; the totals of the
    most frequent terms give the bound that it has to reach."""
    often = cut_lineage(model.table.orderBy(F.col("df").desc(), F.col("term").asc()).limit(FIRST_TERMS * k).select("term"))
    best = top_terms_overall(weights.join(broadcast_if_small(often), "term", "left_semi"), k).collect()
    bound = best[-1]["total_weight"] if 0 < k == len(best) else 0.0
    # sums of doubles may be off in their last digits
    return cut_lineage(model.table.filter(F.col("df") >= bound * (1 - 1e-9)).select("term"))


def top_terms_bounded(weights: DataFrame, model: IdfModel, k: int = 20) -> DataFrame:
    """``top_terms_overall`` that shuffles only the terms in reach, at a second pass over the
    weights."""
    return top_terms_overall(weights.join(broadcast_if_small(terms_in_reach(weights, model, k)), "term", "left_semi"), k)

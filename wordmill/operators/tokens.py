"""DataFrame-level token operators: T9 (lexicon join), T10 (composite preprocessing),
T16 (token-id encoding), and a data-derived plural lexicon.

Mode 0 of ``preprocess`` is a pure column pipeline (no shuffle). Modes 1 and 2 map
tokens through a caller-supplied lexicon ``(token, base)`` (stems or lemmas); the
lexicon is joined to the long token table, broadcast only behind its counted size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.functions import fixed
from wordmill.functions import text as T
from wordmill.session import MAX_BROADCAST_BYTES, broadcast_if_small, cut_lineage, scratch_path, spread


def remove_stopwords(df: DataFrame, in_col: str, out_col: str,
                     stopwords: Sequence[str] = fixed.ENGLISH_STOPWORDS) -> DataFrame:
    """T8 on an array column: JVM hash-set lookup, exact (case-sensitive) match."""
    return StopWordsRemover(inputCol=in_col, outputCol=out_col, stopWords=list(stopwords),
                            caseSensitive=True).transform(df)


def fit_lexicon(lexicon: DataFrame) -> DataFrame:
    """``(token, base)`` written once, one row per token: of several bases the smallest
    in order is taken, so a repeated token cannot multiply rows."""
    return cut_lineage(lexicon.groupBy("token").agg(F.min("base").alias("base")))


# T9
def apply_lexicon(tokens: DataFrame, lexicon: DataFrame, *, token_col: str = "token",
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Replace each token by its base form when the lexicon ``(token, base)`` has one.

    The lexicon is fitted first (written, one base per token). Below the byte limit it is
    broadcast, else joined by a shuffle that AQE can split at frequent tokens."""
    lex = fit_lexicon(lexicon).select(F.col("token").alias("_lex_token"), F.col("base").alias("_lex_base"))
    out = tokens.join(broadcast_if_small(lex, max_broadcast_bytes), tokens[token_col] == F.col("_lex_token"), "left")
    return (out.withColumn(token_col, F.coalesce(F.col("_lex_base"), F.col(token_col)))
            .drop("_lex_token", "_lex_base"))


def plural_lexicon(tokens: DataFrame, *, token_col: str = "token") -> DataFrame:
    """A lexicon derived from the corpus itself: a word ending in ``s`` (not ``ss``)
    maps to the word without it when that word also occurs. The vocabulary is written
    once, so the corpus is tokenised once for it."""
    vocab = cut_lineage(tokens.select(F.col(token_col).alias("token")).distinct())
    plural = (vocab.filter(F.col("token").rlike("[^s]s$") & (F.length("token") > 2))
              .withColumn("base", F.expr("substring(token, 1, length(token) - 1)")))
    return plural.join(vocab.select(F.col("token").alias("base")), "base", "left_semi")


def _collect_ordered(long_df: DataFrame, id_col: str, row_col: str) -> DataFrame:
    """One row per ``row_col`` with its tokens in order; null tokens are left out."""
    present = F.when(F.col("token").isNotNull(), F.struct("pos", "token"))
    arr = F.transform(F.array_sort(F.collect_list(present)), lambda x: x["token"])
    return long_df.groupBy(row_col).agg(F.first(id_col).alias(id_col), arr.alias("tokens"))


# T10
def preprocess(df: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", mode: int = 1,
               stopwords: Sequence[str] = fixed.ENGLISH_STOPWORDS, lexicon: DataFrame | None = None,
               join: bool = True, out_col: str = "tokens") -> DataFrame:
    """``(id, tokens)``: lowercase, split on non-word runs, drop stopwords, then
    mode 0 keeps tokens with an ASCII letter; mode 1 (the default) also maps stems
    through ``lexicon``; mode 2 and above map lemmas through ``lexicon`` (no ASCII-letter
    test, strip and abbreviation rule applied); finally all-letter tokens not in the stopword list.
    ``join=True`` gives one space-joined string, else an array; every row is kept, rows
    that share an id each with their own tokens."""
    if mode < 0:
        raise ValueError("mode must be 0 (plain), 1 (stem) or 2 and above (lemma)")
    raw = F.split(F.lower(F.col(text_col)), T.NON_WORD_RUN)
    if mode == 0:
        d = spread(df.select(id_col, text_col)).select(id_col, T.keep_ascii_letter_tokens(raw).alias("_t0"))
        d = remove_stopwords(d, "_t0", "_t1", stopwords)
        d = d.select(id_col, T.keep_alpha_tokens(F.col("_t1")).alias("_t2"))
        d = remove_stopwords(d, "_t2", out_col, stopwords)
        d = d.select(id_col, out_col)
        return d.withColumn(out_col, F.array_join(out_col, " ")) if join else d
    if lexicon is None:
        raise ValueError("modes 1 and 2 need a lexicon DataFrame (token, base)")
    # A dropped token stays as a null, so every row is still there when its tokens meet again:
    # that is the one exchange, and it carries no texts.
    row = "_wm_row"
    long = (spread(df.select(id_col, text_col)).withColumn(row, F.monotonically_increasing_id())
            .select(row, id_col, F.posexplode_outer(raw).alias("pos", "token")))

    def keep(d: DataFrame, cond: Column) -> DataFrame:
        return d.withColumn("token", F.when(cond, F.col("token")))

    token = F.col("token")
    not_stop = ~token.isin(list(dict.fromkeys(stopwords))) if stopwords else F.lit(True)
    if mode == 1:
        # a stem may equal a stopword, hence the second pass after the lexicon
        long = apply_lexicon(keep(long, token.rlike(T.HAS_ASCII_LETTER) & not_stop), lexicon)
        long = keep(long, token.rlike(T.ALL_LETTERS) & not_stop)
    else:
        long = apply_lexicon(keep(long, token != ""), lexicon)
        long = long.withColumn("token", T.abbr_or_lower(T.strip_non_word("token")))
        long = keep(long, not_stop & token.rlike(T.ALL_LETTERS))
    grouped = _collect_ordered(long, id_col, row)
    return grouped.select(id_col, (F.array_join("tokens", " ") if join else F.col("tokens")).alias(out_col))


def number_sorted(values: DataFrame, col: str, *, offset: int = 0, id_col: str = "id") -> DataFrame:
    """``(col, id)``: distinct values numbered in sorted order without a global window.

    A range sort writes the values once with their partition number; the partitions'
    counts are a small table whose running sum gives each partition its first number."""
    spark = values.sparkSession
    path = scratch_path(spark, "sorted")
    (values.select(col).distinct().orderBy(col).withColumn("_part", F.spark_partition_id())
     .write.parquet(path))
    ordered = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = (ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_part", "_first"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(col))
    return (ordered.withColumn("_place", place).join(broadcast_if_small(cut_lineage(first)), "_part")
            .select(col, (F.col("_first") + F.col("_place") + (offset - 1)).cast("long").alias(id_col)))


def sorted_vocab_ids(tokens: DataFrame, *, token_col: str = "token", offset: int = 1) -> DataFrame:
    """``(token, id)``: distinct tokens numbered in sorted order starting at ``offset``
    (0 is the padding id)."""
    return number_sorted(tokens.select(F.col(token_col).alias("token")), "token", offset=offset)


# T16
def encode_ids(df: DataFrame, vocab: DataFrame, *, id_col: str = "doc_id", tokens_col: str = "tokens",
               max_len: int = fixed.MAX_SEQ_LEN, unknown_id: int = 0) -> DataFrame:
    """``(id, input_ids, attention_mask)``: the first ``max_len`` tokens as ids,
    zero-padded, mask 1 for real tokens. A token outside ``vocab`` ``(token, id)`` gets
    ``unknown_id`` and keeps its place. Documents are cut before their tokens are
    expanded, so at most ``max_len`` rows per document are joined and gathered."""
    cut = df.select(id_col, F.slice(tokens_col, 1, max_len).alias("_t"))
    v = broadcast_if_small(cut_lineage(vocab.select("token", F.col("id").alias("_id"))))
    found = (cut.select(id_col, F.posexplode("_t").alias("pos", "token")).join(v, "token", "left")
             .select(id_col, "pos", F.coalesce("_id", F.lit(unknown_id)).cast("long").alias("_id")))
    ids = found.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "_id"))),
                                                lambda x: x["_id"]).alias("_ids"))
    ids = df.select(id_col).join(ids, id_col, "left").select(
        id_col, F.coalesce("_ids", F.array().cast("array<long>")).alias("_ids"))
    pad = F.greatest(F.lit(max_len) - F.size("_ids"), F.lit(0))
    return ids.select(
        id_col,
        F.concat("_ids", F.array_repeat(F.lit(0).cast("long"), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("_ids")), F.array_repeat(F.lit(0), pad))
        .alias("attention_mask"),
    )

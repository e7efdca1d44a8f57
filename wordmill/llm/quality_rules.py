"""Quality rules as a bitmask ledger (operator 1).

Every rule is evaluated once per document. The ledger keeps the measurements and one
long ``failed_bits`` (bit r set: rule r failed). Policies are versioned masks over
those bits, so a new policy, or what a rule alone costs, is computed from the stored
bits and never from the texts again.

Null or empty texts have no words: all measurements are 0 and ``few_words`` fails.
Repeated rows give repeated ledger rows; extra columns of the input are ignored."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm import textbytes as B

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_letters", "n_capitals", "n_exclaims"]
WINDOW = 8

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_NEWLINE = B.byte_set((0x0A, 0x0A))
_CAPITAL = B.byte_set((0x41, 0x5A))
_LETTER = B.byte_set((0x41, 0x5A), (0x61, 0x7A))
_EXCLAIM = B.byte_set((0x21, 0x21))
_NOT_FIRST_BYTE = B.byte_set((0x80, 0xBF))


@dataclass(frozen=True)
class Rule:
    """``failed`` is a condition over the measurements; ``bit`` is fixed for good."""

    bit: int
    name: str
    failed: str


#: Bits are never reused for another rule: stored ledgers stay readable.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "capitals", "n_letters >= 40 AND 10 * n_capitals > 6 * n_letters"),
    Rule(4, "repeated_lines", "n_lines >= 4 AND 10 * n_dup_lines > 6 * n_lines"),
    Rule(5, "word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule(6, "exclamations", "10 * n_exclaims > 8 * n_words"),
)
BASE_BITS = 0b11


@dataclass(frozen=True)
class Policy:
    """A document is kept if none of the bits in ``mask`` is set."""

    version: str
    mask: int


POLICIES = {p.version: p for p in (
    Policy("v1-base", BASE_BITS),
    Policy("v2", sum(1 << r.bit for r in RULES)),
)}
DEFAULT_POLICY = POLICIES["v2"]


def _measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    starts, ends, first = B.spans(data, offsets, B.WHITE)
    hashes = B.span_hashes(data, starts, ends)
    n_words = np.diff(first)
    white = B.WHITE[data]
    word_chars = B.sums(~white & ~_NOT_FIRST_BYTE[data], offsets)

    # lines that hold a word, hashed whole
    l_start, l_end, l_first = B.spans(data, offsets, _NEWLINE)
    inked = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~white, out=inked[1:])
    worded = inked[l_end] > inked[l_start]
    l_doc = B.row_of(l_first)[worded]
    l_first = np.searchsorted(l_doc, np.arange(len(offsets)))
    lines = B.sort_within(B.span_hashes(data, l_start[worded], l_end[worded]), l_first)
    again = np.zeros(len(lines), bool)
    again[1:] = (lines[1:] == lines[:-1]) & (l_doc[1:] == l_doc[:-1])

    win, w_first = B.windows(hashes, first, WINDOW)
    ordered = B.sort_within(win, w_first)
    w_doc = B.row_of(w_first)
    twice = np.zeros(len(win), bool)
    twice[1:] = (ordered[1:] == ordered[:-1]) & (w_doc[1:] == w_doc[:-1])
    n_repeat = np.zeros(len(n_words), np.int64)
    for d in np.unique(w_doc[twice]).tolist():
        a, b = w_first[d], w_first[d + 1]
        hit = np.flatnonzero(np.isin(win[a:b], ordered[a:b][twice[a:b]]))
        cover = np.zeros(int(n_words[d]) + 1, np.int64)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WINDOW, -1)
        n_repeat[d] = np.count_nonzero(np.cumsum(cover[:-1]))

    return [n_words, word_chars, B.sums(_SYMBOL[data], offsets), B.sums(again, l_first), n_repeat,
            np.diff(l_first), B.sums(_LETTER[data], offsets), B.sums(_CAPITAL[data], offsets),
            B.sums(_EXCLAIM[data], offsets)]


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in B.blocks(batch.column(1)):
            columns = [pa.array(np.asarray(c, np.int64)) for c in _measure(data, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), *columns], ["doc_id", *MEASURES])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, measurements...)``: one narrow pass over the texts."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(_measure_batches, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))


def bits(rules: Sequence[Rule] = RULES) -> Column:
    """The failure bits of all rules over the measurement columns."""
    out = F.lit(0).cast("long")
    for r in rules:
        out = out.bitwiseOR(F.when(F.expr(r.failed), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return out


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, measurements..., failed_bits)``."""
    return measure(docs, id_col, text_col).withColumn("failed_bits", bits(rules))


def apply_policy(led: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """The ledger with ``kept`` under one policy."""
    return led.withColumn("kept", F.col("failed_bits").bitwiseAND(F.lit(policy.mask)) == 0)


def ablation(led: DataFrame, policy: Policy = DEFAULT_POLICY, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: ``n_failed``, ``n_failed_alone`` (kept if this rule went)
    and ``also_failed_bits`` (every bit that failed beside it). One pass counts the
    distinct bit patterns; the rest works on those few rows."""
    patterns = (led.groupBy(F.col("failed_bits").bitwiseAND(F.lit(policy.mask)).alias("p"))
                .agg(F.count(F.lit(1)).alias("n")))
    names = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                      for r in rules if policy.mask >> r.bit & 1])
    each = patterns.select("p", "n", F.explode(names).alias("r")).select("p", "n", "r.rule", "r.bit")
    hit = F.col("p").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule", "bit").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("p") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_failed_alone"),
        F.coalesce(F.bit_or(F.when(hit, F.col("p"))), F.lit(0)).alias("also_failed_bits")).drop("bit")


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` under the current policy."""
    led = apply_policy(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    failed = F.col("failed_bits").bitwiseAND(F.lit(BASE_BITS)) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"), "failed_bits")


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
win AS (SELECT doc_id, unnest(range(1, greatest(len(words) - 6, 1))) AS i, words FROM w),
keyed AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS k FROM win),
dup AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM keyed),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM
  (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM dup WHERE c > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
lc AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
  length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
  length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
  length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaims
  FROM w LEFT JOIN covered c USING (doc_id) LEFT JOIN lc USING (doc_id)),
b AS (SELECT *, CAST(
    (n_words < 20)::INT * 1 + (100 * n_repeat_words > 30 * n_words)::INT * 2 + (10 * n_symbols > 3 * n_words)::INT * 4
  + (n_letters >= 40 AND 10 * n_capitals > 6 * n_letters)::INT * 8
  + (n_lines >= 4 AND 10 * n_dup_lines > 6 * n_lines)::INT * 16
  + (word_chars < 2 * n_words OR word_chars > 20 * n_words)::INT * 32
  + (10 * n_exclaims > 8 * n_words)::INT * 64 AS BIGINT) AS failed_bits FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, failed_bits & 3 <> 0 AS base_failed,
  failed_bits = 0 AS kept, failed_bits FROM b
"""

"""Column-level string and token functions.

Everything here but ``exploded`` returns a ``Column`` built from JVM-side functions (regex, higher-order
array functions), so it stays inside whole-stage code generation and needs no Python
worker. The regex classes are Unicode-aware on purpose: Java's ``\\w`` is ASCII-only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.functions import fixed

# A Unicode word character (letters, digits of any script, underscore).
WORD_CLASS = r"[\p{L}\p{N}_]"
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"
# Tokens of at least two word characters (default TF-IDF tokenizer).
WORD2_TOKEN = r"[\p{L}\p{N}_]{2,}"
# Word-cloud style tokens: a word character then word characters or apostrophes.
APOSTROPHE_TOKEN = r"[\p{L}\p{N}_][\p{L}\p{N}_']*"
# Every character a plain ``str.split()`` treats as whitespace.
WS_CLASS = (r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
WS_RUN = WS_CLASS + "+"
ABBREVIATION = r"^([A-Z]+[a-z]*){2,}"
HAS_ASCII_LETTER = r"[a-zA-Z]"
ALL_LETTERS = r"^\p{L}+$"
INT_REPLY = r"^[+-]?[0-9]+$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# T1
def lower(c: str | Column) -> Column:
    return F.lower(_col(c))


def _drop_empty(arr: Column) -> Column:
    return F.filter(arr, lambda t: t != F.lit(""))


# T2
def word_split(c: str | Column) -> Column:
    """Split on runs of non-word characters; empty pieces dropped."""
    return _drop_empty(F.split(_col(c), NON_WORD_RUN))


# T3
def whitespace_tokens(c: str | Column) -> Column:
    """Lowercased whitespace tokens, like ``text.lower().split()``."""
    return _drop_empty(F.split(F.lower(_col(c)), WS_RUN))


def word_tokens(c: str | Column, min_len: int = 2) -> Column:
    """Lowercased maximal runs of at least ``min_len`` word characters."""
    pattern = WORD_CLASS + "{%d,}" % min_len if min_len > 1 else WORD_CLASS + "+"
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(pattern), 0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once: a lambda variable, unlike a column, cannot be
    replaced by its expression inside another lambda, where it would be computed per
    element."""
    return F.get(F.transform(F.array(value), body), 0)


def counted_terms(tokens: Column) -> Column:
    """An array of ``(term, tf)`` in term order, counted within the row: the tokens are
    sorted, and a term's count is the distance between the places where it and the next
    term begin. Nothing is shuffled; the time is that of the sort. NULL counts as empty."""
    def starts(s: Column) -> Column:
        return F.when(F.size(s) > 0, F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
                      ).otherwise(F.array().cast("array<int>"))

    def pairs(s: Column, at: Column) -> Column:
        return F.transform(at, lambda p, k: F.struct(
            F.get(s, p).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - p).cast("long").alias("tf")))
    words = F.sort_array(F.coalesce(tokens, F.array().cast("array<string>")))
    return let(words, lambda s: let(starts(s), lambda at: pairs(s, at)))


def exploded(df: DataFrame, array: Column, *keep: str, name: str, pos: str | None = None) -> DataFrame:
    """``keep``, [``pos``] and ``name``: a row per element that is not NULL. A plain ``explode``
    of an expression makes the planner infer the filter ``size(expression) > 0`` below it, which
    computes every row's array a second time; an outer one does not."""
    if pos is not None:
        return df.select(*keep, F.posexplode_outer(array).alias(pos, name)).filter(F.col(name).isNotNull())
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


# T4
def abbr_or_lower(c: str | Column) -> Column:
    """Keep abbreviations / camel words (``NASA``, ``HelloWorld``); lowercase the rest."""
    w = _col(c)
    return F.when(w.rlike(ABBREVIATION), w).otherwise(F.lower(w))


# T5
def strip_non_word(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), NON_WORD_RUN, "")


# T6
def keep_ascii_letter_tokens(arr: Column) -> Column:
    return F.filter(arr, lambda t: t.rlike(HAS_ASCII_LETTER))


# T7
def keep_alpha_tokens(arr: Column) -> Column:
    return F.filter(arr, lambda t: t.rlike(ALL_LETTERS))


# T8 (small literal lists; for large lists use StopWordsRemover or an anti join)
def remove_words(arr: Column, words: Sequence[str]) -> Column:
    lit_words = F.array(*[F.lit(w) for w in words])
    return F.filter(arr, lambda t: ~F.array_contains(lit_words, t))


def strip_ws(c: str | Column) -> Column:
    """Trim every Unicode whitespace character at both ends (``str.strip()``)."""
    return F.regexp_replace(_col(c), f"^{WS_RUN}|{WS_RUN}$", "")


# T11
def clean_generated(c: str | Column) -> Column:
    """strip, lower, newline to space, carriage return removed."""
    s = F.lower(strip_ws(c))
    return F.regexp_replace(F.regexp_replace(s, "\n", " "), "\r", "")


# T12
def parse_int_reply(c: str | Column) -> Column:
    """Reply to an int label or NULL. No range check: ``7`` is accepted."""
    s = F.lower(strip_ws(c))
    return F.when(s.rlike(INT_REPLY), s.try_cast("int"))


# T13
def prompt_header() -> str:
    return "\n\n".join(f"{k}: {v}" for k, v in fixed.PROMPT_BLOCKS)


def few_shot_line(text: str | Column, label: str | Column) -> Column:
    a, b, c = fixed.PROMPT_EXAMPLE_FORMAT
    return F.concat(F.lit(a), _col(text), F.lit(b), _col(label).cast("string"), F.lit(c))


def classification_prompt(text: str | Column, few_shot: Column | None = None) -> Column:
    """Instruction blocks, the examples block when ``few_shot`` is a non-empty string,
    then the item. ``few_shot`` is the concatenation of ``few_shot_line`` values."""
    head = F.lit(prompt_header())
    if few_shot is not None:
        fs = F.coalesce(few_shot, F.lit(""))
        head = F.concat(head, F.when(fs != "", F.concat(F.lit(fixed.PROMPT_EXAMPLES_HEADER), fs))
                        .otherwise(F.lit("")))
    a, b = fixed.PROMPT_ITEM_FORMAT
    return F.concat(head, F.lit(a), _col(text), F.lit(b))


def _json_string(c: Column) -> Column:
    # to_json of a one-element array yields ["..."] with JSON escaping; keep the quoted value
    return F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")


# T14
def json_generation_prompt(emotion: str | Column) -> Column:
    """``{"instruction": ..., "emotion": ..., "notice": ...}`` with ``", "`` and ``": "``
    separators, as a default ``json.dumps`` writes it (non-ASCII is not escaped)."""
    return F.concat(
        F.lit('{"instruction": "' + fixed.GENERATION_INSTRUCTION + '", "emotion": '),
        _json_string(_col(emotion)),
        F.lit(', "notice": "' + fixed.GENERATION_NOTICE + '"}'),
    )


# T15
def plain_generation_prompt(cls: str | Column) -> Column:
    return F.format_string(fixed.PLAIN_GENERATION_FORMAT, _col(cls))


def argmax(scores: str | Column) -> Column:
    """0-based index of the first maximum of an array."""
    s = _col(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")

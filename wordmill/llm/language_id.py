"""Language identification with a string kernel (operator 8).

A text's features are the byte n-grams of 1 to 4 bytes that occur in it (a blended
spectrum, presence only), hashed into ``DIMS`` dimensions; A-Z are lower-cased and
everything else below 0x80 but a-z counts as one blank. The kernel of two texts is the
number of shared features over the geometric mean of their numbers. Landmark texts give
a Nyström approximation, in which one kernel ridge regression per language is solved.
Texts are taken in segments of ``SEGMENT`` bytes, so that a passage in another language
counts by its length; blocks of segments are scored by one matrix product with the
landmarks and one with the regression weights, and a text's scores are the mean of its
segments' weighted by length.

Training takes at most ``per_lang`` documents of each language (the first by a hash of
the id): that bounds the driver's memory. Whole texts are used and all documents are
scored. Null texts and texts without a letter are ``und`` with score 0, as is everything
if there is nothing to learn from. Ties go to the first language in order of name.
Repeated rows give repeated results; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm import textbytes as B

DIMS = 1 << 12
ORDERS = (1, 2, 3, 4)
#: Documents of each language that training may use, and how many of them are landmarks.
PER_LANG = 300
LANDMARKS = 24
#: Bytes of text that are one row of the kernel.
SEGMENT = 512
RIDGE = 0.1
#: Segments of one matrix product.
ROWS = 512
UNKNOWN = "und"
#: A text is strange if clearly fewer of its trigrams are known than ``TRUST`` times the share
#: that all but ``OUTLIERS`` of unseen training texts reach.
TRUST, OUTLIERS = 0.8, 0.02
SALTS = 64

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_ASCII_LETTER = B.byte_set((0x41, 0x5A), (0x61, 0x7A))


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    landmarks: np.ndarray  # DIMS x m, each column divided by the root of its number of features
    weights: np.ndarray    # m x languages
    known: np.ndarray      # a bit for every trigram of folded bytes: seen in a training text
    limit: float           # least share of known trigrams


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Binary features of a block of texts, one row each."""
    n = len(offsets) - 1
    out = np.zeros(n * DIMS, np.float32)
    row = np.repeat(np.arange(n, dtype=np.uint32) * np.uint32(DIMS), np.diff(offsets))
    folded = _FOLD[data].astype(np.uint32)
    gram = np.zeros(len(folded), np.uint32)
    for k in range(1, max(ORDERS) + 1):
        m = len(folded) - k + 1
        if m <= 0:
            break
        gram = gram[:m] << np.uint32(8)
        gram |= folded[k - 1:]
        if k in ORDERS:
            h = (gram * np.uint32(0x9E3779B1) + np.uint32(k * 0x05EBCA6B)) * np.uint32(0xC2B2AE35)
            h >>= np.uint32(32 - DIMS.bit_length() + 1)
            at = row[:m] + h
            out[at[row[:m] == row[k - 1:]]] = 1.0
    return out.reshape(n, DIMS)


def segments(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the segments of consecutive texts, and each text's first segment; an
    empty text is one empty segment."""
    length = np.diff(offsets)
    count = np.maximum(-(-length // SEGMENT), 1)
    first = np.cumsum(count) - count
    inner = np.arange(int(count.sum())) - np.repeat(first, count)
    return np.append(np.repeat(offsets[:-1], count) + inner * SEGMENT, offsets[-1]), first


def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    size = np.maximum(np.sqrt(x.sum(axis=1, keepdims=True)), 1.0)
    return (x @ landmarks) / size


def kernel_rows(data: np.ndarray, offsets: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Kernel of every segment with every landmark, a bounded block at a time."""
    return np.concatenate([
        kernel(presence(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]), landmarks)
        for a in range(0, len(offsets) - 1, ROWS) for b in (min(a + ROWS, len(offsets) - 1),)])


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(text, trigram)`` of all places with at least two letters, within texts."""
    f = _FOLD[data].astype(np.uint32)
    if len(f) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    gram = (f[:-2] << np.uint32(16)) | (f[1:-1] << np.uint32(8)) | f[2:]
    letter = (f != 0x20).astype(np.int8)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero((letter[:-2] + letter[1:-1] + letter[2:] >= 2) & (row[:-2] == row[2:]))
    return row[at], gram[at]


def known_share(data: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of each text's trigrams that are known (1 if it has none), and their number."""
    row, gram = _trigrams(data, offsets)
    n = np.bincount(row, minlength=len(offsets) - 1)
    hit = (known[gram >> np.uint32(3)] >> (gram & np.uint32(7)).astype(np.uint8)) & np.uint8(1)
    return np.where(n > 0, np.bincount(row, hit, len(offsets) - 1) / np.maximum(n, 1), 1.0), n


def _known_of(texts: Sequence[str]) -> np.ndarray:
    seen = np.zeros(1 << 24, bool)
    for _, _, data, offsets in B.blocks(pa.array(list(texts), pa.string())):
        seen[_trigrams(data, offsets)[1]] = True
    return np.packbits(seen, bitorder="little")


def _limit(texts: Sequence[str]) -> float:
    """From every second text's share of the trigrams of the others."""
    known, shares = _known_of(texts[::2]), []
    for _, _, data, offsets in B.blocks(pa.array(list(texts[1::2]), pa.string())):
        share, n = known_share(data, offsets, known)
        shares += share[n >= 100].tolist()
    return TRUST * float(np.quantile(shares, OUTLIERS)) if shares else 0.0


def strange(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Texts that are in none of the learned languages: their share of known trigrams is
    below the limit by more than three deviations of a text of that length."""
    share, n = known_share(data, offsets, model.known)
    return share + 1.5 / np.sqrt(np.maximum(n, 1)) < model.limit


def fit_texts(texts: Sequence[str], langs: Sequence[str]) -> Model | None:
    names = tuple(sorted(set(langs)))
    if not names:
        return None
    label = np.array([names.index(v) for v in langs])
    # the first segment of each language's first texts is a landmark
    chosen = np.concatenate([np.flatnonzero(label == i)[:LANDMARKS] for i in range(len(names))])
    marks = np.concatenate([presence(d[:SEGMENT], np.array([0, min(len(d), SEGMENT)])) for d in
                            (np.frombuffer(texts[i].encode(), np.uint8) for i in chosen)])
    marks = (marks / np.maximum(np.sqrt(marks.sum(axis=1, keepdims=True)), 1.0)).T.copy()
    rows, y, weight = [], [], []
    for a, b, data, offsets in B.blocks(pa.array(list(texts), pa.string())):
        cuts, first = segments(offsets)
        rows.append(kernel_rows(data, cuts, marks))
        y.append(np.repeat(label[a:b], np.diff(np.append(first, len(cuts) - 1))))
        weight.append(np.diff(cuts))
    k_xm, y, weight = np.concatenate(rows).astype(np.float64), np.concatenate(y), np.concatenate(weight).astype(float)
    total = np.bincount(y, weight, minlength=len(names))
    weight = weight / np.maximum(total, 1.0)[y] * len(y) / len(names)  # every language counts alike
    k_mm = (marks.T @ marks).astype(np.float64)
    value, vector = np.linalg.eigh(k_mm)
    keep = value > 1e-6 * max(value.max(), 1e-12)
    half = vector[:, keep] / np.sqrt(value[keep])
    z = k_xm @ half
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    gram = (z * weight[:, None]).T @ z + RIDGE * np.eye(z.shape[1])
    beta = np.linalg.solve(gram, (z * weight[:, None]).T @ target)
    return Model(names, marks.astype(np.float32), (half @ beta).astype(np.float32), _known_of(texts), _limit(texts))


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = B.sums(_ASCII_LETTER[data], offsets) > 0
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)).tolist():
        out[i] = any(map(str.isalpha, data[offsets[i]:offsets[i + 1]].tobytes().decode()))
    return out


def _score_batches(model: Model | None, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in B.blocks(batch.columns[-1], 1 << 20):
                part = batch.slice(row, end - row)
                known = _has_letter(data, offsets) & (model is not None)
                lang, score = np.full(len(known), UNKNOWN, object), np.zeros(len(known))
                if known.any():
                    cuts, first = segments(offsets)
                    length = np.diff(cuts).astype(float)
                    f = (kernel_rows(data, cuts, model.landmarks) @ model.weights) * length[:, None]
                    f = np.add.reduceat(f, first) / np.maximum(np.add.reduceat(length, first), 1.0)[:, None]
                    best = f.argmax(axis=1)
                    lang[known] = np.array(model.langs, object)[best][known]
                    score[known] = np.clip((f.max(axis=1) + 1.0) / 2.0, 0.0, 1.0)[known]
                out = [pa.array(lang.tolist(), pa.string()), pa.array(score)]
                if len(names) > 2:
                    out.append(pa.array(strange(data, offsets, model) if model is not None else np.ones(len(known), bool)))
                yield pa.RecordBatch.from_arrays([*part.columns, *out], [*part.schema.names, *names])
    return run


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, usable: Column | None = None, per_lang: int = PER_LANG) -> Model | None:
    """Train from rows with a language that satisfy ``usable``. The ids are picked first
    (no text is read or shuffled for that); their rows are then found by a broadcast
    of at most ``per_lang`` ids per language."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    good = F.lit(True) if usable is None else usable
    # first within shares of a language, so that no task ranks a whole one
    picked = ids.filter(good & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).withColumn(
        "salt", F.pmod(F.xxhash64(F.lit(8), "doc_id"), F.lit(SALTS)))
    for keys in (["lang", "salt"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")
        picked = picked.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= per_lang)
    wanted = picked.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
            .filter(F.col("text").rlike(r"\p{L}")).orderBy(F.xxhash64("doc_id"), "doc_id").collect())
    return fit_texts([r["text"] for r in rows], [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model | None, keep: Sequence[str] = ("doc_id",), pred_name: str = "lang_pred",
            score_name: str = "score", strange_name: str | None = None) -> DataFrame:
    """``keep`` columns, the text, the predicted language and its score of every
    document, in columns with names that are none of them. ``strange_name`` adds whether
    the text is in none of the learned languages (see ``strange``; all are, without a model)."""
    rows = docs.select(*[f"`{c}`" for c in keep], F.col("text").cast("string").alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    names = [pred_name, score_name, *([strange_name] if strange_name else [])]
    return rows.mapInArrow(_score_batches(model, names), f"{fields}, {pred_name} string, {score_name} double"
                           + (f", {strange_name} boolean" if strange_name else ""))


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``, trained on those that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, fit(docs, ~held_out())).select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")

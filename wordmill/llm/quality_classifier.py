"""Compression classifier for text quality (operator 9).

A zstandard dictionary is built from good labelled texts and one from bad ones. A text
that resembles the good ones gets smaller with the good dictionary, so the difference
of the two compressed sizes, normalised, says which side it is on. A logistic
calibration on labelled texts that the dictionaries have not seen turns it, together
with how far the text shrinks by itself, into a score from 0 to 1.

Training takes at most ``per_class`` labelled documents of each class (the first by a
hash of the id), so what the driver holds is bounded; whole texts are used, and every
document is scored. A document with several labels counts with its lowest one. Empty
and null texts score 0. Without labels of both classes every other text scores 0.5.
Repeated rows give repeated results; extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each class that training may use.
PER_CLASS = 1_000
DICT_BYTES = 65_536
LEVEL = 3
#: Bytes of text that are compressed together.
SEGMENT = 1_024
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the intercept

    @property
    def usable(self) -> bool:
        return len(self.weights) > 0


UNFITTED = Model(b"", b"", np.zeros(0), np.zeros(0), np.zeros(0))


def _dictionary(texts: Sequence[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train."""
    try:
        return zstandard.train_dictionary(size, list(texts)).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[:size]


class Sizes:
    """Compressed sizes of a text by itself and with either dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        self.with_dict = []
        for body in (good, bad):
            d = zstandard.ZstdCompressionDict(body)
            d.precompute_compress(level=LEVEL)
            self.with_dict.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False,
                                                           write_checksum=False, write_dict_id=False))

    def features(self, texts: Sequence[bytes]) -> np.ndarray:
        """Every text is compressed in segments of ``SEGMENT`` bytes, each on its own, so
        that the dictionaries weigh as much at the end of a long text as at its start."""
        segments, first = [], [0]
        for t in texts:
            segments += [t[i:i + SEGMENT] for i in range(0, max(len(t), 1), SEGMENT)]
            first.append(len(segments))
        sizes = np.array([[len(c.compress(s)) for c in (self.plain, *self.with_dict)] if s else [1, 1, 1]
                          for s in segments], float).reshape(-1, 3)
        starts = np.array(first[:-1], np.int64)
        if not len(starts):
            return np.zeros((0, 9))
        length = np.maximum(np.fromiter(map(len, texts), float, len(texts)), 1.0)
        seg_length = np.fromiter(map(len, segments), float, len(segments))
        seg_gap = (sizes[:, 2] - sizes[:, 1]) / np.maximum(np.minimum(sizes[:, 1], sizes[:, 2]), 1.0)
        plain, good, bad = np.add.reduceat(sizes, starts).T
        gap = (bad - good) / np.maximum(np.minimum(good, bad), 1.0)
        # a short last segment says little by itself
        worst = np.minimum.reduceat(np.where(seg_length >= SEGMENT // 4, seg_gap, 9.0), starts)
        worst = np.where(worst > 8.0, gap, worst)
        ratio = np.log(plain / length)
        best = np.log(np.minimum(good, bad) / length)
        return np.stack([gap, worst, ratio, best, gap * ratio, ratio * ratio, gap * np.abs(gap), np.log(length),
                         worst * np.abs(worst)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton steps; the intercept is last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 0.0
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_texts(texts: Sequence[bytes], labels: Sequence[int]) -> Model:
    """Dictionaries from every other text of each class, calibration on the rest,
    both classes with equal weight."""
    sides: dict[int, list[bytes]] = {0: [], 1: []}
    for t, y in zip(texts, labels):
        if t:
            sides[int(y)].append(t)
    if min(map(len, sides.values())) < 4:
        return UNFITTED
    good, bad = (_dictionary(sides[y][::2]) for y in (1, 0))
    rest = {y: sides[y][1::2] for y in (0, 1)}
    x = Sizes(good, bad).features(rest[0] + rest[1])
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    w = _logistic((x - mean) / scale, y)
    w[-1] -= np.log(len(rest[1]) / len(rest[0]))
    return Model(good, bad, mean, scale, w)


def score_texts(model: Model, sizes: Sizes | None, texts: Sequence[bytes]) -> np.ndarray:
    if not model.usable or sizes is None:
        return np.array([0.5 if t else 0.0 for t in texts])
    x = (sizes.features(texts) - model.mean) / model.scale
    score = 1.0 / (1.0 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))
    score[[not t for t in texts]] = 0.0
    return score


def _score_batches(model: Model, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good, model.bad) if model.usable else None
        for batch in batches:
            for i in range(0, batch.num_rows, 128):
                part = batch.slice(i, 128)
                texts = [(v.as_buffer() or b"") if v.is_valid else b"" for v in part.column(part.num_columns - 1).cast(pa.binary())]
                texts = [t.to_pybytes() if t else b"" for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score_texts(model, sizes, texts))],
                                                 [*part.schema.names, name])
    return run


def _label_rows(labels: DataFrame, usable: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` ids of each class."""
    one = (labels.filter(usable & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [one.filter(F.col("quality") == q).orderBy(*order).limit(per_class) for q in (0, 1)]
    return picked[0].unionByName(picked[1])


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, per_class: int = PER_CLASS) -> Model:
    """Train from the labelled rows that satisfy ``usable``. The driver holds at most
    ``2 * per_class`` texts; the id list that is broadcast has as many rows."""
    ids = F.broadcast(_label_rows(labels, F.lit(True) if usable is None else usable, per_class))
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(ids, "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").collect())
    return fit_texts([(r["text"] or "").encode() for r in texts], [r["quality"] for r in texts])


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), name: str = "score") -> DataFrame:
    """``keep`` columns, the text and the score of every document, in a column ``name``
    that is none of them: one narrow pass."""
    rows = docs.select(*[f"`{c}`" for c in keep], F.col("text").cast("string").alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_score_batches(model, name), f"{fields}, {name} double")


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``, trained on the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out())
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Toxicity by nearest labelled examples (operator 11).

Texts are compared by the exact cosine of TF-IDF vectors with the labelled examples that
are most like them; the examples' labels vote, weighted by distance, and a logistic
calibration turns the vote into a score. The nearest examples and the terms that decide
are returned as evidence.

**Terms.** A text is lower-cased (A-Z) and cut into words of digits, letters and other
non-ASCII characters. Terms are the words (their first ``WORD_CHARS`` characters) and,
as inflected and disguised forms share a stem, the first 4, 5 and 6 characters of longer
words, written ``stem*``. A vector holds the terms whose document frequencies differ
between the two classes of examples by more than chance (log-likelihood ratio of at least
``MIN_G2``): all other words would only measure topic. Document frequencies for the idf
are counted over all documents.

**Index.** Postings of a term are sorted by example and cut into blocks of ``BLOCK``
examples with the largest weight of each. A search bounds every block by the sum of the
block maxima, takes the blocks in descending order of that bound, scores them exactly in
steps of 4, 8, 16, ... blocks (an array pass over all postings of a step), and ends when no
bound reaches the K-th best cosine. The result is exact; ties go to the smaller id.

Training takes at most ``per_class`` labelled documents of each class (the first by a hash
of the id) and at most ``MAX_TERMS`` terms of bounded length, so the index, which every
task holds, is bounded. Every document is scored by its text alone, in one narrow pass.

A document with several labels counts with its highest. Null and empty texts, and texts
without any term of the index, have no neighbours and get the score that the labelled
texts without neighbours call for. Without labels of both classes every score is 0.
Repeated rows give repeated results; rows without an id are scored like any other; extra
columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm import textbytes as B
from wordmill.llm.quality_classifier import _logistic

#: Labelled documents of each class that training may use.
PER_CLASS = 2_000
#: Terms of the vectors, at most; and how far the classes must differ in a term's use.
MAX_TERMS = 20_000
MIN_G2 = 20.0
WORD_CHARS = 32
STEMS = (4, 5, 6)
BLOCK = 64
FIRST_BLOCKS = 4
K = 10
THRESHOLD = 0.5

_STEM_SALT = np.uint64(0xA24BAED4963EE407)


def _term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """``(starts, rows, kinds)``: the words of a block of lower-cased texts, and per kind of
    term (words, then each stem length) the words that have it and where it ends."""
    starts, ends, first = B.spans(data, offsets, B.NOT_WORD)
    # places of characters: a term never ends inside one
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    at = np.searchsorted(chars, starts)
    chars = np.concatenate([chars, np.full(WORD_CHARS + 1, len(data))])
    kinds = [(np.arange(len(starts)), np.minimum(chars[at + WORD_CHARS], ends))]
    for n in STEMS:
        end = chars[at + n]
        longer = np.flatnonzero(end < ends)
        kinds.append((longer, end[longer]))
    return starts, B.row_of(first), kinds


def term_hash(term: str) -> int:
    """The key of a term; that of ``stem*`` differs from that of the word ``stem``."""
    body = term.removesuffix("*").encode()
    h = B.span_hashes(np.frombuffer(body, np.uint8), np.array([0]), np.array([len(body)]))[0]
    return int(h ^ _STEM_SALT) if term.endswith("*") else int(h)


def texts_terms(texts: Sequence[str | None]) -> list[set[str]]:
    """The distinct terms of every text, as strings."""
    out: list[set[str]] = [set() for _ in texts]
    for row, _, data, offsets in B.blocks(pa.array(texts, pa.string())):
        data = B.lower_ascii(data)
        raw = data.tobytes()
        starts, rows, kinds = _term_spans(data, offsets)
        for kind, (word, end) in enumerate(kinds):
            tail = "*" if kind else ""
            for r, a, b in zip(rows[word].tolist(), starts[word].tolist(), end.tolist()):
                out[row + r].add(raw[a:b].decode() + tail)
    return out


class Terms:
    """Counts the terms of a vocabulary in blocks of texts."""

    def __init__(self, terms: Sequence[str]):
        keys = np.array([term_hash(t) for t in terms], np.uint64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.n = len(terms)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, term, count)`` of a block, by row, then term."""
        data = B.lower_ascii(data)
        starts, rows, kinds = _term_spans(data, offsets)
        hashes, found = B.span_hasher(data), []
        for kind, (word, end) in enumerate(kinds):
            h = hashes(starts[word], end)
            if kind:
                h = h ^ _STEM_SALT
            place = np.minimum(np.searchsorted(self.keys, h), max(self.n - 1, 0))
            hit = np.flatnonzero(self.keys[place] == h) if self.n else np.zeros(0, np.int64)
            found.append(rows[word[hit]] * np.int64(max(self.n, 1)) + self.order[place[hit]])
        cells, count = np.unique(np.concatenate(found), return_counts=True)
        return cells // max(self.n, 1), cells % max(self.n, 1), count


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers ``first[i] .. last[i] - 1`` of every ``i``, one after another."""
    size = last - first
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


@dataclass(frozen=True)
class Index:
    """Unit vectors of the examples as blocked postings. ``vec_*`` hold them by example."""

    n_terms: int
    ids: np.ndarray
    toxic: np.ndarray
    idf: np.ndarray
    post_first: np.ndarray     # postings of term t: post_first[t] .. post_first[t + 1]
    post_example: np.ndarray
    post_weight: np.ndarray
    block_first: np.ndarray    # blocks of term t, each with its postings and largest weight
    block_id: np.ndarray
    block_start: np.ndarray
    block_max: np.ndarray

    def unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1.0 + np.log(counts)) * self.idf[terms]
        norm = math.sqrt(float(w @ w))
        return w / norm if norm > 0 else w

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = K, but: int = -1) -> list[tuple[float, int]]:
        """The ``k`` examples of largest cosine with a unit vector, ``(cosine, example)`` by
        cosine, then id; without those of cosine 0 and example ``but``."""
        n_blocks = -(-len(self.ids) // BLOCK)
        first, last = self.block_first[terms], self.block_first[terms + 1]
        entries, entry_weight = _ranges(first, last), np.repeat(weights, last - first)
        of = self.block_id[entries]
        bound = np.bincount(of, entry_weight * self.block_max[entries], n_blocks)
        order = np.argsort(-bound, kind="stable")[:np.count_nonzero(bound > 0)]
        scores, met, least, done = np.zeros(len(self.ids)), np.zeros(0, np.int64), -1.0, 0
        while done < len(order):
            # blocks that can still reach, in steps that double; all terms of a step at once
            step = order[done:2 * done + FIRST_BLOCKS]
            step = step[bound[step] + 1e-9 >= least]
            if not len(step):
                break
            done = 2 * done + FIRST_BLOCKS
            chosen = np.zeros(n_blocks, bool)
            chosen[step] = True
            of_step = chosen[of]
            some = entries[of_step]
            start, end = self.block_start[some], self.block_start[some + 1]
            at = _ranges(start, end)
            scores += np.bincount(self.post_example[at], np.repeat(entry_weight[of_step], end - start) * self.post_weight[at], len(scores))
            met = np.flatnonzero(scores > 0)
            if 0 <= but < len(scores):
                met = met[met != but]
            if len(met) > k:
                # rounding may swap scores this close, so they stay
                least = np.partition(scores[met], len(met) - k)[len(met) - k]
                met = met[scores[met] >= least - 1e-11]
        values, place = np.unique(scores[met], return_inverse=True)
        rounded = np.array([round(v, 12) for v in values.tolist()])[place]
        return [(float(rounded[j]), int(met[j])) for j in np.lexsort((met, self.ids[met], -rounded))[:k]]

    def vote(self, near: Sequence[tuple[float, int]]) -> list[float]:
        """What the calibration sees: the vote from -1 to 1, weighted by nearness, the same
        times the best cosine, and whether there is any neighbour."""
        if not near:
            return [0.0, 0.0, 0.0]
        w = [1.0 / (math.sqrt(max(2.0 - 2.0 * s, 0.0)) + 0.05) for s, _ in near]
        vote = sum(x * (2 * int(self.toxic[e]) - 1) for x, (_, e) in zip(w, near)) / sum(w)
        return [vote, vote * near[0][0], 1.0]


def build_index(ids: Sequence[int], toxic: Sequence[int], vectors: Sequence[tuple[Sequence[int], Sequence[int]]],
                idf: np.ndarray) -> Index:
    """``vectors`` are (terms, counts) of each example; examples are laid out by label and
    id, so that a block's examples use the same terms and its maxima are tight."""
    order = sorted(range(len(ids)), key=lambda i: (toxic[i], list(vectors[i][0])[:1], ids[i]))
    n_terms = len(idf)
    cells: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for place, i in enumerate(order):
        terms, counts = np.asarray(vectors[i][0], np.int64), np.asarray(vectors[i][1], float)
        w = (1.0 + np.log(counts)) * idf[terms]
        norm = math.sqrt(float(w @ w))
        cells.append((terms, np.full(len(terms), place), w / norm if norm > 0 else w))
    t, e, w = (np.concatenate([c[j] for c in cells]) if cells else np.zeros(0) for j in range(3))
    by = np.lexsort((e, t))
    t, e, w = t[by].astype(np.int64), e[by].astype(np.int64), w[by].astype(float)
    key = t * np.int64(-(-len(order) // BLOCK) + 1) + e // BLOCK
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return Index(n_terms, np.array([ids[i] for i in order], np.int64), np.array([toxic[i] for i in order], np.int64), idf,
                 np.searchsorted(t, np.arange(n_terms + 1)), e, w, np.searchsorted(t[heads], np.arange(n_terms + 1)),
                 e[heads] // BLOCK, np.concatenate([heads, [len(t)]]).astype(np.int64),
                 np.maximum.reduceat(w, heads) if len(heads) else np.zeros(0))


@dataclass(frozen=True)
class Model:
    terms: list[str] = field(default_factory=list)
    index: Index | None = None
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))  # of the vote; the last is the intercept

    def score(self, vote: Sequence[float]) -> float:
        z = float(np.dot(self.weights[:-1], vote) + self.weights[-1])
        return 1.0 / (1.0 + math.exp(-min(max(z, -30.0), 30.0)))


UNFITTED = Model()


def g2(a: float, n_a: float, b: float, n_b: float) -> float:
    """Log-likelihood ratio of a term in ``a`` of ``n_a`` texts and ``b`` of ``n_b``."""
    def part(k: float, n: float, p: float) -> float:
        return (k * math.log(k / (n * p)) if k else 0.0) + ((n - k) * math.log((n - k) / (n * (1 - p))) if n > k else 0.0)
    p = (a + b) / (n_a + n_b)
    return 2.0 * (part(a, n_a, p) + part(b, n_b, p)) if 0 < p < 1 else 0.0


def _g2_column(a: Column, n_a: int, b: Column, n_b: int) -> Column:
    p = (a + b) / F.lit(float(n_a + n_b))

    def part(k: Column, n: int, share: Column) -> Column:
        return F.when(k > 0, k * F.log(k / (share * float(n)))).otherwise(0.0)
    inside = part(a, n_a, p) + part(n_a - a, n_a, 1 - p) + part(b, n_b, p) + part(n_b - b, n_b, 1 - p)
    return F.when((a + b > 0) & (a + b < n_a + n_b), 2.0 * inside).otherwise(0.0)


def _label_rows(labels: DataFrame, usable: Column) -> DataFrame:
    """One row per labelled id: ``(doc_id, toxic)``."""
    return (labels.filter(usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic")))


def _terms_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            part = batch.slice(i, 64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([sorted(t) for t in texts_terms(part.column(1).to_pylist())], pa.list_(pa.string()))],
                ["toxic", "terms"])


def _vectors_of_batches(terms: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Terms(terms)
        for batch in batches:
            for row, end, data, offsets in B.blocks(batch.column(batch.num_columns - 1)):
                r, t, n = counter.counts(data, offsets)
                cut = np.searchsorted(r, np.arange(end - row + 1)).astype(np.int32)
                part = batch.slice(row, end - row)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.ListArray.from_arrays(cut, pa.array(t, pa.int64())),
                     pa.ListArray.from_arrays(cut, pa.array(n, pa.int64()))], [*part.schema.names[:-1], "terms", "counts"])
    return run


def _frequencies_of_batches(terms: Sequence[str]):
    """Documents with each term, one count per partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, df, rows = Terms(terms), np.zeros(len(terms) + 1, np.int64), 0
        for batch in batches:
            for row, end, data, offsets in B.blocks(batch.column(0)):
                df[:-1] += np.bincount(counter.counts(data, offsets)[1], minlength=len(terms))
                rows += end - row
        df[-1] = rows  # the last place counts the texts
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some])], ["term", "df"])
    return run


def _text(docs: DataFrame) -> Column:
    return F.col("text").cast("string").alias("text")


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, per_class: int = PER_CLASS) -> Model:
    """Learn from the labelled rows that satisfy ``usable``. The driver holds the terms and
    the vectors of at most ``2 * per_class`` examples, no text."""
    known = _label_rows(labels, F.lit(True) if usable is None else usable).join(
        docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = known.filter("toxic = 0").orderBy(*order).limit(per_class).unionByName(
        known.filter("toxic = 1").orderBy(*order).limit(per_class))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return UNFITTED
    few = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text(docs)).join(F.broadcast(ids), "doc_id")
           .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).checkpoint())
    n = {y: min(totals[y], per_class) for y in (0, 1)}
    found = few.select("toxic", "text").mapInArrow(_terms_of_batches, "toxic int, terms array<string>")
    use = (found.select("toxic", F.explode("terms").alias("term")).groupBy("term")
           .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
           .withColumn("g2", _g2_column(F.col("a"), n[1], F.col("b"), n[0])).filter(F.col("g2") >= MIN_G2))
    terms = sorted(r["term"] for r in use.orderBy(F.desc("g2"), "term").limit(MAX_TERMS).collect())
    df = {r["term"]: r["df"] for r in docs.select(_text(docs)).mapInArrow(_frequencies_of_batches(terms), "term long, df long")
          .groupBy("term").agg(F.sum("df").alias("df")).collect()}
    n_docs = df.get(len(terms), 0)
    idf = np.array([math.log((1 + n_docs) / (1 + df.get(i, 0))) + 1.0 for i in range(len(terms))])
    rows = few.select("doc_id", "toxic", "text").mapInArrow(
        _vectors_of_batches(terms), "doc_id long, toxic int, terms array<bigint>, counts array<bigint>").collect()
    rows.sort(key=lambda r: r["doc_id"])
    index = build_index([r["doc_id"] for r in rows], [r["toxic"] for r in rows],
                        [(r["terms"], r["counts"]) for r in rows], idf)
    place = {int(d): i for i, d in enumerate(index.ids)}
    seen = []
    for r in rows:  # every example is judged by the others
        t, c = np.asarray(r["terms"], np.int64), np.asarray(r["counts"], float)
        seen.append(index.vote(index.nearest(t, index.unit(t, c), but=place[r["doc_id"]])))
    y = np.array([float(r["toxic"]) for r in rows])
    w = _logistic(np.array(seen).reshape(-1, 3), y)
    w[-1] += math.log(totals[1] / totals[0]) - math.log(max(y.sum(), 1.0) / max(len(y) - y.sum(), 1.0))
    return Model(terms, index, w)


def _score_batches(model: Model, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, counter = model.index, Terms(model.terms)
        kept: dict[bytes, tuple] = {}
        none = model.score([0.0, 0.0, 0.0]) if index is not None else 0.0

        def judged(t: np.ndarray, n: np.ndarray) -> tuple:
            key = t.tobytes() + n.tobytes()
            if key not in kept:
                if len(kept) > 10_000:
                    kept.clear()
                w = index.unit(t, n)
                near = index.nearest(t, w)
                top = [model.terms[i] for i in t[np.argsort(-w, kind="stable")[:5]]]
                kept[key] = (model.score(index.vote(near)), [int(index.ids[x]) for _, x in near], [s for s, _ in near],
                             [int(index.toxic[x]) for _, x in near], top)
            return kept[key]

        for batch in batches:
            for row, end, data, offsets in B.blocks(batch.column(batch.num_columns - 1)):
                r, t, n = counter.counts(data, offsets)
                cut = np.searchsorted(r, np.arange(end - row + 1)).tolist()
                out = [judged(t[a:b], n[a:b]) if b > a else (none, [], [], [], []) for a, b in zip(cut, cut[1:])]
                part = batch.slice(row, end - row)
                kinds = [pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *[pa.array([x[j] for x in out], k) for j, k in enumerate(kinds)]],
                                                 [*part.schema.names[:-1], *names])
    return run


def score(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), name: str = "score") -> DataFrame:
    """``keep`` columns, the score in a column ``name`` that is none of them, and the
    evidence: ``name_near`` (ids of the nearest examples), ``name_cosine``, ``name_label`` and
    ``name_terms`` (the terms with most weight)."""
    rows = docs.select(*[f"`{c}`" for c in keep], F.col("text").cast("string").alias(f"{name}_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    names = [name, f"{name}_near", f"{name}_cosine", f"{name}_label", f"{name}_terms"]
    kinds = ["double", "array<bigint>", "array<double>", "array<int>", "array<string>"]
    return rows.mapInArrow(_score_batches(model, names), ", ".join([fields, *[f"`{c}` {k}" for c, k in zip(names, kinds)]]))


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def op11_toxicity(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``, learned from the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out())
    return score(docs, model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                                     F.col("score_near").alias("near"), F.col("score_cosine").alias("near_cosine"),
                                     F.col("score_label").alias("near_toxic"), F.col("score_terms").alias("terms"))

"""Hard-negative mining by cover trees over norm-augmented vectors (operator 13).

For every anchor, its positives are the rows of its label with the largest inner product;
for every positive, its hard negatives are the rows of other labels with the largest inner
product inside a window below the positive's score. Components are integers
(``floor(256 x)``), so all scores are exact.

**Augmentation.** A candidate ``x`` gets one more component ``sqrt(M^2 - |x|^2)`` (``M`` the
largest norm of its tree), an anchor ``q`` gets 0: all candidates then lie on a sphere, inner
products stay as they are, and ``2 q.x = |q|^2 + M^2 - d(q, x)^2``. A ball of candidates
around a centre ``c`` with radius ``r`` has distances between ``d(q, c) - r`` and
``d(q, c) + r``, which bounds its inner products from both sides.

**Tree.** Rows are dealt by a hash into blocks of about ``ROWS``. One task builds the cover
tree of a block: from a centre, the covering radius shrinks by ``SHRINK`` a level; points
are covered by the first of the next level's centres that is near enough, centres are
further apart than that radius. A node keeps the largest distance that occurs under it, and
the label if there is but one. Equal vectors end in one node of radius 0. Children of a node
are stored side by side, so that one matrix product gives the scores of all of them.

**Search.** A best-first descent takes the node with the largest bound, scores its children
at once, verifies single points exactly and queues the others. It skips nodes whose bounds
lie outside every window, nodes of a single label that cannot answer, and ends when no bound
reaches the k-th score found. The k best of an anchor are carried from tree to tree inside a
task.

**In Spark.** Trees (one row each) are written once and used for both searches. Anchors
travel in chunks of ``CHUNK``; every tree meets every chunk, a stated query set against all
rows in blocks, through an equi-join on (chunk, share of the trees). The chunks are broadcast
if their measured size allows, else shuffled. A task returns k rows per anchor, or per
positive, and a ranked window with a partial limit merges them.

Rows with a null id, label or vector, or with a null or non-finite component, take no part.
Shorter vectors count as filled up with zeros. Of several rows with one id the smallest by
label, then vector, takes part (repeated rows count once). Ties go to the smaller id. Extra
columns are ignored, empty tables give empty results. Components of up to 2^20 keep scores
exact in 64-bit floats for a thousand dimensions."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.session import MAX_BROADCAST_BYTES, cut_lineage, scratch_path, spread

#: Rows of a tree and anchors of a chunk, on average.
ROWS = 2_048
CHUNK = 1_024
#: A level's covering radius, as a share of the level above; points of a node that is not
#: split further.
SHRINK = 0.5
LEAF = 16
#: Anchors whose best rows a task carries from tree to tree; beyond it they are sent out.
HELD = 200_000
#: Tasks over which the trees that meet one shuffled chunk are dealt.
SHARES = 32

POSITIVES, NEGATIVES = 5, 3
EVERY, RELABEL, LABELS, SCALE = 50, 7, 10, 256


@dataclass(frozen=True)
class Tree:
    """Nodes in order of levels; the children of node i are ``first[i]:first[i] + count[i]``.
    A node without children is a single point, ``row`` of the block."""

    ids: np.ndarray
    labels: np.ndarray
    points: np.ndarray
    norm: float               # M
    row: np.ndarray           # the centre of each node
    radius: np.ndarray
    first: np.ndarray
    count: np.ndarray
    only: np.ndarray          # 1 if all points under the node share the centre's label


def build_tree(ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> Tree:
    """The cover tree of a block of at least one row. Rows are taken by id."""
    order = np.argsort(ids, kind="stable")
    ids, labels, points = ids[order], labels[order], points[order].astype(float)
    square = np.einsum("ij,ij->i", points, points)
    top = float(square.max())
    full = np.hstack([points, np.sqrt(np.maximum(top - square, 0.0))[:, None]])

    row, radius, first, count, only, under = [0], [0.0], [0], [0], [0], [np.arange(len(ids))]
    node = 0
    while node < len(row):
        center, some = row[node], under[node]
        under[node] = np.zeros(0, np.int64)
        only[node] = int((labels[some] == labels[center]).all())
        if len(some) > 1:
            gap = full[some] - full[center]
            dist = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            radius[node] = float(dist.max())
            groups = _cover(center, some, full[some], dist, radius[node])
            first[node], count[node] = len(row), len(groups)
            for c, g in groups:
                row.append(c)
                under.append(g)
                radius.append(0.0)
                first.append(0)
                count.append(0)
                only.append(0)
        node += 1
    return Tree(ids, labels, points, float(np.sqrt(top)), np.array(row), np.array(radius), np.array(first), np.array(count),
                np.array(only))


def _cover(center: int, some: np.ndarray, full: np.ndarray, dist: np.ndarray, radius: float) -> list[tuple[int, np.ndarray]]:
    """The children of a node: ``(centre, points)``. ``full`` are the vectors of ``some``."""
    if radius == 0.0 or len(some) <= LEAF:
        return [(int(i), np.array([i])) for i in some]
    reach = SHRINK * radius
    near = dist <= reach
    out, left = [(center, some[near])], np.flatnonzero(~near)
    square = np.einsum("ij,ij->i", full, full)
    while len(left):
        # distances of the next centres to all that is left, a panel at a time
        panel = left[:512]
        near = square[panel][:, None] + square[left] - 2.0 * (full[panel] @ full[left].T) <= reach * reach
        free = np.ones(len(left), bool)
        for j in range(len(panel)):
            if free[j]:
                mine = near[j] & free
                mine[j] = True
                free &= ~mine
                out.append((int(some[left[j]]), some[left[mine]]))
        left = left[free]
    return out


def bounds(dot: np.ndarray, square: float, norm: float, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product with the points of balls whose centres have inner
    product ``dot`` with the anchor of squared norm ``square``, with a little slack."""
    base = square + norm * norm
    d = np.sqrt(np.maximum(base - 2.0 * dot, 0.0))
    high = 0.5 * (base - np.maximum(d - radius, 0.0) ** 2)
    low = 0.5 * (base - (d + radius) ** 2)
    slack = 1e-6 * max(base, 1.0)
    return low - slack, high + slack


class Best:
    """The ``k`` best ``(score, id)`` seen, by score, then id."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id = np.zeros(0), np.zeros(0, np.int64)

    @property
    def least(self) -> float:
        """A score below this one is not among the best."""
        return float(self.score[-1]) if len(self.score) == self.k else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if len(self.score) == self.k:
            some = score >= self.score[-1]
            score, ids = score[some], ids[some]
        if len(score) > 4 * self.k:
            some = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids = score[some], ids[some]
        if len(score):
            s, i = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
            order = np.lexsort((i, -s))[:self.k]
            self.score, self.id = s[order], i[order]


def search(tree: Tree, root: np.ndarray, q: np.ndarray, label: int, same: bool, but: int,
           windows: list[tuple[float, float]], best: list[Best]) -> None:
    """Add to ``best[w]`` the rows of (``same``: the anchor's, else other) label with a score in
    the closed window ``windows[w]``; row id ``but`` is left out. ``root`` are the scores of the
    children of the tree's root."""
    square = float(q @ q)
    low, high = np.array([w[0] for w in windows]), np.array([w[1] for w in windows])
    floor = np.maximum(low, [b.least for b in best])  # what a row must reach to matter

    def open_node(node: int, dot: np.ndarray) -> None:
        a, b = int(tree.first[node]), int(tree.first[node] + tree.count[node])
        rows, inner = tree.row[a:b], tree.count[a:b] > 0
        mine = tree.labels[rows] == label
        at = np.flatnonzero((mine == same) & ~inner & (dot >= floor.min()))
        if len(at):
            score, ids = dot[at], tree.ids[rows[at]]
            for w, x in enumerate(best):
                some = (score >= floor[w]) & (score <= high[w]) & (ids != but)
                if some.any():
                    x.add(score[some], ids[some])
                    floor[w] = max(low[w], x.least)
        at = np.flatnonzero(inner & ~((tree.only[a:b] == 1) & (mine != same)))
        if len(at):
            lo, hi = bounds(dot[at], square, tree.norm, tree.radius[a:b][at])
            wanted = ((hi[:, None] >= floor) & (lo[:, None] <= high)).any(axis=1)
            for j in np.flatnonzero(wanted).tolist():
                heapq.heappush(queue, (-float(hi[j]), float(lo[j]), a + int(at[j])))

    queue: list[tuple[float, float, int]] = []
    open_node(0, root)
    while queue:
        hi, lo, node = heapq.heappop(queue)
        if ((-hi >= floor) & (lo <= high)).any():
            a, b = int(tree.first[node]), int(tree.first[node] + tree.count[node])
            open_node(node, tree.points[tree.row[a:b]] @ q)


# ---------------------------------------------------------------- rows of blocks and chunks

_TREE = "block long, ids binary, labels binary, points binary, norm double, nodes binary, radius binary, dim int"


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    """Integer vectors of an Arrow list column, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((n, dim))
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(n), sizes), at] = values
    return out


def _build(dim: int):
    def build(block: pa.Table) -> pa.Table:
        t = build_tree(block.column("vec_id").to_numpy(), block.column("label").to_numpy(), _vectors(block.column("v"), dim))
        nodes = np.stack([t.row, t.first, t.count, t.only]).astype(np.int32)
        return pa.table({"block": block.column("block").slice(0, 1),
                         **{k: pa.array([v.tobytes()], pa.binary()) for k, v in (
                             ("ids", t.ids.astype(np.int64)), ("labels", t.labels.astype(np.int64)),
                             ("points", t.points.astype(np.float64)))},
                         "norm": [t.norm], "nodes": pa.array([nodes.tobytes()], pa.binary()),
                         "radius": pa.array([t.radius.tobytes()], pa.binary()), "dim": pa.array([dim], pa.int32())})
    return build


def _tree(row: dict) -> Tree:
    """From a row of the tree table."""
    take = lambda k, kind: np.frombuffer(row[k], kind)
    nodes = take("nodes", np.int32).reshape(4, -1)
    ids = take("ids", np.int64)
    return Tree(ids, take("labels", np.int64), take("points", np.float64).reshape(len(ids), -1), row["norm"],
                nodes[0], take("radius", np.float64), nodes[1], nodes[2], nodes[3])


def candidates(rows: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label: Column) -> DataFrame:
    """``(vec_id, label, v)``: the rows that take part, one per id, with integer vectors."""
    x = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                    F.col(vec_col).cast("array<double>").alias("x"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = x.filter("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").filter(~bad)
    v = F.transform("x", lambda c: F.floor(c * float(SCALE)).cast("long"))
    return x.groupBy("vec_id").agg(F.min(F.struct("label", v.alias("v"))).alias("r")).select("vec_id", "r.label", "r.v")


def build_trees(rows: DataFrame, n_rows: int, dim: int, per_tree: int = ROWS) -> DataFrame:
    """One row per block with its cover tree."""
    n_blocks = max(1, -(-n_rows // per_tree))
    block = F.pmod(F.xxhash64(F.lit(13), "vec_id"), F.lit(n_blocks))
    return rows.select(block.alias("block"), "vec_id", "label", "v").groupBy("block").applyInArrow(_build(dim), _TREE)


def _search_batches(dim: int, same: bool, k: int):
    """Rows of (tree, chunk) to ``(anchor_id, w, vec_id, score)``: the k best of each window
    ``w`` of each anchor over the trees of this task."""
    names = ["anchor_id", "w", "vec_id", "score"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def sent(state: dict) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], [], []]
        for (anchor, w), b in state.items():
            for s, i in zip(b.score.tolist(), b.id.tolist()):
                for c, v in zip(out, (anchor, w, i, int(s))):
                    c.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)
        state.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[tuple[int, int], Best] = {}
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            anchors = columns.pop("anchors")
            for i in range(batch.num_rows):
                tree = _tree({c: v[i].as_py() for c, v in columns.items()})
                some = anchors[i].values
                some = dict(zip([f.name for f in some.type], some.flatten()))
                ids, labels = some["vec_id"].to_numpy(), some["label"].to_numpy()
                q, windows = _vectors(some["v"], dim), some["windows"].to_pylist()
                if len(state) + len(ids) * max(1, max(map(len, windows), default=1)) > HELD:
                    yield from sent(state)
                if not tree.count[0]:  # a block of one row: the root is the point
                    top, lone = tree.points[:1], True
                else:
                    top, lone = tree.points[tree.row[tree.first[0]:tree.first[0] + tree.count[0]]], False
                if lone:
                    tree = Tree(tree.ids, tree.labels, tree.points, tree.norm, np.array([0, 0]), np.zeros(2), np.array([1, 0]),
                                np.array([1, 0]), np.array([0, 0]))
                for a in range(0, len(ids), 256):
                    dots = q[a:a + 256] @ top.T
                    for j, anchor in enumerate(ids[a:a + 256].tolist()):
                        own = [(x[0], x[1]) for x in windows[a + j]]
                        if own:
                            best = [state.setdefault((anchor, w), Best(k)) for w in range(len(own))]
                            search(tree, dots[j], q[a + j], int(labels[a + j]), same, anchor, own, best)
        yield from sent(state)
    return run


def _searched(trees: DataFrame, anchors: DataFrame, dim: int, *, same: bool, k: int, n_anchors: int,
              per_chunk: int, max_bytes: int) -> DataFrame:
    """``(anchor_id, w, vec_id, score, rank)``: the k best rows of every window of every anchor.
    ``anchors`` are ``(vec_id, label, v, windows)``, windows an array of arrays (least, most)."""
    n_chunks = max(1, -(-n_anchors // per_chunk))
    chunk = F.pmod(F.xxhash64(F.lit(31), "vec_id"), F.lit(n_chunks)).cast("int")
    chunks = cut_lineage(anchors.groupBy(chunk.alias("chunk")).agg(
        F.collect_list(F.struct("vec_id", "label", "v", "windows")).alias("anchors")))
    small = 8 * (dim + 2 + 2 * POSITIVES) * n_anchors <= max_bytes
    # where chunks are shuffled, the trees that meet one chunk are dealt over several tasks
    shares = 1 if small else SHARES
    sides = chunks.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    met = (spread(trees) if small else trees).withColumn("share", F.pmod(F.xxhash64("block"), F.lit(shares)).cast("int"))
    met = met.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    pairs = met.join(F.broadcast(sides) if small else sides, ["chunk", "share"])
    pairs = pairs.select("ids", "labels", "points", "norm", "nodes", "radius", "anchors")
    found = pairs.mapInArrow(_search_batches(dim, same, k), "anchor_id long, w int, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "w").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


# ---------------------------------------------------------------- the operator

def hard_negatives(rows: DataFrame, anchor: Column, *, id_col: str = "vec_id", vec_col: str = "embedding",
                   label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = (50, 95), per_tree: int = ROWS, per_chunk: int = CHUNK,
                   max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` picks the anchors by ``vec_id``. ``window`` are the least and largest
    percentage of the positive's score that a negative may have; a positive of negative
    score has none."""
    spark = rows.sparkSession
    path = scratch_path(spark, "negatives-rows")
    candidates(rows, id_col=id_col, vec_col=vec_col, label=F.col("label") if label is None else label).write.parquet(path)
    held = spark.read.parquet(path)
    size = held.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(anchor, 1)).alias("a"), F.max(F.size("v")).alias("dim")).first()
    n, n_anchors, dim = size["n"], size["a"], max(size["dim"] or 0, 1)
    path = scratch_path(spark, "negatives-trees")
    build_trees(held, n, dim, per_tree).write.parquet(path)
    trees = spark.read.parquet(path)
    anchors = held.filter(anchor)
    common = {"n_anchors": n_anchors, "per_chunk": per_chunk, "max_bytes": max_bytes}
    everywhere = F.array(F.array(F.lit(-1e300), F.lit(1e300)))
    top = cut_lineage(_searched(trees, anchors.withColumn("windows", everywhere), dim, same=True, k=positives, **common))
    low, high = window
    # scores are integers: the window's ends are rounded inwards
    ends = F.array(F.ceil(F.col("score") * low / F.lit(100)).cast("double"), F.floor(F.col("score") * high / F.lit(100)).cast("double"))
    wins = (top.filter("score >= 0").groupBy(F.col("anchor_id").alias("vec_id"))
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", ends.alias("ends")))), lambda x: x["ends"]).alias("windows")))
    asked = anchors.join(wins, "vec_id").select("vec_id", "label", "v", "windows")
    below = _searched(trees, asked, dim, same=False, k=negatives, **common)
    pos = top.select("anchor_id", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return below.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score").join(
        pos, ["anchor_id", "w"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """All of ``embeddings``; every seventh id has its label moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % RELABEL == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % EVERY == 0, label=moved)


ORACLE = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % {RELABEL} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda c: floor({SCALE}.0::DOUBLE * c::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT a, b, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES}),
neg AS (
  SELECT p.a, p.b AS p, s.b AS n, p.score AS ps, s.score AS ns,
         row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM pos p JOIN scored s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT a AS anchor_id, p AS positive_id, rank::INTEGER AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score
FROM neg WHERE rank <= {NEGATIVES}
"""

"""Near-duplicate classes by SetSketch registers (operator 4).

A document's set is its distinct 5-word shingles. Its sketch has ``REGISTERS`` truncated
minima on an exponential scale: register i is ``floor(1 - log_b(min of the set's i-th
exponential hashes))`` cut to one byte. Sketches of parts merge by taking the larger
register.

1. Equal sets are one class from the start; only its smallest document goes on.
2. Bands of registers are hashed to keys. In each bucket one member, the pivot, is
   compared with all others: pairs whose joint likelihood estimate is far from the
   threshold are dropped and the rest confirmed on the full sets. Linked members get one
   label, the pivot leaves the bucket, and buckets of one label are done. The first pivot
   is the smallest member, the second another one in every bucket: a member of a large
   group that the first pivot missed meets many others of its group in a linear step.
3. In the other buckets the components are compared by their roots. Jaccard distance is a
   metric, so components whose roots are further apart than the threshold and both radii
   have no link. The members of the others are compared in full, in blocks: each task gets
   two blocks of texts, counts all their shared shingles by a matrix product, and emits
   one link per member that has any. A bucket of very many components is split by further
   bands before that: two sets above the threshold share many bands, so they meet again in
   a smaller bucket. What is still large when the rounds are used up is compared as it is:
   no bucket is cut short.

Words are runs of characters other than ASCII white space, lower-cased A-Z only. Texts
with fewer than five words have their whole word sequence as the only shingle; without
words the set is empty and linked with nothing. ``doc_id`` names a document: rows that
repeat an id with one text share everything; with different texts each row has its own
set, and a link of any of them is a link of the id. A null id is its own component.
Extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm import textbytes as B
from wordmill.llm.components import components, hooked
from wordmill.session import cut_lineage

SHINGLE = 5
#: Similarity from which two documents are linked, in percent.
PERCENT = 75
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: Base of the register scale and rate of the exponential hashes.
BASE, RATE = 1.1, 20.0
#: Pairs with a lower likelihood estimate are not confirmed. The estimate's standard
#: deviation at the threshold is below 0.04, so this is five of them away.
ESTIMATE_AT_LEAST = 0.55
#: Components of a bucket that are compared without further bands, and rounds of bands.
BUCKET_COMPONENTS = 512
#: Members of either side that one task compares in full, and shingles of one product.
BLOCK_MEMBERS, BLOCK_SHINGLES = 256, 8_192
MAX_SPLITS = 3

_SEEDS = B.mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, first)``: the sorted distinct shingles of every text of a block."""
    low = B.lower_ascii(data)
    starts, ends, first = B.spans(low, offsets, B.WHITE)
    words = B.span_hashes(low, starts, ends)
    grams, g_first = B.windows(words, first, SHINGLE)
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < SHINGLE))
    if len(few):
        counts = np.diff(g_first)
        whole = []
        for d in few.tolist():
            h = np.uint64(first[d + 1] - first[d])
            for w in words[first[d]:first[d + 1]]:
                h = B.mix(np.array([h]) * np.uint64(0xFF51AFD7ED558CCD) + w)[0]
            whole.append(h)
        grams = np.insert(grams, g_first[few], np.array(whole, np.uint64))
        counts[few] = 1
        g_first = np.concatenate([[0], np.cumsum(counts)])
    grams = B.sort_within(grams, g_first)
    doc = B.row_of(g_first)
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    return grams[new], np.searchsorted(doc[new], np.arange(len(offsets)))


def registers(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of registers per non-empty set."""
    starts = first[:-1][np.diff(first) > 0]
    least = np.empty((REGISTERS, len(starts)), np.uint64)
    for i, seed in enumerate(_SEEDS):
        # the high half of a product with an odd number, spread again by a shift
        h = sets * seed
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        least[i] = np.minimum.reduceat(h, starts) if len(starts) else h[:0]
    u = (least.T.astype(np.float64) + 0.5) * 2.0 ** -64
    exponential = -np.log1p(-np.minimum(u, 1.0 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1.0 - np.log(exponential) / np.log(BASE)), 0, 255).astype(np.uint8)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood estimate of the Jaccard similarity of pairs of sketches
    from the numbers of larger, smaller and equal registers and the set sizes."""
    up, down = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - up - down
    u = n_a / (n_a + n_b)
    v = 1.0 - u
    top = np.minimum(u / v, v / u)
    grid = np.linspace(0.0, 1.0, 201)[None, :] * top[:, None]

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0.0, 1.0) * (BASE - 1.0) / BASE) / np.log(BASE)

    p_up, p_down = p(u[:, None] - v[:, None] * grid), p(v[:, None] - u[:, None] * grid)
    tiny = 1e-12
    like = (up[:, None] * np.log(p_up + tiny) + down[:, None] * np.log(p_down + tiny)
            + same[:, None] * np.log(np.maximum(1.0 - p_up - p_down, tiny)))
    return np.take_along_axis(grid, like.argmax(axis=1)[:, None], axis=1)[:, 0]


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in B.blocks(batch.column(1), 1 << 20):
            sets, first = shingle_sets(data, offsets)
            n = np.diff(first)
            some = n > 0
            regs = registers(sets, first)
            # two sums over the set name it
            one = np.zeros(len(n), np.uint64)
            two = np.zeros(len(n), np.uint64)
            if some.any():
                starts = first[:-1][some]
                one[some] = np.add.reduceat(sets, starts)
                two[some] = np.add.reduceat(B.mix(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
            sketch = np.full(len(n), None, object)
            sketch[some] = [r.tobytes() for r in regs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, end - row), pa.array(n), pa.array(one.view(np.int64)),
                 pa.array(two.view(np.int64)), pa.array(sketch.tolist(), pa.binary())],
                ["doc_id", "n_shingles", "set_1", "set_2", "sketch"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, set_1, set_2, sketch)``: one narrow pass over the texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_sketch_batches, "doc_id long, n_shingles long, set_1 long, set_2 long, sketch binary")


def _band_keys() -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        i, F.substring("sketch", i * ROWS + 1, F.lit(ROWS))))


def _estimate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            a, b = (np.frombuffer(b"".join(x.as_py() for x in part.column(c)), np.uint8).reshape(-1, REGISTERS)
                    for c in (2, 3))
            n_a, n_b = (part.column(c).to_numpy().astype(float) for c in (4, 5))
            j = estimate(a, b, n_a, n_b)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(j)], ["u", "v", "estimate"])


def _similar_sizes(a: str, b: str) -> Column:
    """Sets whose sizes alone rule the threshold out are no pair."""
    return (F.col(a) * 100 >= F.col(b) * PERCENT) & (F.col(b) * 100 >= F.col(a) * PERCENT)


def _estimates(pairs: DataFrame, classes: DataFrame, any_size: bool = False) -> DataFrame:
    """``(u, v, estimate)`` of pairs ``(u, v)`` of class heads."""
    side = {c: classes.select(F.col("doc_id").alias(c), F.col("sketch").alias(f"s_{c}"), F.col("n_shingles").alias(f"n_{c}"))
            for c in "uv"}
    both = pairs.select("u", "v").join(side["u"], "u").join(side["v"], "v")
    if not any_size:
        both = both.filter(_similar_sizes("n_u", "n_v"))
    return both.select("u", "v", "s_u", "s_v", "n_u", "n_v").mapInArrow(
        _estimate_batches, "u long, v long, estimate double")


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs ``(u, v)`` whose sketches do not rule a link out."""
    return _estimates(pairs, classes).filter(F.col("estimate") >= ESTIMATE_AT_LEAST).select("u", "v")


def _confirm_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            part = batch.slice(i, 64)
            n = part.num_rows
            # one text of many pairs stands in many rows in a row: build its set once
            texts: dict[str, int] = {}
            side = [np.array([texts.setdefault(t or "", len(texts)) for t in part.column(c).to_pylist()]) for c in (2, 3)]
            sets: list[np.ndarray] = []
            for _, _, data, offsets in B.blocks(pa.array(list(texts), pa.string())):
                h, first = shingle_sets(data, offsets)
                sets += [h[a:b] for a, b in zip(first, first[1:])]
            linked = np.zeros(n, bool)
            for k, (x, y) in enumerate(zip(*side)):
                a, b = sets[x], sets[y]
                if len(a) and len(b):
                    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                    shared = int(np.count_nonzero(b[at] == a))
                    linked[k] = 100 * shared >= PERCENT * (len(a) + len(b) - shared)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(linked)], ["u", "v", "linked"])


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(u, v)`` that are linked on their full sets. ``texts`` has one row
    ``(doc_id, text)`` per id; only texts that occur in a pair are shuffled."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    needed = texts.join(ends, "doc_id", "left_semi")
    both = (pairs.join(needed.select(F.col("doc_id").alias("v"), F.col("text").alias("t_v")), "v")
            .join(needed.select(F.col("doc_id").alias("u"), F.col("text").alias("t_u")), "u")
            .select("u", "v", "t_u", "t_v"))
    return both.mapInArrow(_confirm_batches, "u long, v long, linked boolean").filter("linked").select("u", "v")


def _mixed(rows: DataFrame) -> DataFrame:
    """``(key, doc_id, c, pivot, pivot_c)`` of the buckets that hold more than one
    component; the pivot is a member by a hash that differs from bucket to bucket."""
    bucket = Window.partitionBy("key")
    pivot = F.min(F.struct(F.xxhash64("doc_id", "key").alias("o"), "doc_id", "c")).over(bucket)
    return (rows.withColumn("lo", F.min("c").over(bucket)).withColumn("hi", F.max("c").over(bucket)).withColumn("p", pivot)
            .filter("lo < hi").select("key", "doc_id", "c", F.col("p.doc_id").alias("pivot"), F.col("p.c").alias("pivot_c")))


def _relabelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    return rows.select("key", "doc_id").join(label.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("c"))


def _near_in_cell(parts: pa.Table) -> pa.Table:
    """Pairs of components of one cell whose roots are near enough, by their sketches."""
    c, block = parts.column("c").to_numpy(), parts.column("block").to_numpy()
    regs = np.frombuffer(b"".join(parts.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS)
    n, r = parts.column("n_shingles").to_numpy().astype(float), parts.column("r").to_numpy()
    here, there = int(parts.column("i")[0].as_py()), int(parts.column("j")[0].as_py())
    a, b = np.flatnonzero(block == here), np.flatnonzero(block == there)
    us, vs = [], []
    for k in a.tolist():
        # equal registers bound the estimate from above well enough to skip most pairs
        same = (regs[k] == regs[b]).mean(axis=1)
        some = b[(same + r[k] + r[b] >= ESTIMATE_AT_LEAST - 0.1) & (c[b] != c[k])]
        if here == there:
            some = some[c[some] > c[k]]
        if len(some):
            j = estimate(np.repeat(regs[k:k + 1], len(some), axis=0), regs[some], np.full(len(some), n[k]), n[some])
            some = some[j + r[k] + r[some] >= ESTIMATE_AT_LEAST]
            us.append(np.minimum(c[k], c[some]))
            vs.append(np.maximum(c[k], c[some]))
    u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
    return pa.table({"c_u": pa.array(u, pa.int64()), "c_v": pa.array(v, pa.int64())})


def _near_components(comps: DataFrame, roots: DataFrame) -> DataFrame:
    """Component pairs ``(c_u, c_v)`` that share a bucket and whose roots are near. A
    bucket ``(key, c, n)`` is cut into blocks; a task gets two blocks and emits only what
    is near. ``roots`` has ``(c, sketch, n_shingles, r)``."""
    blocks = F.ceil(F.col("n") / BUCKET_COMPONENTS).cast("int")
    dealt = comps.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("c", "key"), F.col("blocks")).cast("int"))
    cells = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "c", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")))
    return (cells.join(roots, "c").groupBy("key", "i", "j").applyInArrow(_near_in_cell, "c_u long, c_v long").distinct())


def _block_links(parts: pa.Table) -> pa.Table:
    """Of one block of hosts and one of partners: a link for every partner that has one."""
    host = np.array(parts.column("host").to_pylist(), bool)
    ids = parts.column("doc_id").to_numpy()
    sets: list[np.ndarray] = []
    for _, _, data, offsets in B.blocks(parts.column("text").combine_chunks()):
        h, first = shingle_sets(data, offsets)
        sets += [h[a:b] for a, b in zip(first, first[1:])]
    a, b = np.flatnonzero(host), np.flatnonzero(~host)
    none = pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
    if not len(a) or not len(b):
        return none
    size = np.array([len(x) for x in sets], float)
    each = [np.concatenate([sets[i] for i in side]) if len(side) else np.zeros(0, np.uint64) for side in (a, b)]
    row = [np.repeat(np.arange(len(side)), size[side].astype(int)) for side in (a, b)]
    common = np.intersect1d(*each)
    shared = np.zeros((len(a), len(b)), np.float32)
    place = [np.searchsorted(common, x) for x in each]
    known = [(p < len(common)) & (common[np.minimum(p, len(common) - 1)] == x) if len(common) else np.zeros(len(x), bool)
             for p, x in zip(place, each)]
    for c in range(0, len(common), BLOCK_SHINGLES):
        m = []
        for p, k, r, side in zip(place, known, row, (a, b)):
            here = k & (p >= c) & (p < c + BLOCK_SHINGLES)
            x = np.zeros((len(side), min(BLOCK_SHINGLES, len(common) - c)), np.float32)
            x[r[here], p[here] - c] = 1.0
            m.append(x)
        shared += m[0] @ m[1].T
    union = size[a][:, None] + size[b][None, :] - shared
    linked = (100.0 * shared >= PERCENT * union) & (shared > 0) & (ids[a][:, None] != ids[b][None, :])
    hit = np.flatnonzero(linked.any(axis=0))
    if not len(hit):
        return none
    x, y = ids[a][linked[:, hit].argmax(axis=0)], ids[b][hit]
    return pa.table({"u": np.minimum(x, y), "v": np.maximum(x, y)})


def _compare_blocks(near: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the members ``(doc_id, c)`` of component pairs ``(c_u, c_v)``: the
    larger component is the host, the members of all its pairs are its partners."""
    sizes = nodes.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    n_u, n_v = (sizes.select(F.col("c").alias(c), F.col("n").alias(f"n{c[1:]}")) for c in ("c_u", "c_v"))
    pairs = near.join(n_u, "c_u").join(n_v, "c_v").select(
        F.when(F.col("n_u") >= F.col("n_v"), F.struct(F.col("c_u").alias("a"), F.col("c_v").alias("b"), F.col("n_u").alias("hosts")))
        .otherwise(F.struct(F.col("c_v").alias("a"), F.col("c_u").alias("b"), F.col("n_v").alias("hosts"))).alias("p"),
        F.least("n_u", "n_v").alias("n")).select("p.*", "n")
    blocks = cut_lineage(pairs.groupBy("a").agg(
        F.ceil(F.max("hosts") / BLOCK_MEMBERS).cast("int").alias("h"), F.ceil(F.sum("n") / BLOCK_MEMBERS).cast("int").alias("p")))

    def side(rows: DataFrame, own: str, other: str, host: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("doc_id"), F.col(own)).cast("int").alias(own)
        return (rows.select("a", "doc_id", F.lit(host).alias("host"), mine, F.col(other).alias("all"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col("all") - 1))).select("a", "doc_id", "host", "h", "p"))
    hosts = side(nodes.withColumnRenamed("c", "a").join(blocks, "a"), "h", "p", True)
    partners = side(pairs.select("a", F.col("b").alias("c")).join(nodes, "c").join(blocks, "a"), "p", "h", False)
    cells = cut_lineage(hosts.unionByName(partners))
    needed = texts.join(cells.select("doc_id").distinct(), "doc_id", "left_semi")
    return cells.join(needed, "doc_id").groupBy("a", "h", "p").applyInArrow(_block_links, "u long, v long").distinct()


def _between_components(mixed: DataFrame, label: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``(u, v)`` between members of different components that share a bucket."""
    # how far the members of a component are from its root at most
    spokes = label.filter("node <> component").select(F.col("component").alias("u"), F.col("node").alias("v"))
    radius = _estimates(spokes, classes, True).groupBy(F.col("u").alias("c")).agg((1.0 - F.min("estimate")).alias("r"))
    roots = cut_lineage(classes.select(F.col("doc_id").alias("c"), "sketch", "n_shingles").join(radius, "c", "left")
                        .withColumn("r", F.coalesce("r", F.lit(0.0))))
    near = None
    for split in range(MAX_SPLITS + 1):
        comps = mixed.select("key", "c").distinct()
        comps = cut_lineage(comps.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))))
        large = F.col("n") > BUCKET_COMPONENTS
        last = split == MAX_SPLITS or comps.filter(large).isEmpty()
        found = _near_components(comps if last else comps.filter(~large), roots)
        near = found if near is None else near.unionByName(found)
        if last:
            break
        again = (mixed.join(comps.filter(large).select("key").distinct(), "key", "left_semi")
                 .join(classes.select("doc_id", "sketch"), "doc_id")
                 .select(F.col("key").alias("old"), "doc_id", "c", F.explode(_band_keys()).alias("band"))
                 .filter(F.col("old") != F.col("band"))
                 .select(F.xxhash64("old", "band").alias("key"), "doc_id", "c"))
        mixed = cut_lineage(_mixed(again).select("key", "doc_id", "c"))
    near = near.distinct()
    nodes = classes.select("doc_id").join(label.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").select(
        "doc_id", F.coalesce("component", "doc_id").alias("c"))
    return _compare_blocks(cut_lineage(near), nodes, texts)


def links(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """``(node, component)`` over the set classes ``(doc_id, n_shingles, sketch)``."""
    bucket = Window.partitionBy("key")
    members = cut_lineage(classes.select("doc_id", F.explode(_band_keys()).alias("key"))
                          .withColumn("u", F.min("doc_id").over(bucket)).withColumn("top", F.max("doc_id").over(bucket))
                          .filter("u < top").select("key", "doc_id", "u"))
    rest = members.filter("doc_id <> u")
    tried = cut_lineage(_likely(rest.select("u", F.col("doc_id").alias("v")).distinct(), classes))
    edges = cut_lineage(confirm(tried, texts))
    mixed = cut_lineage(_mixed(_relabelled(rest, hooked(edges))))

    again = mixed.filter("c <> pivot_c").select(F.least("doc_id", "pivot").alias("u"), F.greatest("doc_id", "pivot").alias("v"))
    more = cut_lineage(_likely(again.distinct().join(tried, ["u", "v"], "left_anti"), classes))
    edges = cut_lineage(edges.unionByName(confirm(more, texts)))
    label = hooked(edges)
    mixed = cut_lineage(_mixed(_relabelled(mixed.filter("doc_id <> pivot"), label)))

    if not mixed.isEmpty():
        edges = edges.unionByName(_between_components(mixed.select("key", "doc_id", "c"), label, classes, texts))
    return cut_lineage(components(edges))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``: one row per input row."""
    sk = cut_lineage(sketches(docs, id_col, text_col))
    some = sk.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(some.groupBy("set_1", "set_2", "n_shingles").agg(
        F.min(F.struct("doc_id", "sketch")).alias("head")).select("set_1", "set_2", "n_shingles", "head.*"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    label = links(classes.select("doc_id", "n_shingles", "sketch"), texts)
    named = classes.select("set_1", "set_2", "n_shingles", F.col("doc_id").alias("head"))
    out = (sk.join(named, ["set_1", "set_2", "n_shingles"], "left")
           .withColumn("node", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("head"))
                       .otherwise(F.col("doc_id")))
           .join(label, "node", "left"))
    component = F.coalesce("component", "node")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op4_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.d),
m AS (SELECT d AS doc_id, min(c) AS component_id FROM r GROUP BY d)
SELECT m.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, m.doc_id = component_id AS kept
FROM m LEFT JOIN n USING (doc_id)
"""

"""Best-fit packing by hierarchical residual merging (operator 6).

Items (pieces of documents) are dealt into groups of bounded size; each group packs its
items best-fit in order of falling length. Bins that are nearly full are emitted. The
others go up a tree: ``FAN_IN`` groups meet, and their underfull bins are packed again
as items. How many go up depends on the lengths: with pieces of a little over half a bin all
do, so a merge holds at most the bins of ``FAN_IN`` groups in its first round.

Only numbers are shuffled, never texts or ids. Null and empty texts are one piece that
holds the end id alone; repeated rows are packed each for itself; extra columns are
ignored; an empty table gives an empty result."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import wordbpe
from wordmill.session import cut_lineage

CAPACITY = 2048
END_ID = 0
#: Items that one task packs.
GROUP_ITEMS = 50_000
#: Groups whose leftovers meet in one merge.
FAN_IN = 16


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: ``(bin of each item, its offset, fill of each bin)``.

    Open bins lie in stacks by free room; an integer has a bit for every stack in use,
    so the tightest room that suffices is its lowest set bit from the length on."""
    stacks: dict[int, list[int]] = {}
    used = 0
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        above = used >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            stack = stacks[room]
            b = stack.pop()
            if not stack:
                used ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        room -= n
        if room:
            stacks.setdefault(room, []).append(b)
            used |= 1 << room
    return bins, offsets, np.array(fill, np.int64)


def _pack_batches(capacity: int):
    """Pack a partition of ``(item, length)``; a bin is named after its first item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if not got:
            return
        items, lengths = (np.concatenate(x) for x in zip(*got))
        bins, offsets, fill = best_fit(lengths, capacity)
        name = np.zeros(len(fill), np.int64)
        first = offsets == 0
        name[bins[first]] = items[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (items, name[bins], offsets, fill[bins])], ["item", "bin", "offset", "fill"])
    return run


_PACKED = "item long, bin long, offset long, fill long"


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, fan_in: int = FAN_IN) -> DataFrame:
    """``(item, bin, offset)`` for ``(item, length)`` rows with unique items and lengths
    from 1 to ``capacity``. ``items`` should be a written table: it is counted first."""
    run = _pack_batches(capacity)
    groups = max(1, -(-items.count() // group_items))
    packed = cut_lineage(items.select("item", "length").repartition(groups).mapInArrow(run, _PACKED))
    # leftovers of the first round, as items of the next
    open_bins = packed.filter(f"offset = 0 AND 4 * fill <= 3 * {capacity}").select(
        F.col("bin").alias("item"), F.col("fill").alias("length"))
    moved = None
    while groups > 1:
        groups = -(-groups // fan_in)
        merged = cut_lineage(open_bins.repartition(groups).mapInArrow(run, _PACKED))
        step = merged.select(F.col("item").alias("from_bin"), F.col("bin").alias("to_bin"), F.col("offset").alias("shift"))
        if moved is None:
            moved = step
        else:
            later = step.select(F.col("from_bin").alias("to_bin"), F.col("to_bin").alias("next_bin"),
                                F.col("shift").alias("more"))
            moved = moved.join(later, "to_bin", "left").select(
                "from_bin", F.coalesce("next_bin", "to_bin").alias("to_bin"),
                (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        open_bins = merged.filter(f"offset = 0 AND 2 * fill <= {capacity}").select(
            F.col("bin").alias("item"), F.col("fill").alias("length"))
    if moved is None:
        return packed.select("item", "bin", "offset")
    return packed.join(moved, packed["bin"] == moved["from_bin"], "left").select(
        "item", F.coalesce("to_bin", "bin").alias("bin"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))


def _piece_batches(body: bytes, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = TaskContext.get().partitionId() << 40
        for rows, ids, first in wordbpe.encoded_blocks(batches, body):
            length = np.diff(first) + 1
            count = -(-length // capacity)
            doc = np.repeat(np.arange(len(length)), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            size = np.minimum(length[doc] - start, capacity)
            raw, end = ids.astype("<u4").tobytes(), np.uint32(END_ID).tobytes()
            crc = []
            for d, s, n, last in zip(doc.tolist(), start.tolist(), size.tolist(), (start + size == length[doc]).tolist()):
                a = 4 * (int(first[d]) + s)
                crc.append(zlib.crc32(end, zlib.crc32(raw[a:a + 4 * (n - 1)])) if last else zlib.crc32(raw[a:a + 4 * n]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item + np.arange(len(doc))), rows.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                 pa.array(start), pa.array(size), pa.array(crc, pa.int64())],
                ["item", "doc_id", "piece", "start", "length", "ids_crc32"])
            item += len(doc)
    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(item, doc_id, piece, start, length, ids_crc32)``: every document's ids and the
    end id, cut only where they exceed ``capacity``. One narrow pass over the texts."""
    with open(tokenizer_path, "rb") as f:
        body = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_piece_batches(body, capacity), "item long, doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and place. The pieces are written once
    (texts are tokenised once), then packed and joined by item."""
    cut = cut_lineage(pieces(docs, tokenizer_path, capacity, id_col, text_col))
    placed = pack(cut, capacity)
    return cut.join(placed, "item").select("doc_id", "piece", "start", "length", "ids_crc32",
                                           F.col("bin").alias("sequence_id"), "offset")


def op6_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` in sequences of at most 2048 tokens."""
    import public_tokenizers as P
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("word_bpe_49k.json"))

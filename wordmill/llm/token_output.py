"""Packed token-id matrices (operator 7).

Texts are tokenised, each followed by the end id, cut only where they exceed a row, and
packed best-fit in order of falling length into rows of ``capacity`` ids. A segment tree
over the free room of the open rows finds the tightest row that suffices. A task packs
a shard of at most ``SHARD_TOKENS`` ids at a time and emits its rows, so memory is
bounded and nothing is shuffled.

Per row: the ids (padded), the position of every id within its segment (it restarts at 0
with each segment), the cumulative segment lengths, and where each segment comes from.
``unpack`` restores every document's ids.

Null and empty texts are one segment that holds the end id alone; repeated rows are
packed each for itself; extra columns are ignored; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import textbytes as B
from wordmill.llm import wordbpe

CAPACITY = 2048
END_ID = 0
PAD_ID = 0
#: Ids that a task packs together.
SHARD_TOKENS = 6_000_000


class RoomTree:
    """The free rooms in use, as a segment tree over 0..capacity: a node holds the
    largest room in use below it, or -1."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.top = [-1] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _set(self, room: int, value: int) -> None:
        top, i = self.top, self.size + room
        top[i] = value
        i >>= 1
        while i:
            best = max(top[2 * i], top[2 * i + 1])
            if top[i] == best:
                break
            top[i] = best
            i >>= 1

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        if len(self.rows[room]) == 1:
            self._set(room, room)

    def take(self, need: int) -> tuple[int, int] | None:
        """The ``(room, row)`` with the least room of at least ``need``, taken out."""
        top = self.top
        if top[1] < need:
            return None
        i = 1
        while i < self.size:
            i = 2 * i if top[2 * i] >= need else 2 * i + 1
        room = i - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            self._set(room, -1)
        return room, row


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(row of each piece, its offset, number of rows)``."""
    tree = RoomTree(capacity)
    row_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n_rows = 0
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        got = tree.take(n)
        if got is None:
            room, row = capacity, n_rows
            n_rows += 1
        else:
            room, row = got
        row_of[i], offset[i] = row, capacity - room
        if room > n:
            tree.add(room - n, row)
    return row_of, offset, n_rows


def _lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values, kind))


def _matrix(flat: np.ndarray, capacity: int) -> list[bytes]:
    raw = flat.tobytes()
    step = capacity * flat.itemsize
    return [raw[i:i + step] for i in range(0, len(raw), step)]


def _shard(docs: pa.Array, ids: np.ndarray, first: np.ndarray, capacity: int, number: int) -> pa.RecordBatch:
    """Pack the documents of a shard; ``ids[first[d]:first[d + 1]]`` are document d's."""
    n = len(first) - 1
    flat = np.full(len(ids) + n, END_ID, np.uint32)
    begin = first[:-1] + np.arange(n)
    flat[B.ragged(begin, np.diff(first))] = ids
    length = np.diff(first) + 1
    count = -(-length // capacity)
    doc = np.repeat(np.arange(n), count)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = piece * capacity
    size = np.minimum(length[doc] - start, capacity)
    row, offset, n_rows = best_fit_decreasing(size, capacity)
    order = np.lexsort((offset, row))
    doc, piece, start, size, row, offset = (x[order] for x in (doc, piece, start, size, row, offset))
    to = B.ragged(row * capacity + offset, size)
    matrix = np.full(n_rows * capacity, PAD_ID, np.uint32)
    matrix[to] = flat[B.ragged(begin[doc] + start, size)]
    positions = np.zeros(n_rows * capacity, np.uint32)
    positions[to] = B.ragged(np.zeros(len(size), np.int64), size)
    cuts = np.searchsorted(row, np.arange(n_rows + 1))
    # cumulative lengths: a 0, then the end of every segment
    lengths = np.insert(offset + size, cuts[:-1], 0)
    return pa.RecordBatch.from_arrays([
        pa.array(number + np.arange(n_rows)), pa.array(np.add.reduceat(size, cuts[:-1])),
        pa.array(_matrix(matrix.astype("<u4"), capacity), pa.binary()),
        pa.array(_matrix(positions.astype("<u4"), capacity), pa.binary()),
        _lists(lengths, cuts + np.arange(n_rows + 1), pa.int32()),
        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), docs.take(pa.array(doc)).cast(pa.int64())),
        _lists(piece, cuts, pa.int32()), _lists(start, cuts, pa.int64())], _NAMES)


_NAMES = ["sequence_id", "n_tokens", "ids", "positions", "cu_seqlens", "doc_ids", "pieces", "starts"]
_SCHEMA = ("sequence_id long, n_tokens long, ids binary, positions binary, cu_seqlens array<int>, "
           "doc_ids array<long>, pieces array<int>, starts array<long>")


def _pack_batches(body: bytes, capacity: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            docs = pa.chunked_array([h[0] for h in held]).combine_chunks()
            lengths = np.concatenate([np.diff(h[2]) for h in held])
            first = np.concatenate([[0], np.cumsum(lengths)])
            packed = _shard(docs, np.concatenate([h[1] for h in held]), first, capacity, number)
            held.clear()
            number += packed.num_rows
            for i in range(0, packed.num_rows, 512):
                yield packed.slice(i, 512)

        tokens = 0
        for rows, ids, first in wordbpe.encoded_blocks(batches, body):
            held.append((rows.column(0), ids, first))
            tokens += len(ids)
            if tokens >= shard_tokens:
                yield from flush()
                tokens = 0
        if held:
            yield from flush()
    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, shard_tokens: int = SHARD_TOKENS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of the matrix per DataFrame row; ids and positions are ``capacity``
    little-endian unsigned 32-bit integers."""
    with open(tokenizer_path, "rb") as f:
        body = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_pack_batches(body, capacity, shard_tokens), _SCHEMA)


def write(packed: DataFrame, path: str) -> None:
    """Write the matrix as Parquet: any reader gets fixed-width binary rows."""
    packed.write.mode("errorifexists").parquet(path)


def unpack(packed: DataFrame) -> DataFrame:
    """``(doc_id, ids)`` of every document, ids without the end id, from the matrix.
    Documents are told apart by ``doc_id``, which must not repeat for this."""
    seg = packed.select("ids", "cu_seqlens", F.arrays_zip("doc_ids", "pieces").alias("z")).select(
        "ids", "cu_seqlens", F.posexplode("z").alias("i", "z"))
    begin, end = F.get("cu_seqlens", F.col("i")), F.get("cu_seqlens", F.col("i") + 1)
    parts = seg.select(F.col("z.doc_ids").alias("doc_id"), F.col("z.pieces").alias("piece"),
                       F.substring("ids", begin * 4 + 1, (end - begin) * 4).alias("part"))
    whole = (parts.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("piece", "part"))).alias("p"))
             .select("doc_id", F.unhex(F.array_join(F.transform("p.part", lambda x: F.hex(x)), "")).alias("ids")))
    return whole.select("doc_id", F.substring("ids", F.lit(1), (F.octet_length("ids") - 4).cast("int")).alias("ids"))


def op7_token_output(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` as a matrix of 2048 columns; ids and positions as digests."""
    import public_tokenizers as P
    packed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), P.path("word_bpe_49k.json"))
    return packed.select("sequence_id", "n_tokens", "doc_ids", "pieces", "starts", "cu_seqlens",
                         F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"))

"""Byte-level BPE encoding and decoding (operator 3).

Encoding equals splitting the whole text by the pattern and merging each match by the
ranks. Long texts are cut into overlapping chunks that are pre-tokenised on their own,
anywhere in the cluster. A match depends on nothing before its start, so once a chunk
and the one before it share a boundary inside their overlap, both agree from there on:
that boundary becomes the cut. From the first chunk without such a boundary on, the rest
of its text stays in one piece. The pieces between cuts are encoded, and the ids follow each other in order.
Decoding concatenates the bytes of the ids.

Null texts are empty: no ids. Repeated rows give repeated results; extra columns are
ignored. The driver ships the rank file (about 1 MB whatever the input) to the tasks."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm import textbytes as B

#: Characters of a chunk without its overlap; shorter texts are encoded whole.
CHUNK_CHARS = 32_768
#: Characters that a chunk shares with the next one.
OVERLAP_CHARS = 1_024
#: A boundary this close to a chunk's end might move if the text went on.
GUARD_CHARS = 16


@lru_cache(2)
def _ranks(body: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in body.splitlines() if line)}


@lru_cache(2)
def _encoding(body: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(body), special_tokens={})


@lru_cache(2)
def _token_bytes(body: bytes) -> list[bytes]:
    ranks = _ranks(body)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _encode_batches(body: bytes, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(body, pattern).encode_ordinary
        for batch in batches:
            keys, texts = batch.columns[:-1], batch.columns[-1]
            for row, end, data, offsets in B.blocks(texts):
                whole, cuts = data.tobytes(), offsets.tolist()
                ids = [np.array(encode(whole[a:b].decode()), "<u4").tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([*(k.slice(row, end - row) for k in keys), pa.array(ids, pa.binary())],
                                                 [*batch.schema.names[:-1], "ids"])
    return run


def _decode_batches(body: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(body)
        for batch in batches:
            at = batch.schema.names.index("ids")
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                raw = [b"".join([table[t] for t in np.frombuffer(x, "<u4").tolist()])
                       for x in (v.as_buffer() or b"" for v in part.column(at))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())],
                                                 [*part.schema.names, "decoded"])
    return run


def _cut_batches(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n = max(1, -(-(len(text) - overlap) // chunk))
                for c in range(n):
                    part = text[c * chunk:] if c == n - 1 else text[c * chunk:(c + 1) * chunk + overlap]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key], pa.int64()), pa.array([doc], pa.int64()), pa.array([c], pa.int64()),
                         pa.array([c == n - 1]), pa.array([part], pa.string())], ["key", "doc_id", "chunk", "last", "text"])
    return run


def _boundary_batches(pattern: str, chunk: int, overlap: int, guard: int):
    """Boundaries of each chunk within the overlaps, counted from the overlap's start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        ints = pa.list_(pa.int32())
        for batch in batches:
            heads, tails = [], []
            for c, last, text in zip(*(batch.column(i).to_pylist() for i in range(2, 5))):
                edges = np.fromiter((m.start() for m in compiled.finditer(text)), np.int64)
                head = edges[(edges > 0) & (edges < overlap)].tolist() if c else []
                # at its end a piece must look as it does in the text: the pattern looks
                # ahead from white space only
                heads.append([p for p in head if not text[p - 1].isspace()])
                tail = edges[(edges > chunk) & (edges < chunk + overlap) & (edges + guard <= len(text))] - chunk
                tails.append([] if last else tail.tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, ints), pa.array(tails, ints)],
                                             [*batch.schema.names, "head", "tail"])
    return run


def pieces(long_docs: DataFrame, pattern: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
           guard: int = GUARD_CHARS) -> DataFrame:
    """``(key, doc_id, piece, text)`` of ``(key, doc_id, text)`` rows: texts cut only at
    boundaries of the pattern's matches. The chunks are dealt over the cluster by
    (key, chunk), so one very long text is pre-tokenised by many tasks."""
    cut = long_docs.mapInArrow(_cut_batches(chunk, overlap),
                               "key long, doc_id long, chunk long, last boolean, text string")
    edged = cut.repartition("key", "chunk").mapInArrow(
        _boundary_batches(pattern, chunk, overlap, guard),
        "key long, doc_id long, chunk long, last boolean, text string, head array<int>, tail array<int>")
    in_order = Window.partitionBy("key").orderBy("chunk")
    shared = F.array_min(F.array_intersect("head", F.lag("tail").over(in_order)))
    cuts = edged.withColumn("cut", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(shared))
    # a chunk's boundaries are those of the whole text only from its own cut on
    so_far = F.min(F.col("cut").isNotNull()).over(in_order)
    cuts = cuts.withColumn("cut", F.when(so_far, F.col("cut")))
    # the start of what this chunk adds, and where the next chunk takes over
    own = (cuts.withColumn("stop", F.when(F.col("last"), F.length("text"))
                           .otherwise(F.lit(chunk) + F.coalesce(F.lead("cut").over(in_order), F.lit(0))))
           .withColumn("piece", F.sum(F.col("cut").isNotNull().cast("long")).over(in_order))
           .withColumn("begin", F.coalesce("cut", F.lit(0)))
           .select("key", "doc_id", "piece", "chunk",
                   F.expr("substring(text, begin + 1, stop - begin)").alias("part")))
    parts = F.sort_array(F.collect_list(F.struct("chunk", "part")))
    return (own.groupBy("key", "doc_id", "piece").agg(parts.alias("parts"))
            .select("key", "doc_id", "piece", F.array_join(F.col("parts.part"), "").alias("text")))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``(doc_id, ids)``: one row per input row, ids as little-endian unsigned 32-bit
    integers. Texts of up to ``chunk`` characters take no shuffle."""
    with open(ranks_path, "rb") as f:
        body = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    run = _encode_batches(body, pattern)
    short = rows.filter(F.length("text") <= chunk).mapInArrow(run, "doc_id long, ids binary")
    long_docs = (rows.filter(F.length("text") > chunk)
                 .select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"))
    encoded = pieces(long_docs, pattern, chunk, overlap).mapInArrow(run, "key long, doc_id long, piece long, ids binary")
    in_order = F.sort_array(F.collect_list(F.struct("piece", "ids")))
    joined = (encoded.groupBy("key", "doc_id").agg(in_order.alias("p"))
              .select("doc_id", F.unhex(F.array_join(F.transform("p.ids", lambda x: F.hex(x)), "")).alias("ids")))
    return short.unionByName(joined)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The input with ``decoded``: the concatenated bytes of ``ids``."""
    with open(ranks_path, "rb") as f:
        body = f.read()
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(_decode_batches(body), f"{fields}, decoded binary")


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``, encoded and decoded again."""
    import public_tokenizers as P
    path = P.path("byte_bpe_50k.tiktoken")
    both = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, P.PATTERN), path)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

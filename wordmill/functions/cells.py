"""Array passes over the cells of term vectors, for Python workers: nothing here needs Spark, so
a worker loads no more than NumPy and Arrow.

An Arrow batch has a number of rows, whatever they hold: with a document in a row, one batch of
them would take a large part of a task's memory. So vectors come in pieces of at most ``PIECE``
cells, a row each, with the place ``pos`` of the piece in its document. The pieces of a document
follow one another; a document without cells has one row without ``pos``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 32

# Bytes of documents that are worked on together (a look-up hashes all terms first), and the
# pieces of a result.
PASS_BYTES = 12 << 20
RUN_PIECES = 1 << 13


def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole documents of about ``PASS_BYTES`` in all, and the rows where they begin."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> tuple[pa.RecordBatch, np.ndarray]:
        rows = pa.concat_batches(held)
        return rows, np.flatnonzero(rows.column("pos").fill_null(0).to_numpy() == 0)
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= PASS_BYTES:
            rows, begin = joined()
            # the last document may go on; a long one is joined again after as many bytes more
            held, size = [rows.slice(begin[-1])], 0
            if len(begin) > 1:
                yield rows.slice(0, begin[-1]), begin[:-1]
            pa.default_memory_pool().release_unused()  # what a look-up's hash table took
    if held:
        yield joined()


def _runs(rows: pa.RecordBatch, begin: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, int, int]]:
    """``(ids, document of each row, first row, row after the last)`` of runs of documents of at
    most ``RUN_PIECES`` rows, or of one document."""
    ends, a = np.append(begin, rows.num_rows), 0
    while a < len(begin):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + RUN_PIECES, side="right")) - 1)
        of = np.repeat(np.arange(b - a), np.diff(ends[a:b + 1]))
        yield rows.column(0).take(pa.array(begin[a:b])), of, int(ends[a]), int(ends[b])
        a = b


def _lengths(lists: pa.ListArray) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy()


def _listed(row: np.ndarray, n: int, cells: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.searchsorted(row, np.arange(n + 1)).astype(np.int32), cells)


def _weights(name: str, ids: pa.Array, row: np.ndarray, tf: np.ndarray, idf: np.ndarray, term: pa.Array, sublinear_tf: bool) -> pa.RecordBatch:
    tf = tf.astype(float)
    w = (np.log(tf) + 1.0 if sublinear_tf else tf) * idf
    w /= np.sqrt(np.bincount(row, w * w, len(ids)))[row]
    cells = pa.StructArray.from_arrays([term, pa.array(w)], ["term", "weight"])
    return pa.RecordBatch.from_arrays([ids, _listed(row, len(ids), cells)], [name, "weights"])


def _looked_up(batches: Iterator[pa.RecordBatch], terms: pa.Array) -> Iterator[tuple]:
    """``(name of the id, ids, row, place in terms or -1, tf, term)`` of all cells, a run of documents at a time."""
    for rows, begin in documents(batches):
        lists = rows.column("cells")
        term, tf = lists.flatten().flatten()
        at, tf, length = pc.index_in(term, value_set=terms).fill_null(-1).to_numpy(), tf.to_numpy(), _lengths(lists)
        before = np.concatenate([[0], np.cumsum(length)])
        for ids, of, a, b in _runs(rows, begin):
            lo, hi = int(before[a]), int(before[b])
            yield rows.schema.names[0], ids, np.repeat(of, length[a:b]), at[lo:hi], tf[lo:hi], term.slice(lo, hi - lo)


def weigh(terms: pa.Array, idf: np.ndarray, sublinear_tf: bool):
    """Rows ``(id, pos, cells)``, cells of ``(term, tf)``, to ``(id, weights)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, row, at, tf, term in _looked_up(batches, terms):
            known = np.flatnonzero(at >= 0)
            yield _weights(name, ids, row[known], tf[known], idf[at[known]], term.take(pa.array(known)), sublinear_tf)
    return run


def number(terms: pa.Array):
    """Rows ``(id, pos, cells)`` to ``(id, at, tf, others)``: places in ``terms``, and the cells
    of all other terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, row, at, tf, term in _looked_up(batches, terms):
            known, other = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
            others = pa.StructArray.from_arrays([term.take(pa.array(other)), pa.array(tf[other])], ["term", "tf"])
            yield pa.RecordBatch.from_arrays(
                [ids, _listed(row[known], len(ids), pa.array(at[known], pa.int32())),
                 _listed(row[known], len(ids), pa.array(tf[known], pa.int32())), _listed(row[other], len(ids), others)],
                [name, "at", "tf", "others"])
    return run


def weigh_met(terms: pa.Array, idf: np.ndarray, sublinear_tf: bool):
    """Rows ``(id, pos, at, tf, rare)`` to ``(id, weights)``; cells of ``rare`` bring their idf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begin in documents(batches):
            for ids, of, a, b in _runs(rows, begin):
                lists, tfs, rares = (rows.column(c).slice(a, b - a) for c in ("at", "tf", "rare"))
                at = lists.flatten().to_numpy()
                term, tf, rare_idf = rares.flatten().flatten()
                row = np.concatenate([np.repeat(of, _lengths(lists)), np.repeat(of, _lengths(rares))])
                by = np.argsort(row, kind="stable")
                tf = np.concatenate([tfs.flatten().to_numpy(), tf.to_numpy()])[by]
                factor = np.concatenate([idf[at], rare_idf.to_numpy()])[by]
                term = pa.concat_arrays([terms.take(pa.array(at)), term]).take(pa.array(by))
                yield _weights(rows.schema.names[0], ids, row[by], tf, factor, term, sublinear_tf)
    return run

"""Periodic runs of words (operator 12).

A run is a maximal stretch of words that repeats with its smallest period. Here runs of at
least ``MIN_WORDS`` words and ``MIN_TIMES`` periods are found, and a text is collapsed by
dropping what a run repeats: its words after the first period.

**Method.** The grouping phase of Baier's suffix sorter visits groups of suffixes from the
largest to the smallest and moves the suffixes before them to longer contexts. When it
ends, the context of a suffix is its longest Lyndon prefix, so the phase gives the Lyndon
array without any suffix array; it is run under the order of the words and under the
reversed order. Every run holds a Lyndon root under one of the two, and a run of three
periods holds that root twice in a row. Such roots are extended to both sides by their
longest common extensions (array comparisons of growing length) and give the runs.

**Where to look.** All words of a run of 24 words and three periods lie in 8-word windows
that occur twice in the text, so only maximal stretches of such windows are searched. The
windows are compared by 64-bit hashes: a collision can add a stretch, never hide one, and
inside a stretch words are compared by their bytes. Texts without a repeated window, most
of a corpus, cost a sort of their window hashes.

Everything happens inside the task that reads a text: one narrow pass, nothing is shuffled,
and no group of texts meets anywhere. A task holds one block of texts (4 MB, or one longer
text); a single text cannot be split, its time and memory grow with its length.

Null and empty texts have no words and no runs. A null id is kept; texts are altered by
the query only where the id is known. Repeated rows give repeated results; extra columns
are ignored."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import textbytes as B

#: A run has at least so many words and so many periods.
MIN_WORDS = 24
MIN_TIMES = 3
#: Words of the windows that find stretches worth a search. A run's length less its period
#: is at least 16, so every window of a run occurs again within it.
WINDOW = 8

Run = tuple[int, int, int]  # start, length, period


def lyndon_array(ranks: Sequence[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place: phase one of Baier's
    grouping. ``ranks`` are compared as integers; the end is smaller than any of them.

    Groups are visited from the largest down. ``before[s]`` is the nearest earlier suffix of
    a group not yet visited; the group's context is appended to that suffix's own, once for
    every member it precedes, and suffixes that grow alike form a new group just above
    their old one."""
    n = len(ranks)
    members: dict[int, list[int]] = {}
    for i, r in enumerate(ranks):
        members.setdefault(r, []).append(i)
    groups = [members[r] for r in sorted(members)]
    context = [1] * len(groups)
    # neighbours in the order of groups: of the smaller and the larger side
    lower, upper = list(range(-1, len(groups) - 1)), [*range(1, len(groups)), -1]
    group = [0] * n
    for g, some in enumerate(groups):
        for i in some:
            group[i] = g
    visited, before, out = [False] * n, [-1] * n, [0] * n
    g = len(groups) - 1
    while g >= 0:
        own, length = [i for i in groups[g] if group[i] == g], context[g]
        for s in own:
            visited[s] = True
            out[s] = length
        times: dict[int, int] = {}
        for s in own:
            p = s - 1
            if p >= 0 and visited[p]:
                path = []
                while p >= 0 and visited[p]:
                    path.append(p)
                    p = before[p]
                for q in path:  # later walks take the short way
                    before[q] = p
            before[s] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, k in times.items():
            moved.setdefault((k, group[p]), []).append(p)
        top: dict[int, int] = {}
        # more repetitions are larger: each new group goes above those of fewer
        for (k, old), some in sorted(moved.items()):
            new, under = len(groups), top.get(old, old)
            above = upper[under]
            groups.append(some)
            context.append(context[old] + k * length)
            lower.append(under)
            upper.append(above)
            lower[above], upper[under] = new, new  # there is always a larger group: the present one
            top[old] = new
            for p in some:
                group[p] = new
        g = lower[g]
    return out


def _common(ids: np.ndarray, a: int, b: int, step: int) -> int:
    """How many places ``a, a + step, ...`` and ``b, b + step, ...`` agree (a < b)."""
    most = len(ids) - b if step > 0 else a + 1
    done, width = 0, 32
    while done < most:
        m = min(width, most - done)
        if step > 0:
            same = ids[a + done:a + done + m] == ids[b + done:b + done + m]
        else:
            same = (ids[a - done - m + 1:a - done + 1] == ids[b - done - m + 1:b - done + 1])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done, width = done + m, width * 2
    return done


def runs_of(words: Sequence[bytes], min_words: int = MIN_WORDS) -> list[Run]:
    """All runs of a sequence of words with at least ``min_words`` words and ``MIN_TIMES``
    periods, by start, then period."""
    known: dict[bytes, int] = {}
    order = [known.setdefault(w, len(known)) for w in words]
    ids, n = np.array(order, np.int64), len(order)
    found: set[Run] = set()
    for ranks in (order, [-r for r in order]):
        root = np.array(lyndon_array(ranks), np.int64)
        at = np.arange(n)
        at = at[at + root < n]
        at = at[root[at + root[at]] == root[at]]  # the root stands twice in a row
        last_end: dict[int, int] = {}
        for i in at.tolist():
            p = int(root[i])
            if i + p <= last_end.get(p, 0):
                continue  # shares a period with the run found last: the same run
            right = _common(ids, i, i + p, 1)
            left = _common(ids, i - 1, i + p - 1, -1) if i else 0
            last_end[p] = i + p + right
            length = left + right + p
            if length >= max(min_words, MIN_TIMES * p):
                found.add((i - left, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """``(text, from, to)``: maximal stretches of words, numbered in their text, that are
    covered by windows which occur again in it, of ``MIN_WORDS`` words at least."""
    windows, at = B.windows(hashes, first, WINDOW)
    if len(windows) < 2:
        return []
    row = B.row_of(at)
    key = B.mix(windows ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    some = np.flatnonzero(again)
    if not len(some):
        return []
    new = np.concatenate([[True], (np.diff(some) > 1) | (row[some[1:]] != row[some[:-1]])])
    heads = np.flatnonzero(new)
    tails = np.concatenate([heads[1:], [len(some)]]) - 1
    d, low, high = row[some[heads]], some[heads], some[tails]
    return [(x, a, b) for x, a, b in zip(d.tolist(), (low - at[d]).tolist(), (high - at[d] + WINDOW).tolist())
            if b - a >= MIN_WORDS]


def best_run(runs: Sequence[Run]) -> Run | None:
    """The run of the largest exact length / period, then smallest start, then period."""
    best = None
    for r in runs:
        if best is None or (r[1] * best[2], -r[0], -r[2]) > (best[1] * r[2], -best[0], -best[2]):
            best = r
    return best


Reorder = Callable[[int, int], np.ndarray | None]


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, word: np.ndarray, row: np.ndarray,
               n_rows: int) -> pa.Array:
    """The given words of each row, joined by one space."""
    data = np.concatenate([data, np.zeros(1, np.uint8)])
    last = np.ones(len(word), bool)
    last[:-1] = row[1:] != row[:-1]
    count = ends[word] - starts[word] + ~last
    body = data[B.ragged(starts[word], count)]
    end = np.cumsum(count)
    body[end[~last] - 1] = 0x20
    total = np.concatenate([[0], end])
    offsets = total[np.searchsorted(row, np.arange(n_rows + 1))].astype(np.int64)
    return pa.LargeStringArray.from_buffers(n_rows, pa.py_buffer(offsets), pa.py_buffer(body)).cast(pa.string())


def _run_batches(names: Sequence[str], reorder: Reorder | None):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in B.blocks(batch.column(batch.num_columns - 1)):
                part = batch.slice(begin, end - begin)
                starts, ends, first = B.spans(data, offsets, B.WHITE)
                word, n = np.arange(len(starts)), np.diff(first)
                if reorder is not None:
                    for d, i in enumerate(part.column(0).to_pylist()):
                        if i is not None and n[d] and (places := reorder(i, int(n[d]))) is not None:
                            word[first[d]:first[d + 1]] = first[d] + places
                hashes = B.span_hashes(data, starts, ends)[word]
                raw, found = data.tobytes(), [[] for _ in range(len(part))]
                kept = np.ones(len(word), bool)
                for d, a, b in stretches(hashes, first):
                    own = word[first[d] + a:first[d] + b]
                    for s, length, p in runs_of([raw[x:y] for x, y in zip(starts[own].tolist(), ends[own].tolist())]):
                        found[d].append((a + s, length, p))
                        kept[first[d] + a + s + p:first[d] + a + s + length] = False
                row = B.row_of(first)
                best = [best_run(r) for r in found]
                out = [pa.array(n, pa.int64()),
                       pa.array([[dict(zip(("start", "length", "period"), r)) for r in sorted(x, key=lambda r: (r[0], r[2]))]
                                 for x in found], kind),
                       pa.array([b and dict(zip(("start", "length", "period"), b)) for b in best], kind.value_type),
                       _collapsed(data, starts, ends, word[kept], row[kept], len(part))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *out], [*part.schema.names[:-1], *names])
    return run


def periodic_runs(docs: DataFrame, keep: Sequence[str] = ("doc_id",), *, prefix: str = "runs",
                  reorder: Reorder | None = None) -> DataFrame:
    """``keep`` columns and, in columns named after ``prefix`` that are none of them,
    ``_words`` (number of words), ``_all`` (array of start, length and period, by start, then
    period), ``_best`` (the run of largest length / period) and ``_text`` (the collapsed text).
    ``reorder`` may give, from the first kept column (an integer) and the number of words,
    the words to read instead, as their places."""
    text = f"{prefix}_input"
    rows = docs.select(*[f"`{c}`" for c in keep], F.col("text").cast("string").alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    names = [f"{prefix}_{x}" for x in ("words", "all", "best", "text")]
    run = "struct<start:bigint,length:bigint,period:bigint>"
    return rows.mapInArrow(_run_batches(names, reorder),
                           f"{fields}, `{names[0]}` bigint, `{names[1]}` array<{run}>, `{names[2]}` {run}, `{names[3]}` string")


def planted(doc_id: int, n: int) -> np.ndarray | None:
    """The words of a text with a planted period: one text in ten, by the hash of its id,
    repeats a stretch from some word to its end."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """All of ``documents``, one in ten with a planted period."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = periodic_runs(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), reorder=planted)
    listing = F.array_join(F.transform("runs_all", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listing = F.when(F.size("runs_all") > 0, F.concat(listing, F.lit("\n"))).otherwise("")
    best = F.col("runs_best")
    return found.select(
        "doc_id", F.size("runs_all").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("1000 * runs_best.length div runs_best.period").alias("exponent_milli"),
        F.sha2(listing.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("runs_text").cast("binary"), 256).alias("collapsed_sha256"))

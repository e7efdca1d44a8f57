"""Array helpers for text inside a task: a column of strings as one byte buffer.

Everything here works on one Arrow batch at a time, cut into blocks of a few MB, so
memory does not grow with the partition. Words, lines and word windows are found and
hashed for all documents of a block with a handful of numpy passes.

Hashes are 64 bits: a polynomial over the bytes modulo 2**64, mixed with the length.
Two different strings of one document meet with a chance of about n**2 / 2**65."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20

_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A lookup table over byte values: True inside any of the closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


WHITE = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Separators of words made of digits, letters a-z and every non-ASCII character.
NOT_WORD = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def buffer_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; nulls are empty texts."""
    strings = strings.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset:strings.offset + len(strings) + 1]
    body = strings.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(strings: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive documents of at most ``max_bytes`` together (one document at least):
    ``(first row, row after the last, bytes, offsets from 0)``."""
    if not len(strings):
        return
    data, offsets = buffer_of(strings)
    row, n = 0, len(strings)
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes outside ``separator`` that do not cross documents:
    ``(starts, ends, first)`` where document d owns spans ``first[d]:first[d + 1]``."""
    inside = ~separator[data]
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_MULT, _INV)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[i] = np.cumprod(step, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function from starts and ends to 64-bit hashes of the bytes between, for several
    sets of spans of one buffer."""
    up, down = _power(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=prefix[1:])

    def hashes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (prefix[ends] - prefix[starts]) * down[starts]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    return span_hasher(data)(starts, ends)


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k`` consecutive spans within a document, in order, and their
    ``first`` table. Window j of document d starts at its span j."""
    counts = np.maximum(np.diff(first) - (k - 1), 0)
    out_first = np.concatenate([[0], np.cumsum(counts)])
    if not out_first[-1]:
        return np.zeros(0, np.uint64), out_first
    m = len(hashes) - k + 1
    acc = hashes[:m].copy()
    for j in range(1, k):
        acc *= np.uint64(0xFF51AFD7ED558CCD)
        acc += hashes[j:j + m]
    at = np.arange(out_first[-1]) + np.repeat(first[:-1] - out_first[:-1], counts)
    return mix(acc[at]), out_first


def sort_within(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A copy with each document's values sorted."""
    out = values.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    return out


def row_of(first: np.ndarray) -> np.ndarray:
    """The document of each span."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive offsets, as int64."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + counts[i] - 1`` of all i, concatenated."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)

"""Token ids of whole texts by a word-end BPE file of the ``tokenizers`` library.

The tokenizer drops white space, so a text's ids are those of its white-space separated
words one after the other. Each task keeps the ids of the words it has met and encodes
a word once; the ids of a block of texts are then gathered with array operations.
Words of ASCII and Latin-1 characters are split here by the tokenizer's own pattern and
given to its merge model; all others, and words that hold one of the tokenizer's added
tokens (such as ``<|endoftext|>``), go through the whole tokenizer. Files
whose added tokens hold or take white space, or are matched in normalised text, are refused."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer, models

from wordmill.llm import textbytes as B

#: Words, and pre-tokens, kept by a task; when there are more, the table starts anew.
MAX_WORDS = 2_000_000


def _byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters stand for themselves, the rest for U+0100 onwards."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encodes blocks of texts; one per task."""

    def __init__(self, body: bytes, max_words: int = MAX_WORDS):
        self.whole = Tokenizer.from_str(body.decode())
        spec = json.loads(body)
        added = spec.get("added_tokens", [])
        if any(t["content"] != "".join(t["content"].split()) or t.get("lstrip") or t.get("rstrip") or t.get("normalized") for t in added):
            raise ValueError("an added token of the tokenizer holds or takes white space, or is matched after normalising")
        self.added = [t["content"] for t in added]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        model = spec["model"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.merge = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges,
                                          end_of_word_suffix=model["end_of_word_suffix"]))
        # one pass over many words: each ends with a line break, which no pre-token holds
        self.split = regex.compile(split + r"|\n")
        self.alphabet = {**dict(enumerate(_byte_alphabet())), 10: "\n"}
        self.max_words = max_words
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of known words
        self.at = np.zeros(0, np.int64)     # their place in the pool, and number of ids
        self.n = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self._clear_pieces()

    def _clear_pieces(self) -> None:
        self.pieces = {"\n": 0}             # known pre-tokens, and the ids of each as above
        self.piece_n = np.zeros(1, np.int64)
        self.piece_at = np.zeros(1, np.int64)
        self.piece_pool = np.zeros(0, np.uint32)

    def _learn_pieces(self, new: list[str]) -> None:
        """Merge unknown pre-tokens."""
        known = len(self.pieces)
        self.pieces.update(zip(new, range(known, known + len(new))))
        letters = "\n".join(new).encode().decode("latin-1").translate(self.alphabet).split("\n")
        pool, counts = [self.piece_pool], []
        for a in range(0, len(letters), 4096):
            some = letters[a:a + 4096]
            got = self.merge.encode(some, is_pretokenized=True, add_special_tokens=False)
            pool.append(np.array(got.ids, np.uint32))
            counts.append(np.bincount(np.array(got.word_ids, np.int64), minlength=len(some)))
        n = np.concatenate(counts)
        self.piece_at = np.concatenate([self.piece_at, len(self.piece_pool) + np.cumsum(n) - n])
        self.piece_n = np.concatenate([self.piece_n, n])
        self.piece_pool = np.concatenate(pool)

    def _encode_plain(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, number of ids of each word)`` of ASCII and Latin-1 words, each followed by
        a line break."""
        found = self.split.findall(text.lower())
        if len(self.pieces) > self.max_words:
            self._clear_pieces()
        new = [p for p in dict.fromkeys(found) if p not in self.pieces]
        if new:
            self._learn_pieces(new)
        piece = np.fromiter(map(self.pieces.__getitem__, found), np.int64, len(found))
        n = self.piece_n[piece]
        total = np.cumsum(n)[piece == 0]
        return self.piece_pool[B.ragged(self.piece_at[piece], n)], np.diff(total, prepend=0)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Add the words between ``starts`` and ``ends``, which have these hashes."""
        size = ends - starts + 1
        first = np.cumsum(size) - size
        lines = np.full(int(size.sum()), 10, np.uint8)
        lines[B.ragged(first, size - 1)] = data[B.ragged(starts, size - 1)]
        # bytes of control characters and of characters beyond U+00FF: C2 below A1, leads from C4
        odd = (lines < 0x21) & (lines != 10) | (lines == 0x7F) | (lines >= 0xC4)
        odd[1:] |= (lines[:-1] == 0xC2) & (lines[1:] < 0xA1)
        whole = np.add.reduceat(odd, first, dtype=np.int64) > 0
        raw = lines.tobytes()
        if any(t.encode() in raw for t in self.added):
            for i, w in enumerate(raw.split(b"\n")[:-1]):
                whole[i] |= any(t.encode() in w for t in self.added)
        n, ids = np.zeros(len(size), np.int64), []
        if not whole.all():
            got, n[~whole] = self._encode_plain(raw.decode() if not whole.any() else
                                                lines[B.ragged(first[~whole], size[~whole])].tobytes().decode())
            ids.append(got)
        for i in np.flatnonzero(whole).tolist():
            got = self.whole.encode(raw[first[i]:first[i] + size[i] - 1].decode(), add_special_tokens=False).ids
            n[i] = len(got)
            ids.append(np.array(got, np.uint32))
        # the pool holds the plain words first
        order = np.argsort(whole, kind="stable")
        at = np.zeros(len(size), np.int64)
        at[order] = len(self.pool) + np.cumsum(n[order]) - n[order]
        self.pool = np.concatenate([self.pool, *ids])
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.at = np.concatenate([self.at, at])[order]
        self.n = np.concatenate([self.n, n])[order]

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, first)``: document d has ids ``first[d]:first[d + 1]``."""
        starts, ends, first = B.spans(data, offsets, B.WHITE)
        hashes = B.span_hashes(data, starts, ends)
        unique, sample, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > self.max_words:
            self._clear()
        place = np.searchsorted(self.keys, unique)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == unique[known]
        if not known.all():
            self._learn(unique[~known], data, starts[sample[~known]], ends[sample[~known]])
            place = np.searchsorted(self.keys, unique)
        n = self.n[place][back]
        ids = self.pool[B.ragged(self.at[place][back], n)]
        total = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=total[1:])
        return ids, total[first]


def encoded_blocks(batches: Iterator[pa.RecordBatch], body: bytes) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Per block of rows ``(rows, ids, first)``; the text is the last column."""
    coder = WordBpe(body)
    for batch in batches:
        for row, end, data, offsets in B.blocks(batch.columns[-1]):
            ids, first = coder.encode_block(data, offsets)
            yield batch.slice(row, end - row), ids, first

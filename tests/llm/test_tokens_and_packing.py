"""Tokenisers, packing and token output against the libraries and plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from wordmill.llm import byte_bpe, packing, token_output, wordbpe

RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tik():
    with open(RANKS, "rb") as f:
        return byte_bpe._encoding(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


def noise(n, seed, parts):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(parts) for _ in range(rnd.choice([0, 1, 50, 300, 700]))) for _ in range(n)]


STITCH = ["a", "b", " ", "  ", "\n", "'re", "'", "'ll", "1", "é", "世", "!", " ", "\t", "😀"]


@pytest.mark.parametrize("chunk,overlap", [(64, 32), (40, 30)])
def test_stitched_chunks_equal_the_whole_text(spark, tik, chunk, overlap):
    texts = noise(120, 1, STITCH) + [None, "", "a" * 700, " " * 700 + "x", "ab " * 20 + "z" * 500 + " cd" * 60, "\n" * 333]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = byte_bpe.decode(byte_bpe.encode(d, RANKS, P.PATTERN, chunk=chunk, overlap=overlap), RANKS).collect()
    got = {r["doc_id"]: (bytes(r["ids"]), bytes(r["decoded"])) for r in out}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == (np.array(tik.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode())


def test_byte_bpe_query_equals_the_library(spark, tik, odd, empty, sf):
    rows = {r["doc_id"]: r for r in byte_bpe.op3_byte_bpe(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = np.array(tik.encode_ordinary(r["text"]), "<u4")
        q = rows[r["doc_id"]]
        assert (q["n_tokens"], q["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert q["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
    assert byte_bpe.encode(odd, RANKS, P.PATTERN).count() == odd.count()
    assert byte_bpe.encode(empty, RANKS, P.PATTERN).count() == 0


def test_word_table_equals_the_library(words):
    parts = [*"abAB zZ'.!?19  \n\t", "'s", "'LL", "é", "É", "ß", "ñ", "ı", "İ", "Σ", "ς", "世", "😀", "́", "\xa0",
             " ", "²", "ª", "\xad", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof", "Å", "½", "_", "-"]
    texts = noise(400, 2, parts) + [""]
    with open(WORDS, "rb") as f:
        coder = wordbpe.WordBpe(f.read(), max_words=500)  # small: the table starts anew often
    import pyarrow as pa
    from wordmill.llm import textbytes as B
    got = []
    for _, _, data, offsets in B.blocks(pa.array(texts), 4_000):
        ids, first = coder.encode_block(data, offsets)
        got += [ids[a:b].tolist() for a, b in zip(first, first[1:])]
    assert got == [words.encode(t, add_special_tokens=False).ids for t in texts]


def test_special_tokens_are_the_tokenizers(words):
    import pyarrow as pa
    from wordmill.llm import textbytes as B
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|>x<|endoftext|>", "<|endoftext|><|endoftext|>",
             "é<|endoftext|>世", "<|ENDOFTEXT|>", "<| endoftext |>", "<|endoftext|", "\n<|startoftext|>\t"]
    with open(WORDS, "rb") as f:
        coder = wordbpe.WordBpe(f.read())
    _, _, data, offsets = next(iter(B.blocks(pa.array(texts))))
    ids, first = coder.encode_block(data, offsets)
    got = [ids[a:b].tolist() for a, b in zip(first, first[1:])]
    assert got == [words.encode(t, add_special_tokens=False).ids for t in texts]
    assert got[0] == [320, 49407, 321]


def check_packing(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for segments in by.values():
        at = 0
        for offset, length in sorted(segments):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_query(spark, words, sf):
    rows = packing.op6_best_fit_packing(spark, sf).collect()
    n = check_packing(rows, 2048)
    assert n <= -(-sum(r["length"] for r in rows) // 2048) * 1.01 + 1
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = np.array(words.encode(r["text"], add_special_tokens=False).ids + [0], "<u4")
        want = [(i, 2048 * i, len(ids[2048 * i:2048 * (i + 1)]), zlib.crc32(ids[2048 * i:2048 * (i + 1)].tobytes()))
                for i in range(-(-len(ids) // 2048))]
        assert sorted(by[r["doc_id"]]) == want


def test_tree_merge_of_small_groups(spark, odd, empty):
    rnd = random.Random(1)
    lengths = [rnd.randint(1, 100) for _ in range(900)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long").repartition(5)
    out = packing.pack(items, 100, group_items=20, fan_in=3).collect()
    assert sorted(r["item"] for r in out) == list(range(900))
    n = check_packing([{"sequence_id": r["bin"], "offset": r["offset"], "length": lengths[r["item"]]} for r in out], 100)
    assert n <= -(-sum(lengths) // 100) * 1.12
    rows = packing.pack_documents(odd, WORDS, 64).collect()
    check_packing(rows, 64)
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r["doc_id"] for r in odd.select("doc_id").collect())
    assert packing.pack_documents(empty, WORDS).count() == 0


def test_segment_tree_finds_the_tightest_room():
    rnd = random.Random(2)
    for capacity in (1, 7, 8, 100):
        tree, free = token_output.RoomTree(capacity), []
        for i in range(400):
            if rnd.random() < 0.6:
                room = rnd.randint(1, capacity)
                tree.add(room, i)
                free.append((room, i))
            else:
                need = rnd.randint(1, capacity)
                fits = [r for r, _ in free if r >= need]
                got = tree.take(need)
                assert (got[0] if got else None) == (min(fits) if fits else None)
                if got:
                    free.remove(got)


def test_best_fit_decreasing_equals_a_plain_one():
    rnd = random.Random(4)
    lengths = np.array([rnd.randint(1, 50) for _ in range(500)])
    rooms = []
    for n in sorted(lengths.tolist(), reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(50 - n)
    _, _, n_rows = token_output.best_fit_decreasing(lengths, 50)
    assert n_rows == len(rooms) == len(packing.best_fit(lengths, 50)[2])


def test_matrix_round_trip(spark, words, some_texts, odd, empty):
    d = spark.createDataFrame([(i, t) for i, t in some_texts.items()] + [(10_000, None), (10_001, "")], "doc_id long, text string")
    packed = token_output.pack(d, WORDS, 300, 20_000)
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_output.unpack(packed).collect()}
    assert got == {r["doc_id"]: words.encode(r["text"] or "", add_special_tokens=False).ids for r in d.collect()}
    for r in packed.collect():
        ids, pos, cu = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["positions"], "<u4"), r["cu_seqlens"]
        assert len(ids) == len(pos) == 300 and cu[0] == 0 and cu[-1] == r["n_tokens"] <= 300
        assert pos[:cu[-1]].tolist() == [j for a, b in zip(cu, cu[1:]) for j in range(b - a)]
        assert not ids[cu[-1]:].any() and len(cu) == len(r["doc_ids"]) + 1
    assert sum(len(r["doc_ids"]) for r in token_output.pack(odd, WORDS).collect()) >= odd.count()
    assert token_output.pack(empty, WORDS).count() == 0


def test_token_query_covers_the_table(spark, sf):
    rows = token_output.op7_token_output(spark, sf).collect()
    firsts = [d for r in rows for d, p in zip(r["doc_ids"], r["pieces"]) if p == 0]
    assert sorted(firsts) == sorted(r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect())

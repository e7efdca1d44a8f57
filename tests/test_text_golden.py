"""Golden rows for the column functions (T1-T8, T11-T15) on hand-written edge strings."""

import json

import pytest
from pyspark.sql import functions as F

from wordmill.functions import fixed
from wordmill.functions import text as T
from wordmill.operators import tokens as TK


def one(spark, value, expr):
    df = spark.createDataFrame([(value,)], "s string")
    return df.select(expr(F.col("s")).alias("r")).first()["r"]


@pytest.mark.parametrize("s,expected", [
    ("", []), ("   ", []), ("don't", ["don", "t"]), ("abc123 a_b 42", ["abc123", "a_b", "42"]),
    ("Café naïve", ["Café", "naïve"]), ("東京 タワー", ["東京", "タワー"]),
    ("a\r\nb c", ["a", "b", "c"]), ("--x--", ["x"]),
])
def test_word_split(spark, s, expected):
    assert one(spark, s, T.word_split) == expected


@pytest.mark.parametrize("s,expected", [
    ("", []), (" \t ", []), ("A b C　d\r\ne", ["a", "b", "c", "d", "e"]),
    ("x y\u0085z", ["x", "y", "z"]), ("don't stop", ["don't", "stop"]),
])
def test_whitespace_tokens(spark, s, expected):
    assert one(spark, s, T.whitespace_tokens) == expected


@pytest.mark.parametrize("w,expected", [
    ("NASA", "NASA"), ("HelloWorld", "HelloWorld"), ("Hello", "hello"), ("ABc", "ABc"),
    ("hello", "hello"), ("ÉCOLE", "école"),
])
def test_abbr_or_lower(spark, w, expected):
    assert one(spark, w, T.abbr_or_lower) == expected


def test_strip_and_filters(spark):
    assert one(spark, "(hello)!", T.strip_non_word) == "hello"
    assert one(spark, "a_b-c", T.strip_non_word) == "a_bc"
    df = spark.createDataFrame([(["abc", "123", "été", "東京", "a1"],)], "a array<string>")
    r = df.select(T.keep_ascii_letter_tokens(F.col("a")).alias("x"),
                  T.keep_alpha_tokens(F.col("a")).alias("y")).first()
    assert r["x"] == ["abc", "été", "a1"]
    assert r["y"] == ["abc", "été", "東京"]


@pytest.mark.parametrize("reply,expected", [
    ("3", 3), (" 3 ", 3), ("+3", 3), ("joy", None), ("3.7", None), ("1_0", None), ("7", 7),
    ("-2", -2), (" 3\n", 3), ("", None),
])
def test_parse_int_reply(spark, reply, expected):
    assert one(spark, reply, T.parse_int_reply) == expected


def test_clean_generated(spark):
    assert one(spark, "  Hello\r\nWorld\n ", T.clean_generated) == "hello world"


def test_generation_prompts(spark):
    j = one(spark, "joy", T.json_generation_prompt)
    assert j == json.dumps({"instruction": fixed.GENERATION_INSTRUCTION, "emotion": "joy",
                            "notice": fixed.GENERATION_NOTICE})
    assert one(spark, "fear", T.plain_generation_prompt) == "Generate a text expressing fear."


def test_classification_prompt_layout(spark):
    df = spark.createDataFrame([("I am happy", "Text: x\nEmotion: 1\n\n")], "t string, fs string")
    with_examples = df.select(T.classification_prompt("t", F.col("fs")).alias("p")).first()["p"]
    header = "\n\n".join(f"{k}: {v}" for k, v in fixed.PROMPT_BLOCKS)
    assert with_examples == (header + "\n\nHere are some examples:\nText: x\nEmotion: 1\n\n"
                             + "\nText: I am happy\n\nEmotion:")
    no_examples = df.select(T.classification_prompt("t", F.lit("")).alias("p")).first()["p"]
    assert no_examples == header + "\nText: I am happy\n\nEmotion:"
    assert "{'0': 'sadness', '1': 'joy'" in header


def test_preprocess_mode0_and_lexicon(spark):
    df = spark.createDataFrame([(0, "The NASA rockets were launched in 2020, don't worry!"), (1, "")],
                               "doc_id long, text string")
    out = {r["doc_id"]: r["tokens"] for r in TK.preprocess(df, mode=0).collect()}
    assert out == {0: "nasa rockets launched worry", 1: ""}
    lex = spark.createDataFrame([("rockets", "rocket"), ("launched", "launch")], "token string, base string")
    out2 = {r["doc_id"]: r["tokens"] for r in TK.preprocess(df, mode=1, lexicon=lex).collect()}
    assert out2 == {0: "nasa rocket launch worry", 1: ""}


def test_encode_ids_pads_and_truncates(spark):
    df = spark.createDataFrame([(0, ["b", "a", "zz"]), (1, ["a"] * 200)], "doc_id long, tokens array<string>")
    vocab = TK.sorted_vocab_ids(df.select(F.explode("tokens").alias("token")))
    enc = {r["doc_id"]: r for r in TK.encode_ids(df, vocab, max_len=8).collect()}
    assert enc[0]["input_ids"] == [2, 1, 3, 0, 0, 0, 0, 0]
    assert enc[0]["attention_mask"] == [1, 1, 1, 0, 0, 0, 0, 0]
    assert enc[1]["input_ids"] == [1] * 8 and enc[1]["attention_mask"] == [1] * 8


def test_stopword_list_is_fixed():
    assert len(fixed.ENGLISH_STOPWORDS) == 179
    assert len(set(fixed.ENGLISH_STOPWORDS)) == 179


def test_lexicon_with_repeated_tokens_keeps_the_rows(spark):
    toks = spark.createDataFrame([(1, 0, "cats"), (1, 1, "dog")], "doc_id long, pos int, token string")
    lex = spark.createDataFrame([("cats", "cat"), ("cats", "cata")], "token string, base string")
    out = [(r["pos"], r["token"]) for r in TK.apply_lexicon(toks, lex).orderBy("pos").collect()]
    assert out == [(0, "cat"), (1, "dog")]


def test_unknown_tokens_keep_their_place(spark):
    d = spark.createDataFrame([(1, ["a", "zz", "b", "a"]), (2, [])], "doc_id long, tokens array<string>")
    vocab = spark.createDataFrame([("a", 1), ("b", 2)], "token string, id long")
    got = {r["doc_id"]: (list(r["input_ids"]), list(r["attention_mask"])) for r in
           TK.encode_ids(d, vocab, max_len=3, unknown_id=9).collect()}
    assert got == {1: ([1, 9, 2], [1, 1, 1]), 2: ([0, 0, 0], [0, 0, 0])}


def test_modes_above_two_are_lemma(spark):
    d = spark.createDataFrame([(1, "Cats sat")], "doc_id long, text string")
    lex = spark.createDataFrame([("cats", "cat")], "token string, base string")
    a, b = (TK.preprocess(d, mode=m, lexicon=lex).first()["tokens"] for m in (2, 5))
    assert a == b == "cat sat"


def test_preprocess_with_a_lexicon_exchanges_tokens_once(spark):
    d = spark.createDataFrame([(1, "the cats run"), (1, "Dogs of war"), (2, None), (3, ""), (4, "the of")], "doc_id long, text string")
    lex = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "token string, base string")
    for mode in (1, 2):
        out = TK.preprocess(d, mode=mode, lexicon=lex, join=False)
        got = sorted((r["doc_id"], r["tokens"]) for r in out.collect())
        assert got == [(1, ["cat", "run"]), (1, ["dog", "war"]), (2, []), (3, []), (4, [])]
        plan = TK.preprocess(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), mode=mode, lexicon=lex)
        plan = plan._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(_wm_row" in plan

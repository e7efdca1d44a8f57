import random

import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def some_texts(spark):
    """A few hundred whole documents of the test table, by id."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").filter("doc_id < 200").collect()
    return {r["doc_id"]: r["text"] for r in rows}


#: Texts on which every operator has a defined result.
ODD_TEXTS = [None, "", " \t\n", "a", "a b c", "a\nb\na\n\n", "é ß ñ 世界 😀", "x" * 20_000, "word " * 9_000,
             "All rights reserved. CC-BY", "the same text here, twice told", "the same text here, twice told"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and extra
    columns whose names clash with those the operators add."""
    rnd = random.Random(3)
    rows = [(i if t is not None else None, t, rnd.choice(["en", None]), rnd.random(), "x", 1, True)
            for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[4], rows[4]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, label string, "
                                       "n_words int, kept boolean").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")

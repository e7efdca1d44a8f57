"""Driver contract: entry() runs, every query has an ID from the survey, and a set of
queries equals its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, canon

FAST = ["v7_tfidf", "k1_top_terms_per_doc", "t10_preprocess", "m1_sample_fraction", "m4_stratified_fraction",
        "v6_class_top_words", "a5_metrics_by_method", "l6_contrastive_pairs", "l10_prompt_classify",
        "v14_dense_matrix", "r4_extend_single_points", "l11_generate"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "rank", "term", "weight"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 80


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, "/root/testdata/sf0.001")
    res = duck.execute(entry.oracle_sql()[name])
    a = canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    b = canon([d[0] for d in res.description], res.fetchall())
    assert a == b

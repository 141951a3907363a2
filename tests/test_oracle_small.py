"""Registered queries against their DuckDB oracle SQL on the smallest fixture."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from oracle_check import TABLES, frame_hash  # noqa: E402

from conftest import SF001  # noqa: E402

QUICK = ["a22_class_top_terms", "a2_describe", "a5_value_shares", "a8_segment_error", "a15_histogram",
         "a18_box_stats", "x23_topic_clean", "x20_bigram_counts", "f6_tfidf_sublinear", "f7_random_split",
         "f8_stratified_split", "f9_stratified_folds", "f11_undersample", "e8_roc_auc", "e11_pr_curve",
         "e12_threshold_sweep", "e19_top_contributions", "t11_umass_coherence", "t3_dominant_topic",
         "x15_lemmatized_tokens", "j4_knn_minority"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    sp = E.queries()[name](spark, SF001).toPandas()
    dk = duck.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert frame_hash(sp) == frame_hash(dk)

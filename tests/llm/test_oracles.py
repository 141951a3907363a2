"""The training-data queries against their SQL in DuckDB, on whole tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from oracle_check import TABLES, frame_hash  # noqa: E402

from caliper.llm import queries as Q  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_matches_sql(spark, duck, name):
    got, want = Q.QUERIES[name](spark, SF).toPandas(), duck.execute(Q.SQL[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) > 0
    assert frame_hash(got) == frame_hash(want)


def test_every_operator_has_one_query():
    numbers = sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES)
    assert numbers == list(range(1, 14))


def test_decontaminate_items_without_id(spark, tmp_path):
    """An item without an id contaminates, but is not listed; in the query and in its SQL."""
    item, other = " ".join(f"w{i}" for i in range(12)), " ".join(f"v{i}" for i in range(11))
    spark.createDataFrame([(1, f"x {item} y"), (2, "clean"), (3, None), (4, f"{item} {other}"), (None, other)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, item), (7, other), (8, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    # the join of the twin's last step needs ids, so the document without one is compared by hand
    got = Q.QUERIES["op4_decontaminate"](spark, str(tmp_path)).toPandas()
    want = con.execute(Q.SQL["op4_decontaminate"]).fetchdf()
    assert frame_hash(got[got.doc_id.notna()].astype({"doc_id": int})) == frame_hash(want[want.doc_id.notna()].astype({"doc_id": int}))
    assert got.set_index("doc_id").n_hit.to_dict().items() >= {1: 12, 2: 0, 3: 0, 4: 23}.items() and got.n_hit.sum() == 46

"""Registered queries next to their SQL at the smallest scale. DESKLOOM_ALL=1 runs every one."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("DESKLOOM_SF", "/root/testdata/sf0.001")
TABLES = ["events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
QUICK = [
    "brand_stats", "first_reply", "clean_text", "classify_compound", "classify_max_score", "problem_signals",
    "tfidf_topk", "tfidf_topk_pruned", "class_report", "kappa_quadratic", "stratified_split", "cluster_examples", "triage",
]
NAMES = list(entry.oracle_sql()) if os.environ.get("DESKLOOM_ALL") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def rows(frame):
    def cell(v):
        if v is None or v != v:
            return "null"
        return f"{v:.6f}" if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sql, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = sql.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

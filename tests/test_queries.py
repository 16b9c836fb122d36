"""Every registered query next to its SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
from tools.check import rows_of

duckdb = pytest.importorskip("duckdb")

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")
ORACLE = entry.oracle_sql()
QUERIES = {n: f for n, f in entry.queries().items() if f.__module__.startswith("workload.")}
# whole jobs and streams take several seconds each; ALL_QUERIES=1 runs those too that share their path with one run here
RUN = {"login_clean", "order_clean", "order_clean_totals", "agency_order_join", "ad_click_run", "log_load", "stream_first_event", "stream_login", "stream_dedupe_ttl"}
HEAVY = {n for n, f in QUERIES.items() if f.__module__ in ("workload.q_jobs", "workload.q_streams")} - RUN
CHOSEN = sorted(QUERIES if os.environ.get("ALL_QUERIES") else set(QUERIES) - HEAVY)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLE[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(names, rel.fetchall())


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0

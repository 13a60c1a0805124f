"""The contract's three functions, and all core queries on the smallest tables where these are present."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from decidra.plans import registry

TABLES = Path("/root/testdata/sf0.001")


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(registry.oracle_sql()) > 60


@pytest.mark.skipif(not TABLES.exists(), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", ["split_statistics", "training_mass", "budget_allocate", "greedy_chunks", "lineage_families", "metrics_grouping_sets", "skip_ledger", "jaccard_pairs", "named_checks", "stream_ledger"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in TABLES.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    got = entry.queries()[name](spark, str(TABLES))
    rel = con.sql(entry.oracle_sql()[name])
    at = [rel.columns.index(c) for c in got.columns]
    norm = lambda v: round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    assert sorted(str([norm(x) for x in r]) for r in got.collect()) == sorted(str([norm(r[i]) for i in at]) for r in rel.fetchall())


@pytest.mark.skipif(not TABLES.exists(), reason="the driver's tables are not here")
def test_entry(spark):
    assert entry.entry(spark).count() > 0

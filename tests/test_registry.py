"""Every registered query against its SQL oracle on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import TABLES, bag
from tests.conftest import SMALL

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    cursor = db.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_shuffle_join_between_the_growing_tables_and_pruned_scans(spark):
    plan = QUERIES["sla_by_day_location"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "WindowGroupLimit" in plan
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    item = next(line for line in scans if "l_orderkey" in line)
    assert "l_returnflag" not in item and "PushedFilters: [IsNotNull(l_orderkey)" in item
    assert "Cartesian" not in plan and "NestedLoop" not in plan

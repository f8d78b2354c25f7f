"""Every registered query against its SQL counterpart on the smallest given tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from check_oracle import normal
from matchflow.plans.catalog import TABLES

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    got, want = QUERIES[name](spark, FOLDER).toPandas(), db.sql(ORACLE[name]).df()
    pd.testing.assert_frame_equal(normal(got), normal(want), check_dtype=False)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_no_python_in_batch_plans(spark, capsys):
    for name in ("cumulative_match_stats", "lap_feature_table", "over_feature_table", "describe_numeric", "possession_current"):
        QUERIES[name](spark, FOLDER).explain()
    plans = capsys.readouterr().out
    assert "Python" not in plans and "Cartesian" not in plans and "NestedLoop" not in plans

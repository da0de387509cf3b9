"""Every query with SQL gives the same columns and values as that SQL."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from studytrace.checks.oracle import ORACLE

TABLES = ("customer", "events", "lineitem", "orders", "part")


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normalised(rows, columns):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in places) for row in rows)


def test_every_sql_text_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, sql, name):
    got = queries()[name](spark, sf_dir)
    expected = sql.execute(ORACLE[name])
    columns = [item[0] for item in expected.description]
    assert sorted(got.columns) == sorted(columns)
    assert normalised([tuple(r) for r in got.collect()], got.columns) == normalised(
        expected.fetchall(), columns
    )


def test_entry(spark):
    assert "v_upid_acc" in entry(spark).columns


def test_sorted_output_is_sorted(spark, sf_dir):
    rows = queries()["preprocess_log"](spark, sf_dir).collect()
    keys = [(r["timestamp_TW"], r["uuid"], r["upid"]) for r in rows]
    assert keys == sorted(keys)


def test_scores_are_probabilities(spark, sf_dir):
    row = queries()["benchmark_score"](spark, sf_dir).first()
    assert 0.0 <= row["test_score"] <= 1.0

"""Every corpus query with SQL gives the same columns and values as that SQL."""

from __future__ import annotations

import duckdb
import pytest

from studytrace.llm.queries import QUERIES, SQL

TABLES = ("documents", "embeddings", "conversations", "labels")


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normalised(rows, columns):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in places) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, sql, name):
    got = QUERIES[name](spark, sf_dir)
    expected = sql.execute(SQL[name])
    columns = [item[0] for item in expected.description]
    assert sorted(got.columns) == sorted(columns)
    assert normalised([tuple(r) for r in got.collect()], got.columns) == normalised(expected.fetchall(), columns)

"""Every registered query on tables with nulls, repeats and clashing columns, and on none."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from studytrace.llm.queries import QUERIES

#: Queries of documents that return one row per document row.
BY_DOCUMENT = [name for name in QUERIES if name.split("_")[0] not in ("op2", "op3", "op11", "op12")]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory, awkward, empty, no_labels):
    root = tmp_path_factory.mktemp("tables")
    labels = spark.createDataFrame(
        [(3, 1, 1), (9, 0, 0), (None, 1, 1), (5, None, None), (3, 1, 0)], no_labels.schema
    )
    vectors = spark.createDataFrame(
        [(0, [1.0, 2.0]), (50, [2.0, -1.0]), (50, [2.0, -1.0]), (None, [0.5, 0.5]), (1, None), (2, [None, 1.0])],
        "vec_id long, embedding array<float>",
    ).withColumn("x", F.lit("taken"))
    turns = spark.createDataFrame(
        [(1, None, None, None), (1, 0, "u", "x"), (1, 0, "u", "x"), (None, 0, "u", "y"), (100, 0, "u", "")],
        "conv_id long, turn long, role string, text string",
    ).withColumn("d", F.lit("taken"))
    tables = {"documents": awkward, "labels": labels, "embeddings": vectors, "conversations": turns}
    for name, df in tables.items():
        df.write.parquet(f"{root}/some/{name}.parquet")
        df.limit(0).write.parquet(f"{root}/none/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, folders, name):
    assert QUERIES[name](spark, f"{folders}/none").collect() == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_awkward_rows_are_all_answered(spark, folders, awkward_rows, name):
    got = QUERIES[name](spark, f"{folders}/some").collect()
    if name in BY_DOCUMENT:
        assert sorted(repr(r["doc_id"]) for r in got) == sorted(repr(r[0]) for r in awkward_rows)
    else:
        assert got

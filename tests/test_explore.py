from __future__ import annotations

import numpy as np
import pytest

from studytrace.operators.explore import (
    column_profile,
    correlation_matrix,
    distinct_values,
    with_category_codes,
    with_fixed_codes,
)


def test_codes_follow_the_sorted_domain(spark):
    user = spark.createDataFrame(
        [("male",), ("female",), (None,), ("unspecified",)], "gender string"
    )
    rows = spark.createDataFrame(
        [(0, "male"), (1, None), (2, "female"), (3, "unspecified"), (4, "new")],
        "row_id int, gender string",
    )
    got = with_category_codes(rows, {"gender": user}).collect()
    assert {r["row_id"]: r["gender"] for r in got} == {0: 1, 1: -1, 2: 0, 3: 2, 4: -1}


def test_codes_use_the_whole_domain_not_the_rows_at_hand(spark):
    domain = spark.createDataFrame([("a",), ("b",), ("c",)], "x string")
    rows = spark.createDataFrame([("c",)], "x string")
    assert with_category_codes(rows, {"x": domain}).first()["x"] == 2


def test_fixed_codes(spark):
    rows = spark.createDataFrame(
        [("unspecified", "unset", "elementary"), ("female", "hard", "senior"), ("x", None, "junior")],
        "gender string, difficulty string, learning_stage string",
    )
    assert [tuple(r) for r in with_fixed_codes(rows).collect()] == [
        (0, 0, 0),
        (2, 3, 2),
        (None, None, 1),
    ]


def test_correlation_matches_numpy_and_nulls_constants(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(1e6, 1, 500)
    y = 0.3 * x + rng.normal(size=500)
    rows = [(float(a), float(b), 7, True) for a, b in zip(x, y)] + [(None, 1.0, 7, True)]
    df = spark.createDataFrame(rows, "x double, y double, c int, b boolean")
    got = {
        (r["column_a"], r["column_b"]): r["correlation"]
        for r in correlation_matrix(df, ["x", "y", "c", "b"]).collect()
    }
    assert len(got) == 16
    assert got["x", "y"] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-12)
    assert got["x", "y"] == got["y", "x"]
    assert got["x", "x"] == pytest.approx(1.0)
    assert got["c", "c"] is None and got["x", "c"] is None and got["b", "y"] is None


def test_correlation_of_no_rows(spark):
    df = spark.createDataFrame([], "x double, y double")
    assert {r["correlation"] for r in correlation_matrix(df, ["x", "y"]).collect()} == {None}


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in column_profile(df).orderBy("position").collect()] == [
        (0, "a", "int", 2, 2),
        (1, "b", "string", 1, 2),
    ]


def test_distinct_values(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (2, "x")], "a int, b string")
    got = {tuple(r) for r in distinct_values(df, ["a", "b"]).collect()}
    assert got == {("a", "1"), ("a", "2"), ("b", "x"), ("b", None)}

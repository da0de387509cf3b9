from __future__ import annotations

import math
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from studytrace.operators import selection
from studytrace.operators.assemble import (
    CONCEPT_BLOCK,
    feature_assembler,
    interaction,
    one_hot,
    shifted_block,
    sparse_block,
)
from studytrace.operators.scaling import (
    entry_bounds,
    implicit_values,
    scale_entries,
    scale_scalars,
)
from studytrace.operators.selection import (
    find_cut,
    head_in_order,
    head_percent,
    train_test_split,
)
from studytrace.plans.training import scaled_vectors, split_rows

SPLIT_SCHEMA = (
    "row_id bigint, user_grade int, female int, male int, unspecified int,"
    " v_upid_acc double, level int, problem_number int,"
    " exercise_problem_repeat_session int, is_correct boolean,"
    " concept_idx int, concept_level int, level4_idx int, level4_proficiency bigint"
)


@pytest.fixture(scope="module")
def split_log(spark):
    return spark.createDataFrame(
        [
            (0, 5, 1, 0, 0, 0.2, 1, 1, 0, True, 0, 1, 0, 0),
            (1, 6, 0, 1, 0, 0.4, 2, 2, 1, False, 1, 2, 0, 1),
            (2, 5, 1, 0, 0, 0.6, 3, 3, 0, True, 0, 3, 0, 2),
            (3, 6, 0, 1, 0, 0.8, 4, 4, 1, False, 1, 4, 0, 3),
            (4, 7, 0, 0, 1, 1.0, 5, 5, 0, True, 0, 5, 0, 4),
        ],
        SPLIT_SCHEMA,
    )


def test_split_sizes_and_width(split_log):
    split = split_rows(split_log)
    assert split.filter("is_train").count() == 4
    vectors = feature_assembler().transform(scaled_vectors(split, 2, 1))
    widths = {row["features"].size for row in vectors.collect()}
    assert widths == {11}
    short = scaled_vectors(split, 2, 1, include_level4=False)
    short = feature_assembler(include_level4=False).transform(short)
    assert {row["features"].size for row in short.collect()} == {10}


def test_sample_size_is_clamped(split_log):
    assert split_rows(split_log, 50_000).count() == 5
    assert sorted(r["row_id"] for r in split_rows(split_log, 3).collect()) == [0, 1, 2]
    assert split_rows(split_log, 0).count() == 0


@pytest.mark.parametrize("n", [0, 1, 4, 1000])
def test_split_is_exact_and_reproducible(spark, n):
    log = spark.range(n).withColumnRenamed("id", "row_id")
    split = train_test_split(log)
    chosen = {r["row_id"] for r in split.filter("is_train").collect()}
    assert len(chosen) == math.floor(n * 0.8)
    again = train_test_split(log.repartition(7))
    assert chosen == {r["row_id"] for r in again.filter("is_train").collect()}


def test_split_depends_on_the_seed(spark):
    log = spark.range(200).withColumnRenamed("id", "row_id")
    parts = [
        {r["row_id"] for r in train_test_split(log, seed=s).filter("is_train").collect()}
        for s in (1, 2)
    ]
    assert parts[0] != parts[1]


def test_split_by_primary_key(spark):
    start = datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [(start + timedelta(hours=i // 2), f"u{i % 2}", "p") for i in range(20)],
        "timestamp_TW timestamp_ntz, uuid string, upid string",
    )
    assert train_test_split(log).filter("is_train").count() == 16


@pytest.mark.parametrize("n", [1, 17, 299])
def test_prefix_by_counting_slots(spark, monkeypatch, n):
    """With a tiny finishing size, every slot level is walked, ties included."""
    monkeypatch.setattr(selection, "FINISH_ROWS", 1)
    start = datetime(2024, 1, 1)
    rows = [
        (i, start + timedelta(hours=(i * 7) % 90 // 3), f"u{i % 3}", f"p{i % 2}")
        for i in range(300)
    ]
    log = spark.createDataFrame(
        rows, "row_id bigint, timestamp_TW timestamp_ntz, uuid string, upid string"
    )
    expected = sorted(rows, key=lambda r: (r[1], r[2], r[3], r[0]))[:n]
    got = {r["row_id"] for r in head_in_order(log, n).collect()}
    assert got == {r[0] for r in expected}


def test_split_by_counting_slots(spark, monkeypatch):
    log = spark.range(1000).withColumnRenamed("id", "row_id")
    plain = {r["row_id"] for r in train_test_split(log).filter("is_train").collect()}
    monkeypatch.setattr(selection, "FINISH_ROWS", 1)
    walked = {r["row_id"] for r in train_test_split(log).filter("is_train").collect()}
    assert walked == plain


def test_nth_row_with_null_times(spark):
    log = spark.createDataFrame(
        [(i, None if i % 2 else datetime(2024, 1, 1 + i)) for i in range(6)],
        "row_id bigint, timestamp_TW timestamp_ntz",
    )
    order = ["timestamp_TW", "row_id"]
    places = [find_cut(log, order, n, 6).key[1] for n in range(1, 7)]
    assert places == [0, 2, 4, 1, 3, 5]
    assert {r["row_id"] for r in head_in_order(log, 4, order).collect()} == {0, 1, 2, 4}


@pytest.mark.parametrize("finish", [3, 200_000])
def test_repeated_keys_give_exact_counts(spark, monkeypatch, finish):
    """Twenty copies a key: ties go by the other columns, equal rows by number."""
    monkeypatch.setattr(selection, "FINISH_ROWS", finish)
    monkeypatch.setattr(selection, "PROBES", 4)
    rows = [(i // 20, (i * 7) % 5, {"a": i}) for i in range(100)]
    log = spark.createDataFrame(rows, "row_id bigint, other int, extra map<string,int>").repartition(6)
    for n in (1, 33, 60):
        got = sorted((r["row_id"], r["other"]) for r in head_in_order(log, n).collect())
        assert got == sorted((a, b) for a, b, _ in rows)[:n]
    split = train_test_split(log)
    assert split.filter("is_train").count() == 80 and split.count() == 100
    assert {r["row_id"] for r in split.collect()} == {0, 1, 2, 3, 4}
    same = spark.range(50).select(F.lit(1).alias("row_id")).repartition(5)
    assert head_in_order(same, 13).count() == 13
    assert train_test_split(same).filter("is_train").count() == 40


ORDERS = {
    "double": ("double", lambda i: [None, float("nan"), -0.0, 0.0, float("-inf"), i / 7][min(i, 5)]),
    "decimal(20,3)": ("decimal(20,3)", lambda i: None if i == 3 else Decimal(i * 37 % 100) / 8),
    "long prefix": ("string", lambda i: None if i == 5 else "x" * 60 + str(i * 37 % 100)),
    "struct": ("struct<a:int,b:timestamp>", lambda i: (i % 3 or None, datetime(2024, 3, 10, i % 24))),
    "date": ("date", lambda i: None if i == 9 else datetime(2024, 1, 1 + i % 28).date()),
    "binary": ("binary", lambda i: bytes([i * 37 % 100])),
    "array": ("array<int>", lambda i: [i % 4, i * 37 % 100]),
}


@pytest.mark.parametrize("kind", sorted(ORDERS))
def test_prefix_of_any_order_type(spark, monkeypatch, kind):
    monkeypatch.setattr(selection, "FINISH_ROWS", 2)
    monkeypatch.setattr(selection, "PROBES", 9)
    dtype, value = ORDERS[kind]
    log = spark.createDataFrame([(value(i), i) for i in range(60)], f"key {dtype}, id int")
    sorted_ids = [r["id"] for r in log.orderBy(F.col("key").asc_nulls_last(), "id").collect()]
    for n in (1, 33):
        assert {r["id"] for r in head_in_order(log, n, ["key", "id"]).collect()} == set(sorted_ids[:n])


def test_rounds_read_a_range_of_the_leading_column(spark, tmp_path):
    start = datetime(2024, 1, 1)
    spark.createDataFrame(
        [(start + timedelta(hours=i), i) for i in range(50)], "timestamp_TW timestamp_ntz, row_id int"
    ).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    order = ["timestamp_TW", "row_id"]
    low, high = (start, 0), (start + timedelta(hours=9), 9)
    pushed = []
    for df in (selection._between(log, log, order, low, high), head_in_order(log, 20)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pushed.append(plan[plan.index("PushedFilters") :].split("\n")[0])
    assert all("LessThanOrEqual(timestamp_TW" in text for text in pushed)
    assert "GreaterThanOrEqual(time" in pushed[0]


def test_percent_rounds_half_to_even(spark):
    log = spark.range(250).withColumnRenamed("id", "row_id")
    assert head_percent(log).count() == 2
    assert head_percent(log.limit(0)).count() == 0


def test_scalars_scale_per_split(spark):
    rows = spark.createDataFrame(
        [(0, 2, 7, True), (1, 4, 7, True), (2, 3, 7, True), (3, 10, 7, False), (4, 20, None, False)],
        "row_id int, x int, c int, is_train boolean",
    )
    got = {r["row_id"]: (r["x"], r["c"]) for r in scale_scalars(rows, ["x", "c"]).collect()}
    assert got == {0: (0.0, 0.0), 1: (1.0, 0.0), 2: (0.5, 0.0), 3: (0.0, 0.0), 4: (1.0, None)}
    got = {r["row_id"]: r["x"] for r in scale_scalars(rows, ["x"], fit_on="train").collect()}
    assert got == {0: 0.0, 1: 1.0, 2: 0.5, 3: 4.0, 4: 9.0}
    with pytest.raises(ValueError, match="fit_on"):
        scale_scalars(rows, ["x"], fit_on="all")


ENTRIES = [
    (0, 0, 2, True),
    (1, 0, 4, True),
    (2, 1, -1, True),
    (3, 1, 3, True),
    (4, None, None, True),
    (5, 0, 5, False),
    (6, 0, 9, False),
]
WIDTH = 2


def dense_scaled():
    """Min-max of the dense matrices, one per split, constant columns to 0."""
    found = {}
    for is_train in (True, False):
        rows = [r for r in ENTRIES if r[3] is is_train]
        dense = {r[0]: [r[2] if j == r[1] else 0 for j in range(WIDTH)] for r in rows}
        for j in range(WIDTH):
            column = [v[j] for v in dense.values()]
            low, high = min(column), max(column)
            for key, vector in dense.items():
                cell = 0.0 if high == low else (vector[j] - low) / (high - low)
                found[key, j] = cell
    return found


def test_entries_scale_like_the_dense_matrix(spark):
    rows = spark.createDataFrame(ENTRIES, "row_id int, idx int, v int, is_train boolean")
    bounds = entry_bounds(rows, {"idx": "v"})
    implicit = [cell[1:] for cell in implicit_values(bounds)]
    assert implicit == [(True, 1, 0.25)]
    scaled = scale_entries(rows, bounds, "idx", "v", WIDTH)
    vectors = shifted_block(scaled, "idx", "v", WIDTH, "block", implicit)
    got = {
        (r["row_id"], j): r["block"][j] for r in vectors.collect() for j in range(WIDTH)
    }
    assert got == pytest.approx(dense_scaled())


def test_entry_bounds_fitted_on_train(spark):
    rows = spark.createDataFrame(ENTRIES, "row_id int, idx int, v int, is_train boolean")
    bounds = entry_bounds(rows, {"idx": "v"}, fit_on="train").collect()
    assert {(r["is_train"], r["index"], r["low"], r["high"]) for r in bounds} == {
        (side, *cell) for side in (True, False) for cell in ((0, 0.0, 4.0), (1, -1.0, 3.0))
    }


def test_blocks_are_sparse(spark):
    rows = spark.createDataFrame([(0, 1, 3.0), (1, None, None)], "row_id int, idx int, v double")
    got = {r["row_id"]: r["b"] for r in sparse_block(rows, "idx", "v", 1000, "b").collect()}
    assert got == {0: SparseVector(1000, {1: 3.0}), 1: SparseVector(1000, {})}
    hot = one_hot(rows, "idx", 3, "h").filter("row_id = 0").first()["h"]
    assert hot == SparseVector(3, {1: 1.0})
    doubled = interaction(one_hot(rows, "idx", 3, "h"), "v", "h", "p")
    assert doubled.filter("row_id = 0").first()["p"] == SparseVector(3, {1: 3.0})


def test_assembler_rejects_missing_values(split_log):
    holed = split_rows(split_log.withColumn("user_grade", F.lit(None).cast("int")))
    vectors = scaled_vectors(holed, 2, 1)
    with pytest.raises(Exception, match="null"):
        feature_assembler().transform(vectors).select("features").collect()
    skipped = feature_assembler(handle_invalid="skip").transform(vectors)
    assert skipped.count() == 0


def test_one_concept_only(split_log):
    """A column that every row fills has no implicit zero."""
    single = split_rows(split_log.withColumn("concept_idx", F.lit(0)))
    block = scaled_vectors(single, 1, 1).select("is_train", "concept_level", CONCEPT_BLOCK)
    train = block.filter("is_train").collect()
    assert sorted(r["concept_level"] for r in train)[0] == 0.0
    assert sorted(r["concept_level"] for r in train)[-1] == 1.0


def test_prefix_is_exact_where_clocks_change(spark, monkeypatch):
    monkeypatch.setattr("studytrace.operators.selection.FINISH_ROWS", 5)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        minutes = spark.range(240).selectExpr(
            "timestamp_ntz '2024-03-10 01:00:00' + make_dt_interval(0, 0, id) AS t", "id"
        )
        for n in (70, 100, 130, 155):
            assert head_in_order(minutes, n, ["t", "id"]).count() == n
        zoned = minutes.selectExpr("timestamp_seconds(1730610000 + id * 60) AS t", "id")
        assert head_in_order(zoned, 100, ["t", "id"]).count() == 100
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from studytrace.functions.columns import as_flag
from studytrace.operators.joins import (
    duplicate_keys,
    orphan_keys,
    require_known,
    users_of,
    with_level4,
)
from studytrace.plans.jobs import preprocess_summary
from studytrace.plans.preprocess import in_log_order, preprocess, preprocess_log
from studytrace.plans.tables import Tables, time_slice
from tests.conftest import RAW_SCHEMA, user_frame


@pytest.fixture(scope="module")
def unsorted_log(spark):
    return spark.createDataFrame(
        [
            (0, datetime(2024, 1, 2), "u2", "c2", "p2", 2, 0, False, 20, False, 1, 0, 3),
            (1, datetime(2024, 1, 1), "u1", "c1", "p1", 1, 1, True, 10, True, 0, 1, 4),
        ],
        RAW_SCHEMA,
    )


def test_preprocess_orders_flags_and_restores_level(spark, unsorted_log):
    user = user_frame(spark, ("u1", 5, "female"), ("u2", 6, None))
    done = in_log_order(preprocess_log(unsorted_log, user))
    rows = done.collect()
    assert [r["uuid"] for r in rows] == ["u1", "u2"]
    assert [r["level"] for r in rows] == [3, 4]
    assert (rows[0]["female"], rows[1]["unspecified"]) == (1, 1)
    gone = {"total_sec_taken", "is_hint_used", "is_downgrade", "is_upgrade", "gender"}
    assert not gone & set(done.columns)
    assert dict(done.dtypes)["level"] == "tinyint"


def test_unmatched_user_and_other_gender(spark, unsorted_log):
    user = user_frame(spark, ("u1", 5, "other"))
    rows = {r["uuid"]: r for r in preprocess_log(unsorted_log, user).collect()}
    assert rows["u2"]["user_grade"] is None
    assert rows["u2"]["unspecified"] == 1
    assert [rows["u1"][c] for c in ("female", "male", "unspecified")] == [0, 0, 0]


def test_nulls_sort_last(spark, raw_log, three_users):
    timeless = raw_log.withColumn(
        "timestamp_TW", F.when(F.col("row_id") != 0, F.col("timestamp_TW"))
    )
    rows = in_log_order(preprocess_log(timeless, three_users)).collect()
    assert [r["row_id"] for r in rows] == [1, 2, 3, 4, 0]


def test_missing_leakage_column_is_an_error(raw_log, three_users):
    with pytest.raises(ValueError, match="total_sec_taken"):
        preprocess_log(raw_log.drop("total_sec_taken"), three_users)


def test_flag_spellings(spark):
    texts = spark.createDataFrame(
        [("True",), ("false",), ("FALSE",), ("1",), ("0",), ("None",), (None,)], "f string"
    )
    got = [r[0] for r in texts.select(as_flag(texts, "f")).collect()]
    assert got == [True, False, False, True, False, None, None]
    for dtype, values in (("int", [1, 0, None]), ("double", [1.0, 0.0, None])):
        numbers = spark.createDataFrame([(v,) for v in values], f"f {dtype}")
        got = [r[0] for r in numbers.select(as_flag(numbers, "f")).collect()]
        assert got == [True, False, None]


def test_slice_is_half_open_and_selects_its_users(raw_log, three_users, two_content):
    tables = Tables(raw_log, three_users, two_content)
    cut = time_slice(tables, datetime(2024, 1, 2), datetime(2024, 1, 4))
    assert sorted(r["row_id"] for r in cut.log.collect()) == [1, 2]
    assert sorted(r["uuid"] for r in cut.user.collect()) == ["u1", "u2"]
    assert cut.content.count() == 2


def test_slice_does_not_depend_on_the_session_time_zone(spark, raw_log, three_users, two_content):
    tables = Tables(raw_log, three_users, two_content)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Taipei")
    try:
        cut = time_slice(tables, datetime(2024, 1, 2), datetime(2024, 1, 4))
        assert sorted(r["row_id"] for r in cut.log.collect()) == [1, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_slice_filter_reaches_the_scan(
    spark, raw_log, three_users, two_content, tmp_path, capsys
):
    path = str(tmp_path / "log")
    raw_log.write.parquet(path)
    tables = Tables(spark.read.parquet(path), three_users, two_content)
    cut = time_slice(tables, datetime(2024, 1, 2), datetime(2024, 1, 4))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    cut.log.explain("formatted")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(timestamp_TW" in plan
    assert "LessThan(timestamp_TW" in plan


def test_summary(raw_log, three_users, two_content):
    tables = Tables(raw_log, three_users, two_content)
    row = preprocess_summary(tables, datetime(2024, 1, 1), datetime(2024, 1, 3)).first()
    assert row.asDict() == {
        "log_rows": 2,
        "user_rows": 1,
        "content_rows": 2,
        "start_date": "2024-01-01T00:00:00",
        "end_date": "2024-01-03T00:00:00",
    }


def test_stage_passes_user_and_content_through(raw_log, three_users, two_content):
    done = preprocess(Tables(raw_log, three_users, two_content))
    assert done.user is three_users and done.content is two_content
    assert done.log.count() == 5


def test_key_checks(spark, raw_log, two_content):
    doubled = two_content.unionByName(two_content.filter("ucid = 'c1'"))
    assert [tuple(r) for r in duplicate_keys(doubled, ["ucid"]).collect()] == [("c1", 2)]
    only_c1 = two_content.filter("ucid = 'c1'")
    assert [tuple(r) for r in orphan_keys(raw_log, only_c1, "ucid").collect()] == [("c2", 2)]
    with pytest.raises(KeyError, match="1 unknown ucid values in 2 rows.*c2"):
        require_known(raw_log, only_c1, "ucid")
    require_known(raw_log, two_content, "ucid")


def test_level4_joins_on_all_shared_columns(raw_log, two_content):
    labelled = raw_log.select("row_id", "ucid").withColumn("level4_id", F.lit("l1"))
    joined = with_level4(labelled, two_content)
    assert joined.count() == 5
    assert joined.columns.count("level4_id") == 1
    with pytest.raises(ValueError, match="level4_id"):
        with_level4(raw_log, two_content.drop("level4_id"))


def test_users_of_keeps_one_row_per_user(raw_log, three_users):
    assert users_of(raw_log, three_users).count() == 3

"""Log, user and content derived from the star-schema test tables.

Two logs are derived. The event log comes from ``events`` with users from
``customer`` and content from the exercises occurring in the events. The order
log comes from ``lineitem`` and ``orders`` with content from ``part``; it is
the larger one and serves the scale queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.plans.tables import Tables
from studytrace.session import durable


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(index: Column, *values: str) -> Column:
    """The value at a 0-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity log with null labels, null flags and levels 0 to 4."""
    event = F.col("event_id")
    problem = F.get_json_object("props", "$.k").cast("int")
    level = event % 5
    flagged = event % 11 != 0
    correct = F.col("event_type").isin("click", "view", "purchase")
    return table(spark, sf_dir, "events").select(
        event.alias("row_id"),
        F.col("ts").alias("timestamp_TW"),
        F.col("user_id").cast("string").alias("uuid"),
        (problem % 20).cast("string").alias("ucid"),
        problem.cast("string").alias("upid"),
        (1 + event % 7).cast("smallint").alias("problem_number"),
        (event % 3).cast("smallint").alias("exercise_problem_repeat_session"),
        F.when(event % 97 != 0, correct).alias("is_correct"),
        F.floor("value").cast("int").alias("total_sec_taken"),
        (1 + event % 4).cast("smallint").alias("total_attempt_cnt"),
        (event % 3).cast("smallint").alias("used_hint_cnt"),
        (event % 3 > 0).alias("is_hint_used"),
        F.when(flagged, event % 17 == 0).alias("is_downgrade"),
        F.when(flagged, (event % 13 == 0) & (level >= 1)).alias("is_upgrade"),
        level.cast("tinyint").alias("level"),
    )


def event_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of all customers; those in debt get ids that no log row has."""
    key = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    gender = (
        F.when(segment == "BUILDING", "female")
        .when(segment == "MACHINERY", "male")
        .when(segment == "AUTOMOBILE", "other")
        .when(segment == "FURNITURE", None)
        .otherwise("unspecified")
    )
    month = F.lpad((1 + key % 12).cast("string"), 2, "0")
    day = F.lpad((1 + key % 28).cast("string"), 2, "0")
    return (
        table(spark, sf_dir, "customer")
        .select(
            # Customers in debt are users without any log row.
            F.when(F.col("c_acctbal") >= 0, key.cast("string"))
            .otherwise(F.concat(F.lit("x-"), key))
            .alias("uuid"),
            gender.alias("gender"),
            F.floor("c_acctbal").cast("int").alias("points"),
            (key % 30).cast("int").alias("badges_cnt"),
            F.concat(F.lit("2018-"), month, F.lit("-"), day).alias("first_login_date_TW"),
            (1 + F.col("c_nationkey") % 12).cast("int").alias("user_grade"),
            F.concat(F.lit("city "), F.col("c_nationkey")).alias("user_city"),
            (key % 3).cast("int").alias("has_teacher_cnt"),
            (key % 7 == 0).alias("is_self_coach"),
            (key % 5).cast("int").alias("has_student_cnt"),
            (key % 4).cast("int").alias("belongs_to_class_cnt"),
            (key % 2).cast("int").alias("has_class_cnt"),
        )
    )


def event_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per exercise occurring in the events, stored as a table.

    Content is read many times; the events are scanned for it only once.
    """
    exercise = F.get_json_object("props", "$.k").cast("int") % 20
    return durable(
        table(spark, sf_dir, "events")
        .select(exercise.alias("n"))
        .distinct()
        .select(
            F.col("n").cast("string").alias("ucid"),
            F.concat(F.lit("exercise "), F.col("n")).alias("content_pretty_name"),
            F.lit("Exercise").alias("content_kind"),
            pick(F.col("n") % 4, "unset", "easy", "normal", "hard").alias("difficulty"),
            F.lit("math").alias("subject"),
            pick(F.col("n") % 3, "elementary", "junior", "senior").alias("learning_stage"),
            F.lit("L1").alias("level1_id"),
            F.concat(F.lit("L2-"), F.col("n") % 2).alias("level2_id"),
            F.concat(F.lit("L3-"), F.col("n") % 2).alias("level3_id"),
            F.concat(F.lit("L4-"), F.col("n") % 4).alias("level4_id"),
        )
    )


def event_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        event_log(spark, sf_dir), event_user(spark, sf_dir), event_content(spark, sf_dir)
    )


def event_text_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as unchecked text, with values that do not fit their type."""
    log = event_log(spark, sf_dir)
    text = log.select("row_id", *[F.col(c).cast("string") for c in log.columns[1:]])
    row = F.col("row_id")
    flag = pick(row % 4, "True", "false", "None", "1")
    return text.withColumns(
        {
            "total_sec_taken": F.when(row % 23 == 0, "abc").otherwise(
                F.col("total_sec_taken")
            ),
            "problem_number": F.when(row % 29 == 0, "40000").otherwise(
                F.col("problem_number")
            ),
            "level": F.when(row % 31 == 0, "300").otherwise(F.col("level")),
            "is_downgrade": flag,
        }
    )


def part_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content from ``part``, with enumerated values outside their domains."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ucid"),
        F.col("p_name").alias("content_pretty_name"),
        pick(size % 5, "easy", "hard", "normal", "unset", "extreme").alias("difficulty"),
        pick(size % 4, "elementary", "junior", "senior", "college").alias("learning_stage"),
        F.col("p_brand").alias("level4_id"),
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity log from order lines.

    No single column identifies a line, so the row id is a struct that does.
    """
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        F.struct("l_orderkey", "l_linenumber", "l_extendedprice").alias("row_id"),
        F.col("l_shipdate").alias("timestamp_TW"),
        F.col("o_custkey").alias("uuid"),
        F.col("l_partkey").alias("ucid"),
        (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("upid"),
        (F.col("l_returnflag") != "R").alias("is_correct"),
        (F.col("l_linenumber") % 5).alias("level"),
    )


def order_tables(spark: SparkSession, sf_dir: str) -> Tables:
    customers = table(spark, sf_dir, "customer")
    return Tables(
        order_log(spark, sf_dir),
        customers.select(F.col("c_custkey").alias("uuid")),
        part_content(spark, sf_dir),
    )

"""Cleaning stage: user attributes, gender flags, level before the attempt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrace.functions.columns import (
    as_flag,
    ascending,
    flag_count,
    log_order,
    require_columns,
)
from studytrace.operators.joins import with_user_attributes
from studytrace.plans.tables import Tables
from studytrace.schemas import GENDER_FLAGS, LEAKAGE_COLUMNS


def with_gender_flags(df: DataFrame) -> DataFrame:
    """Replace ``gender`` by indicator columns; missing means 'unspecified'."""
    gender = F.coalesce(F.col("gender"), F.lit("unspecified"))
    return df.withColumns(
        {value: (gender == value).cast("int") for value in GENDER_FLAGS}
    ).drop("gender")


def with_level_before_attempt(df: DataFrame) -> DataFrame:
    """Undo the level change that the attempt itself caused."""
    level = (
        F.col("level").cast("int")
        + flag_count(as_flag(df, "is_downgrade"))
        - flag_count(as_flag(df, "is_upgrade"))
    )
    return df.withColumn("level", level.cast("tinyint"))


def without_leakage(df: DataFrame) -> DataFrame:
    """Drop the columns known only after the attempt; all must be present."""
    require_columns(df, LEAKAGE_COLUMNS, "log")
    return df.drop(*LEAKAGE_COLUMNS)


def preprocess_log(log: DataFrame, user: DataFrame) -> DataFrame:
    """The cleaned log. Rows are unordered; see ``in_log_order``."""
    joined = with_user_attributes(log, user)
    return without_leakage(with_level_before_attempt(with_gender_flags(joined)))


def in_log_order(df: DataFrame) -> DataFrame:
    """Rows sorted for output: time, user, problem, nulls last."""
    return df.orderBy(*ascending(log_order(df)))


def preprocess(tables: Tables) -> Tables:
    """The cleaning stage; user and content pass through."""
    return Tables(preprocess_log(tables.log, tables.user), tables.user, tables.content)

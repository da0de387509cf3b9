"""Joins of the log with its dimensions, and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrace.functions.columns import require_columns


def users_of(log: DataFrame, user: DataFrame) -> DataFrame:
    """Users that occur in ``log``.

    The log is reduced to distinct ids on the map side first, so a user with
    very many rows weighs no more than any other.
    """
    return user.join(log.select("uuid").distinct(), "uuid", "left_semi")


def with_user_attributes(log: DataFrame, user: DataFrame) -> DataFrame:
    """Left join of grade and gender; unmatched users give nulls."""
    return log.join(user.select("uuid", "user_grade", "gender"), "uuid", "left")


def with_level4(log: DataFrame, content: DataFrame) -> DataFrame:
    """Left join of the level4 group on every shared content column."""
    require_columns(content, ("ucid", "level4_id"), "content")
    shared = [name for name in ("ucid", "level4_id") if name in log.columns]
    return log.join(content.select("ucid", "level4_id"), shared, "left")


def log_user_content(log: DataFrame, user: DataFrame, content: DataFrame) -> DataFrame:
    """Inner join of log, user on (uuid, user_grade), and content on ucid."""
    return log.join(user, ["uuid", "user_grade"]).join(content, "ucid")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count."""
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def orphan_keys(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Non-null key values absent from ``dimension``, with their row count.

    Rows are counted per key before the join, so no key is hot in it.
    """
    counted = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return counted.join(dimension.select(key), key, "left_anti")


def require_known(df: DataFrame, dimension: DataFrame, key: str) -> None:
    """Raise ``KeyError`` with counts and samples when a key is unknown."""
    orphans = orphan_keys(df, dimension, key)
    found = orphans.agg(F.count(F.lit(1)), F.sum("row_count")).first()
    if found[0]:
        samples = [row[0] for row in orphans.orderBy(key).limit(5).collect()]
        raise KeyError(
            f"{found[0]} unknown {key} values in {found[1]} rows, such as {samples}"
        )

"""Features of a log row that use only earlier rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from studytrace.functions.columns import log_order
from studytrace.operators.ordered import (
    BLOCK_ROWS,
    MEASURE,
    LargeGroups,
    any_null,
    previous_value,
    running_totals,
)


def overall_accuracy(log: DataFrame, rows: Column | None = None) -> DataFrame:
    """One row: the mean label, nulls skipped; each counts ``rows`` times where given."""
    label = F.col("is_correct").cast("double")
    if rows is None:
        return log.agg(F.avg(label).alias("overall_accuracy"))
    labelled = F.nullif(F.sum(F.when(label.isNotNull(), rows)), F.lit(0))
    return log.agg((F.sum(label * rows) / labelled).alias("overall_accuracy"))


def prior_accuracy(
    log: DataFrame,
    keys: Sequence[str],
    name: str,
    fallback: Column | None = None,
    block_rows: int = BLOCK_ROWS,
    large: LargeGroups | str | None = MEASURE,
    before: DataFrame | None = None,
) -> DataFrame:
    """Add the share of correct answers among earlier rows of the same keys.

    Earlier rows with a null label count as attempts but not as correct. Rows
    without history, and rows whose own label or key is null, get ``fallback``,
    by default the overall accuracy. ``before`` holds the counts (keys, correct,
    attempts) of rows that are earlier than the whole log.
    """
    if fallback is None:
        fallback = overall_accuracy(log).scalar()
    label = F.col("is_correct")
    counted = running_totals(
        log,
        keys,
        log_order(log),
        {"_correct": label.cast("int"), "_attempts": F.lit(1)},
        block_rows=block_rows,
        large=large,
    )
    counted = _with_earlier(counted, keys, before, {"_correct": "correct", "_attempts": "attempts"})
    share = F.col("_correct") / F.nullif(F.col("_attempts"), F.lit(0))
    known = F.when(label.isNotNull() & ~any_null(keys), share)
    return counted.select(*log.columns, F.coalesce(known, fallback).alias(name))


def _with_earlier(
    df: DataFrame, keys: Sequence[str], before: DataFrame | None, totals: Mapping[str, str]
) -> DataFrame:
    """Add to each total the column of ``before`` it is mapped to, by the keys."""
    if before is None:
        return df
    old = before.select(*keys, *[F.col(b).alias(f"_old{name}") for name, b in totals.items()])
    joined = df.join(old, list(keys), "left")
    sums = {name: F.col(name) + F.coalesce(f"_old{name}", F.lit(0)) for name in totals}
    return joined.withColumns(sums).select(*df.columns)


def level4_proficiency(
    log: DataFrame,
    name: str = "level4_proficiency",
    block_rows: int = BLOCK_ROWS,
    large_concepts: LargeGroups | str | None = MEASURE,
    large_level4: LargeGroups | str | None = MEASURE,
    levels_before: DataFrame | None = None,
    totals_before: DataFrame | None = None,
) -> DataFrame:
    """Add the user's summed latest levels over the concepts of the level4 group.

    The sum of latest levels changes, at each row, by the row's level minus the
    previous level of the same user and concept; its running total is the
    wanted value. A missing level counts as zero. The large groups are those of
    (uuid, ucid) and of (uuid, level4_id). Of rows earlier than the whole log,
    ``levels_before`` holds the latest level (uuid, ucid, level), and
    ``totals_before`` the sum (uuid, level4_id, total).
    """
    order = log_order(log)
    level = F.coalesce(F.col("level").cast("int"), F.lit(0))
    stepped = previous_value(
        log, ["uuid", "ucid"], order, level, "_before", block_rows, large_concepts
    )
    if levels_before is not None:
        # Only a group's first row has no value before it in this log.
        old = levels_before.select("uuid", "ucid", F.col("level").alias("_old"))
        stepped = stepped.join(old, ["uuid", "ucid"], "left").withColumn(
            "_before", F.coalesce("_before", "_old")
        )
    change = level - F.coalesce(F.col("_before"), F.lit(0))
    summed = running_totals(
        stepped,
        ["uuid", "level4_id"],
        order,
        {name: change},
        include_current=True,
        block_rows=block_rows,
        large=large_level4,
    ).select(*log.columns, name)
    return _with_earlier(summed, ["uuid", "level4_id"], totals_before, {name: "total"})

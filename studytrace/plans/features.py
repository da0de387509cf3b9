"""Feature stage: history features plus sparse concept and level4 entries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.functions.columns import log_order, require_columns
from studytrace.operators.history import (
    level4_proficiency,
    overall_accuracy,
    prior_accuracy,
)
from studytrace.operators.joins import duplicate_keys, require_known
from studytrace.operators.ordered import (
    BLOCK_ROWS,
    BROADCAST_ROWS,
    LargeGroups,
    bounded_broadcast,
    ordinals,
    with_blocks,
    without_blocks,
)
from studytrace.plans.preprocess import preprocess_log
from studytrace.plans.tables import Tables
from studytrace.session import durable


@dataclass(frozen=True)
class Dimensions:
    """Index of content members: which vector position each one owns."""

    content: DataFrame  # ucid, level4_id, concept_idx, level4_idx
    concepts: int
    level4_groups: int


@dataclass(frozen=True)
class FeatureStage:
    """Log with features; matrices are (index, value) columns of the same row."""

    log: DataFrame
    dimensions: Dimensions


def content_dimensions(content: DataFrame) -> Dimensions:
    """Number concepts and level4 groups by ascending id."""
    require_columns(content, ("ucid", "level4_id"), "content")
    members = content.select("ucid", "level4_id")
    held, concepts, groups = members.agg(
        F.count("ucid"), F.countDistinct("ucid"), F.countDistinct("level4_id")
    ).first()
    if held > concepts:
        raise ValueError(f"content holds {held - concepts} duplicate ucid rows")
    concept = ordinals(members, "ucid", "concept_idx", concepts)
    level4 = ordinals(members, "level4_id", "level4_idx", groups)
    indexed = members.join(bounded_broadcast(concept, concepts), "ucid").join(
        bounded_broadcast(level4, groups), "level4_id", "left"
    )
    return Dimensions(
        indexed.select("ucid", "level4_id", "concept_idx", "level4_idx"),
        concepts,
        groups,
    )


def with_content_index(log: DataFrame, dimensions: Dimensions) -> DataFrame:
    """Add level4 group, concept and level4 indices; unknown concepts get nulls."""
    shared = [name for name in ("ucid", "level4_id") if name in log.columns]
    content = bounded_broadcast(dimensions.content, dimensions.concepts)
    return log.join(content, shared, "left")


def level4_members(dimensions: Dimensions) -> DataFrame:
    """Concept indices of each level4 group, ascending."""
    return dimensions.content.groupBy("level4_id").agg(
        F.sort_array(F.collect_list("concept_idx")).alias("concept_indices")
    )


@dataclass(frozen=True)
class LogGroups:
    """Key groups of a log that exceed one task, per window of the stage."""

    users_fit: bool = True
    problem: LargeGroups | None = None
    user_problem: LargeGroups | None = None
    user_concept: LargeGroups | None = None
    user_level4: LargeGroups | None = None

    def any_large(self) -> bool:
        """True if one of the windows meets a large group."""
        return any((self.problem, self.user_problem, self.user_concept, self.user_level4))


#: Buckets that keys are hashed to when a log is first counted.
KEY_BUCKETS = 16_384
#: The bucket of rows without the key.
NO_KEY = -1
_LABELS = {"right": True, "wrong": False}


def _bucket(key: str) -> Column:
    """The bucket of a key; rows without it have their own."""
    hashed = F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")
    return F.when(F.col(key).isNull(), F.lit(NO_KEY)).otherwise(hashed)


@dataclass(frozen=True)
class LogCounts:
    """What is known of a log before any window."""

    labels: dict[bool | None, int]  # rows by label
    buckets: dict[str, dict[int, int]]  # rows of the buckets above a size, by key

    def total(self) -> int:
        return sum(self.labels.values())


def log_counts(log: DataFrame, block_rows: int = BLOCK_ROWS) -> LogCounts:
    """Count labels, and the buckets of users and of problems with many rows.

    The log, which may be a join, is run once for all of it, and each task passes
    on one row per bucket and label. At most (row count / block_rows) buckets of
    each key have more than ``block_rows`` rows.
    """
    keys = [c for c in ("uuid", "upid") if c in log.columns]
    each = [F.struct(F.lit(key).alias("key"), _bucket(key).alias("bucket")) for key in keys]
    counted = (
        log.select("is_correct", F.inline(F.array(*each)))
        .groupBy("key", "bucket", "is_correct")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    by_bucket = (
        counted.groupBy("key", "bucket")
        .agg(
            F.sum("rows").alias("rows"),
            *[F.sum(F.when(F.col("is_correct") == value, F.col("rows"))).alias(name) for name, value in _LABELS.items()],
        )
    )
    big = F.col("rows") > block_rows
    found = by_bucket.groupBy("key").agg(
        F.sum("rows").alias("rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _LABELS],
        F.collect_list(F.when(big, F.struct("bucket", "rows"))).alias("buckets"),
    )
    by_key = {r["key"]: r for r in found.collect()}
    labels = {}
    if keys[0] in by_key:
        row = by_key[keys[0]]
        labels = {value: row[name] for name, value in _LABELS.items()}
        labels[None] = row["rows"] - sum(labels.values())
    buckets = {
        key: {b["bucket"]: b["rows"] for b in by_key[key]["buckets"]} if key in by_key else {}
        for key in ("uuid", "upid")
    }
    return LogCounts(labels, buckets)


def counted_accuracy(spark: SparkSession, counts: LogCounts) -> DataFrame:
    """The overall accuracy of the log that was counted."""
    labels = spark.createDataFrame(list(counts.labels.items()), "is_correct boolean, rows long")
    return overall_accuracy(labels, F.col("rows"))


def log_groups(
    log: DataFrame,
    dimensions: Dimensions,
    block_rows: int = BLOCK_ROWS,
    counts: LogCounts | None = None,
) -> LogGroups:
    """Measure the groups once, on the source log, reading key columns only.

    A small log holds no large group, nor does a small bucket of ``counts``
    (by default taken here). Only rows in larger buckets are counted by key, and
    only a large user can have a large group below it. Rows without a user count
    as one user here. All large groups are written as one small table.
    """
    counts = log_counts(log, block_rows) if counts is None else counts
    total = counts.total()
    if total <= block_rows:
        return LogGroups()
    nameless = NO_KEY in counts.buckets["uuid"]
    crowded = {key: [b for b in found if b != NO_KEY] for key, found in counts.buckets.items()}
    if not any(crowded.values()):
        return LogGroups(users_fit=not nameless)
    keys = [c for c in ("uuid", "ucid", "upid", "level4_id") if c in log.columns]
    rows = log.select(*keys)

    def large(df: DataFrame, *by: str) -> DataFrame:
        counted = df.dropna(subset=list(by)).groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
        return counted.filter(F.col("rows") > block_rows).withColumn("by", F.lit(",".join(by)))

    windows = []
    if crowded["upid"]:
        windows.append(large(rows.filter(_bucket("upid").isin(crowded["upid"])), "upid"))
    if crowded["uuid"]:
        users = large(rows.filter(_bucket("uuid").isin(crowded["uuid"])), "uuid")
        # At most total / block_rows users qualify.
        chosen = bounded_broadcast(users.select("uuid"), total // block_rows)
        theirs = with_content_index(rows.join(chosen, "uuid", "left_semi"), dimensions)
        windows += [users, *[large(theirs, "uuid", other) for other in ("upid", "ucid", "level4_id")]]
    table = windows[0]
    for found in windows[1:]:
        table = table.unionByName(found, allowMissingColumns=True)
    table = durable(table)
    found = table.groupBy("by").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows"))
    large_sizes = {r["by"]: r for r in found.collect()}

    def groups(*by: str) -> LargeGroups | None:
        size = large_sizes.get(",".join(by))
        if size is None:
            return None
        frame = table.filter(F.col("by") == ",".join(by)).select(*by)
        return LargeGroups(by, frame, size["n"], size["rows"])

    return LogGroups(
        "uuid" not in large_sizes and not nameless,
        groups("upid"),
        groups("uuid", "upid"),
        groups("uuid", "ucid"),
        groups("uuid", "level4_id"),
    )


def by_user(log: DataFrame, groups: LogGroups) -> DataFrame:
    """Cluster the log by user unless a user is too large for one task.

    The user join and every per-user window afterwards reuse this one shuffle.
    """
    return log.repartition("uuid") if groups.users_fit else log


@dataclass(frozen=True)
class History:
    """What features need to know of rows earlier than a log."""

    problems: DataFrame  # upid, correct, attempts
    user_problems: DataFrame  # uuid, upid, correct, attempts
    user_concepts: DataFrame  # uuid, ucid, level4_id, level: the latest one
    overall: DataFrame  # one row: correct, labelled, last_time

    def user_level4(self) -> DataFrame:
        """(uuid, level4_id, total): the latest levels summed over a group's concepts."""
        known = self.user_concepts.filter(F.col("level4_id").isNotNull())
        return known.groupBy("uuid", "level4_id").agg(F.sum("level").alias("total"))


def history_features(
    log: DataFrame,
    fallback: Column,
    groups: LogGroups,
    block_rows: int = BLOCK_ROWS,
    before: History | None = None,
) -> DataFrame:
    """Add level4 proficiency and both running accuracies.

    Per-user features come first, since they keep the layout of ``by_user``. If
    any group is large, the log is written once, in blocks that all windows share.
    """
    rows = with_blocks(log, log_order(log), block_rows) if groups.any_large() else log
    rows = level4_proficiency(
        rows,
        block_rows=block_rows,
        large_concepts=groups.user_concept,
        large_level4=groups.user_level4,
        levels_before=before.user_concepts if before else None,
        totals_before=before.user_level4() if before else None,
    )
    rows = prior_accuracy(
        rows,
        ["uuid", "upid"],
        "v_uuid_upid_acc",
        fallback,
        block_rows,
        groups.user_problem,
        before.user_problems if before else None,
    )
    rows = prior_accuracy(
        rows,
        ["upid"],
        "v_upid_acc",
        fallback,
        block_rows,
        groups.problem,
        before.problems if before else None,
    )
    return without_blocks(rows)


def require_known_keys(tables: Tables) -> None:
    """Raise ``KeyError`` for concepts or users of the log the dimensions lack."""
    require_known(tables.log, tables.content, "ucid")
    require_known(tables.log, tables.user, "uuid")


def feature_stage(
    tables: Tables, strict: bool = True, block_rows: int = BLOCK_ROWS
) -> FeatureStage:
    """Features of a preprocessed log: accuracies, concept entry, proficiency.

    ``strict`` raises ``KeyError`` for users or concepts the dimensions lack.
    """
    if strict:
        require_known_keys(tables)
    dimensions = content_dimensions(tables.content)
    counts = log_counts(tables.log, block_rows)
    groups = log_groups(tables.log, dimensions, block_rows, counts)
    fallback = counted_accuracy(tables.log.sparkSession, counts).scalar()
    # A large content table is joined by shuffle, which undoes the clustering.
    if dimensions.concepts <= BROADCAST_ROWS:
        rows = with_content_index(by_user(tables.log, groups), dimensions)
    else:
        rows = by_user(with_content_index(tables.log, dimensions), groups)
    return FeatureStage(history_features(rows, fallback, groups, block_rows), dimensions)


def unique_users(tables: Tables) -> bool:
    """True if no user id is repeated, so that the user join keeps the log's rows."""
    return duplicate_keys(tables.user, ["uuid"]).isEmpty()


def build_features(
    tables: Tables,
    strict: bool = True,
    block_rows: int = BLOCK_ROWS,
    overall: Column | None = None,
) -> FeatureStage:
    """Preprocess raw tables and derive features.

    ``overall`` is the overall accuracy where it is not that of the log itself.

    The same values as ``feature_stage(preprocess(tables))``. Checks, group
    sizes and overall accuracy are taken from the raw log, before any join, and
    the log is clustered by user before the user join, which keeps the layout.
    """
    if strict:
        require_known_keys(tables)
    dimensions = content_dimensions(tables.content)
    counts = log_counts(tables.log, block_rows)
    groups = log_groups(tables.log, dimensions, block_rows, counts)
    small_content = dimensions.concepts <= BROADCAST_ROWS
    log = by_user(tables.log, groups) if small_content else tables.log
    rows = preprocess_log(log, tables.user)
    # A repeated user id would repeat log rows, and so shift the accuracy.
    fallback = overall
    if fallback is None:
        if unique_users(tables):
            fallback = counted_accuracy(rows.sparkSession, counts).scalar()
        else:
            fallback = overall_accuracy(rows).scalar()
    rows = with_content_index(rows, dimensions)
    rows = rows if small_content else by_user(rows, groups)
    return FeatureStage(history_features(rows, fallback, groups, block_rows), dimensions)

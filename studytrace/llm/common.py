"""Small helpers that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 10_000
LABEL_BOUND = 20_000
_DIGIT_BITS = 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the corpus tables below ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """The text column, nulls as empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def fresh(taken: list[str], wanted: str) -> str:
    """A column name like ``wanted`` that differs from every taken name."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def with_row_id(df: DataFrame, name: str = "uid") -> DataFrame:
    """Number the rows, so that repeated and null ids stay apart.

    Numbers hold within one computed table: write the result (``durable``)
    before two readers of it meet in a join.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def label_sample(labels: DataFrame, column: str, bound: int = LABEL_BOUND) -> DataFrame:
    """At most ``bound`` labelled documents in hash order: (doc_id, ``column``).

    A document labelled twice counts once, with its highest label. Rows without
    id or label are not labelled.
    """
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(column).alias(column))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )


def small_or_shuffled(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``bound`` rows."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def kth_largest(df: DataFrame, key: str, k: int) -> int | None:
    """The k-th largest value of a long column, counted digit by digit.

    Each of four passes counts the rows per 16-bit digit below the digits found
    so far; at most 65,536 counts reach the driver. None if there are fewer
    rows than ``k``, or ``k`` is below one.
    """
    if k < 1:
        return None
    # Flipping the sign bit makes the unsigned digit order the signed order.
    unsigned = F.col(key).bitwiseXOR(F.lit(-(2**63)))
    prefix, wanted = 0, k
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned(unsigned, shift).bitwiseAND(F.lit(2**_DIGIT_BITS - 1))
        rows = df
        if shift < 48:
            above = shift + _DIGIT_BITS
            rows = df.filter(F.shiftrightunsigned(unsigned, above) == F.lit(prefix))
        counts = rows.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).collect()
        for digit_value, n in sorted(((c["digit"], c["n"]) for c in counts), reverse=True):
            if n >= wanted:
                break
            wanted -= n
        else:
            return None
        prefix = prefix << _DIGIT_BITS | digit_value
    return prefix - 2**63

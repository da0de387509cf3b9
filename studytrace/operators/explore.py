"""Exploratory queries: codes, correlation, profiles, distinct values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studytrace.functions.columns import recode
from studytrace.operators.ordered import bounded_broadcast, ordinals
from studytrace.operators.selection import head_in_order
from studytrace.schemas import (
    DIFFICULTY_CODES,
    GENDER_CODES,
    LEARNING_STAGE_CODES,
)
from studytrace.session import durable

RECODED = {
    "gender": GENDER_CODES,
    "difficulty": DIFFICULTY_CODES,
    "learning_stage": LEARNING_STAGE_CODES,
}


def with_fixed_codes(
    df: DataFrame, maps: Mapping[str, Mapping[str, int]] = RECODED
) -> DataFrame:
    """Replace the named text columns by their fixed numbers."""
    return df.withColumns({name: recode(name, codes) for name, codes in maps.items()})


def with_category_codes(df: DataFrame, domains: Mapping[str, DataFrame]) -> DataFrame:
    """Replace each named column by the rank of its value in the sorted domain.

    ``domains`` names the table that holds all values of the column. A null, or
    a value foreign to the domain, gives −1.
    """
    for name, table in domains.items():
        size = table.agg(F.countDistinct(name)).first()[0]
        codes = ordinals(table, name, "_code", size)
        df = (
            df.join(bounded_broadcast(codes, size), name, "left")
            .withColumn(name, F.coalesce(F.col("_code"), F.lit(-1)))
            .drop("_code")
        )
    return df


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all column pairs, long form.

    The columns are written once as numbers, so that whatever made ``df`` runs
    once. A first pass over them takes the means, a second sums centred
    products: keeping running co-moments in one pass loses digits where means
    are large. Rows with a null in ``columns`` are left out. Undefined
    correlations, those of a constant column, are null.
    """
    numbers = durable(df.select(*[F.col(name).cast("double") for name in columns]).dropna())
    means = numbers.agg(
        *[F.avg(name) for name in columns],
        *[F.min(name) < F.max(name) for name in columns],
    ).first()
    mean = dict(zip(columns, means))
    varies = [name for name, flag in zip(columns, means[len(columns) :]) if flag]
    pairs = [(a, b) for i, a in enumerate(varies) for b in varies[i:]]
    # As text: hundreds of expressions are far quicker to parse than to build.
    products = numbers.agg(
        *[
            F.expr(f"sum((`{a}` - {mean[a]!r}D) * (`{b}` - {mean[b]!r}D)) AS `{a}|{b}`")
            for a, b in pairs
        ]
        or [F.lit(None)]
    )

    def correlation(a: str, b: str) -> str:
        if not {a, b} <= set(varies):
            return "CAST(NULL AS DOUBLE)"
        joint = f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`"
        return f"{joint} / (sqrt(`{a}|{a}`) * sqrt(`{b}|{b}`))"

    cells = [
        f"struct('{a}' AS column_a, '{b}' AS column_b, {correlation(a, b)} AS correlation)"
        for a in columns
        for b in columns
    ]
    return products.selectExpr(f"inline(array({', '.join(cells)}))")


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first few rows in log order."""
    return head_in_order(df, rows)


def column_profile(df: DataFrame) -> DataFrame:
    """Per column: position, name, type, non-null rows, all rows."""
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(name).alias(f"_held_{name}") for name in df.columns],
    )
    cells = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(dtype).alias("data_type"),
            F.col(f"_held_{name}").alias("non_null_count"),
            F.col("row_count"),
        )
        for position, (name, dtype) in enumerate(df.dtypes)
    ]
    return counted.select(F.inline(F.array(*cells)))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column as (column_name, value), from one scan."""
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(name).cast("string").alias("value"),
        )
        for name in columns
    ]
    return df.select(F.inline(F.array(*cells))).distinct()

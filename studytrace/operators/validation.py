"""Row validation against a declared schema; rejects are kept with reasons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studytrace.functions.columns import (
    as_flag,
    nan_to_null,
    require_columns,
    within,
)
from studytrace.schemas import DOMAINS, FLAG_COLUMNS, SCHEMAS

FAILED = "failed_columns"


@dataclass(frozen=True)
class Validated:
    """Rows that fit the schema, and the others with their failed columns."""

    valid: DataFrame
    rejected: DataFrame


def with_enum_domains(
    df: DataFrame, domains: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Values outside their column's domain become null."""
    present = {n: within(n, d) for n, d in domains.items() if n in df.columns}
    return df.withColumns(present) if present else df


def prepare_users(user: DataFrame) -> DataFrame:
    """NaN to null everywhere, first login text to date, null where it is none."""
    return nan_to_null(user).withColumn(
        "first_login_date_TW", F.col("first_login_date_TW").try_cast("date")
    )


def validate(df: DataFrame, table: str) -> Validated:
    """Split ``df`` by the declared schema of ``table``.

    A row fails where a value cannot be read as the declared type, or where a
    required value is missing, also one that its domain made null. Absent
    optional columns are filled with null, absent required ones are an error.
    """
    schema, domains = SCHEMAS[table], DOMAINS[table]
    require_columns(df, [f.name for f in schema if not f.nullable], table)
    source = nan_to_null(df)

    def already_typed(field: T.StructField) -> bool:
        return source.schema[field.name].dataType == field.dataType

    def typed(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType)
        if field.name in FLAG_COLUMNS:
            return as_flag(source, field.name)
        if field.name in domains:
            return within(field.name, domains[field.name])
        if already_typed(field):
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType)

    def failed(field: T.StructField) -> Column:
        value = typed(field)
        if not field.nullable:
            return value.isNull()
        if field.name in FLAG_COLUMNS or field.name not in df.columns:
            return F.lit(False)
        if already_typed(field) and field.name not in domains:
            return F.lit(False)
        return value.isNull() & F.col(field.name).isNotNull()

    fits = reduce(Column.__and__, [~failed(field) for field in schema])
    reasons = F.array_compact(
        F.array(*[F.when(failed(field), F.lit(field.name)) for field in schema])
    )
    valid = source.filter(fits).select(
        *[typed(field).alias(field.name) for field in schema]
    )
    return Validated(valid, source.filter(~fits).withColumn(FAILED, reasons))

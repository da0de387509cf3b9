"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_ORDER = ("timestamp_TW", "uuid", "upid")
ROW_ID = "row_id"


def ascending(names: Sequence[str]) -> list[Column]:
    """Ascending sort terms with nulls last."""
    return [F.col(name).asc_nulls_last() for name in names]


def order_tuple(names: Sequence[str]) -> Column:
    """One comparable value that sorts like ``ascending(names)``."""
    parts = []
    for name in names:
        parts += [F.col(name).isNull(), F.col(name)]
    return F.struct(*[part.alias(f"o{i}") for i, part in enumerate(parts)])


def log_order(df: DataFrame) -> list[str]:
    """The total log order of ``df``: time, user, problem, then the row id.

    Frames without a timestamp are ordered by the row id alone.
    """
    names = [*LOG_ORDER, ROW_ID] if "timestamp_TW" in df.columns else [ROW_ID]
    return [name for name in names if name in df.columns]


def row_key(df: DataFrame) -> list[str]:
    """Columns that identify a log row: the row id, else the log's primary key."""
    return [ROW_ID] if ROW_ID in df.columns else list(LOG_ORDER)


def literal(value, dtype: T.DataType) -> Column:
    """``value`` as a literal of ``dtype``, free of any time-zone conversion.

    Takes values collected by ``portable`` as well.
    """
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(str(value)).cast(dtype)
    if isinstance(dtype, T.TimestampType) and isinstance(value, int):
        return F.timestamp_micros(F.lit(value))
    if isinstance(dtype, T.StructType):
        parts = zip(value, dtype, strict=True)
        return F.struct(*[literal(v, f.dataType).alias(f.name) for v, f in parts])
    if isinstance(dtype, T.ArrayType):
        return F.array(*[literal(v, dtype.elementType) for v in value]).cast(dtype)
    return F.lit(value).cast(dtype)


def portable(column: Column, dtype: T.DataType) -> Column:
    """A form of ``column`` that comes back unchanged through ``literal``.

    A time with zone would pass through the driver's local clock, which knows
    some hours twice; it is collected in microseconds instead.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(dtype, T.StructType):
        fields = F.struct(*[portable(column[f.name], f.dataType).alias(f.name) for f in dtype])
        return F.when(column.isNotNull(), fields)
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda item: portable(item, dtype.elementType))
    return column


def is_orderable(dtype: T.DataType) -> bool:
    """True for types whose values can be compared and written as literals."""
    if isinstance(dtype, T.StructType):
        return all(is_orderable(f.dataType) for f in dtype)
    if isinstance(dtype, T.ArrayType):
        return is_orderable(dtype.elementType)
    return isinstance(dtype, (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DatetimeType))


def between(df: DataFrame, name: str, start, end) -> Column:
    """Half-open range predicate ``start <= name < end``."""
    dtype = df.schema[name].dataType
    return (F.col(name) >= literal(start, dtype)) & (F.col(name) < literal(end, dtype))


def as_flag(df: DataFrame, name: str) -> Column:
    """A boolean from booleans, numbers or text in any case; 'None' and NaN give null."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.lower(F.trim(F.col(name))).try_cast("boolean")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(name), F.col(name).cast("boolean"))
    return F.col(name).cast("boolean")


def flag_count(column: Column) -> Column:
    """1 for a raised flag, 0 for a lowered or missing one."""
    return F.coalesce(column.cast("int"), F.lit(0))


def within(name: str, domain: Sequence[str]) -> Column:
    """The value where it belongs to ``domain``, else null."""
    return F.when(F.col(name).isin(*domain), F.col(name))


def recode(name: str, codes: Mapping[str, int]) -> Column:
    """Fixed text codes; text outside the map gives null."""
    table = F.create_map(*[F.lit(part) for item in codes.items() for part in item])
    return F.try_element_at(table, F.col(name))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Floating-point NaN becomes null in every column."""
    floating = [
        field.name
        for field in df.schema
        if isinstance(field.dataType, (T.FloatType, T.DoubleType))
    ]
    if not floating:
        return df
    return df.withColumns(
        {name: F.when(~F.isnan(name), F.col(name)) for name in floating}
    )


def iso_seconds(column: Column) -> Column:
    """ISO-8601 text to the second."""
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> None:
    """Raise ``ValueError`` naming every absent column."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")

"""The three source tables as one value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from studytrace.functions.columns import between
from studytrace.operators.joins import users_of


@dataclass(frozen=True)
class Tables:
    """Log, user and content, whatever source they come from."""

    log: DataFrame
    user: DataFrame
    content: DataFrame


def log_slice(tables: Tables, start, end) -> Tables:
    """Log rows in ``[start, end)``, all users, all content."""
    log = tables.log.filter(between(tables.log, "timestamp_TW", start, end))
    return Tables(log, tables.user, tables.content)


def time_slice(tables: Tables, start, end) -> Tables:
    """Log rows in ``[start, end)``, the users occurring there, all content."""
    cut = log_slice(tables, start, end)
    return Tables(cut.log, users_of(cut.log, cut.user), cut.content)

"""Exact prefix and exact split without sorting the data.

Both ask for the n-th row of some order. It is found by counting: a few probe
rows cut the order into slots, one pass counts the rows in each slot and the rows
equal to each probe, and the slot that holds the n-th row is cut again, until few
rows are left. What remains for the data is a comparison with that one row, which
needs no shuffle.

Several rows can share that row's order. Then only those rows are looked at
again: in the order of their other columns, and where even these agree, by
number. The count is exact in every case.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from studytrace.functions.columns import (
    ascending,
    is_orderable,
    literal,
    log_order,
    order_tuple,
    portable,
    row_key,
)
from studytrace.session import durable

FINISH_ROWS = 200_000
#: Rows that cut a slot, per round.
PROBES = 63
SPLIT_SEED = 760
TRAIN_FRACTION = 0.8

_HASH = "_split_hash"
_TUPLE = "_order_tuple"


@dataclass(frozen=True)
class Cut:
    """The order of the n-th row: its key, and how many rows are before and at it."""

    order: tuple[str, ...]
    key: tuple
    before: int
    equal: int

    def bound(self, df: DataFrame) -> Column:
        """The key as a value comparable with ``order_tuple``."""
        return _tuple_of(df, self.order, self.key)


def _tuple_of(df: DataFrame, order: Sequence[str], key: Sequence) -> Column:
    parts = []
    for name, value in zip(order, key, strict=True):
        parts += [F.lit(value is None), literal(value, df.schema[name].dataType)]
    return F.struct(*[part.alias(f"o{i}") for i, part in enumerate(parts)])


def _portable_keys(df: DataFrame, order: Sequence[str]) -> list[tuple]:
    """The order columns of few rows, as values that ``literal`` takes back."""
    cells = [portable(F.col(name), df.schema[name].dataType) for name in order]
    return [tuple(row) for row in df.select(*[c.alias(f"c{i}") for i, c in enumerate(cells)]).collect()]


def leading_range(df: DataFrame, name: str, low, high) -> Column:
    """What rows between two keys fulfil in their first column, nulls last.

    Implied by comparing whole keys, but in a form that scans can skip data by.
    """
    column, dtype = F.col(name), df.schema[name].dataType
    inside = F.lit(True)
    if high is not None:
        inside = inside & (column <= literal(high, dtype))
    if low is not None:
        above = column >= literal(low, dtype)
        inside = inside & (above if high is not None else above | column.isNull())
    return inside


def _slot(bounds: Sequence[Column], low: int, high: int) -> Column:
    """2 i + 1 for rows equal to probe i, 2 i for rows between probes i - 1 and i."""
    if low > high:
        return F.lit(2 * low)
    middle = (low + high) // 2
    here = F.col(_TUPLE)
    return (
        F.when(here == bounds[middle], F.lit(2 * middle + 1))
        .when(here < bounds[middle], _slot(bounds, low, middle - 1))
        .otherwise(_slot(bounds, middle + 1, high))
    )


def find_cut(df: DataFrame, order: Sequence[str], n: int, total: int) -> Cut:
    """The order of the n-th of ``total`` rows (from 1), for any orderable columns.

    Every round reads the order columns within a range of the leading one, and
    isolates at least one key, so that it ends whatever the values are. Probes
    are random rows; they steer the search but not its result.
    """
    order = list(order)
    rows, low, high, before, held = df.select(*order), None, None, 0, total
    while held > FINISH_ROWS:
        inside = _between(df, rows, order, low, high)
        sample = inside.orderBy(F.rand(before + 1)).limit(PROBES)
        keys = _portable_keys(sample.distinct().orderBy(*ascending(order)), order)
        bounds = [_tuple_of(df, order, key) for key in keys]
        counts = dict(
            inside.withColumn(_TUPLE, order_tuple(order))
            .groupBy(_slot(bounds, 0, len(bounds) - 1).alias("slot"))
            .count()
            .collect()
        )
        slot = 0
        while before + counts.get(slot, 0) < n:
            before += counts.get(slot, 0)
            slot += 1
        held = counts[slot]
        if slot % 2:
            return Cut(tuple(order), keys[slot // 2], before, held)
        low = keys[slot // 2 - 1] if slot else low
        high = keys[slot // 2] if slot // 2 < len(keys) else high
    inside = _between(df, rows, order, low, high)
    last = inside.orderBy(*ascending(order)).offset(n - before - 1).limit(1)
    key = _portable_keys(last, order)[0]
    here, bound = order_tuple(order), _tuple_of(df, order, key)
    less, equal = inside.agg(F.count_if(here < bound), F.count_if(here == bound)).first()
    return Cut(tuple(order), key, before + less, equal)


def _between(df: DataFrame, rows: DataFrame, order: Sequence[str], low, high) -> DataFrame:
    """Rows after the key ``low`` and before the key ``high``, where given."""
    here = order_tuple(order)
    first = [key[0] if key is not None else None for key in (low, high)]
    chosen = leading_range(df, order[0], *first)
    if low is not None:
        chosen = chosen & (here > _tuple_of(df, order, low))
    if high is not None:
        chosen = chosen & (here < _tuple_of(df, order, high))
    return rows.filter(chosen)


def mark_first(df: DataFrame, order: Sequence[str], n: int, total: int, name: str) -> DataFrame:
    """Add ``name``: true for exactly ``n`` rows, the first ones in ``order``.

    Rows equal in ``order`` follow one another by their other columns, nulls
    last, as far as these can be ordered. Of rows equal in all of them some are
    chosen. ``total`` is the row count of ``df``.
    """
    if n <= 0 or n >= total:
        return df.withColumn(name, F.lit(n > 0))
    cut = find_cut(df, order, n, total)
    here, bound = order_tuple(order), cut.bound(df)
    wanted = n - cut.before
    if wanted == cut.equal:
        return df.withColumn(name, here <= bound)
    others = df.filter(here != bound).withColumn(name, here < bound)
    return others.unionByName(_mark_equal(df.filter(here == bound), cut, wanted, name))


def head_in_order(
    df: DataFrame, n: int, order: Sequence[str] | None = None
) -> DataFrame:
    """The first ``n`` rows in log order; all rows when there are fewer.

    See ``mark_first`` for rows that share an order.
    """
    order = list(order or log_order(df))
    if n <= 0:
        return df.limit(0)
    total = df.count()
    if n >= total:
        return df
    cut = find_cut(df, order, n, total)
    here, bound = order_tuple(order), cut.bound(df)
    lead = leading_range(df, order[0], None, cut.key[0])
    wanted = n - cut.before
    if wanted == cut.equal:
        return df.filter(lead & (here <= bound))
    equal = df.filter(leading_range(df, order[0], cut.key[0], cut.key[0]) & (here == bound))
    chosen = _mark_equal(equal, cut, wanted, _HASH).filter(_HASH).drop(_HASH)
    return df.filter(lead & (here < bound)).unionByName(chosen)


def _mark_equal(equal: DataFrame, cut: Cut, wanted: int, name: str) -> DataFrame:
    """Mark ``wanted`` of the rows that share the key of ``cut``."""
    rest = [f.name for f in equal.schema if f.name not in cut.order and is_orderable(f.dataType)]
    if rest:
        inner = find_cut(equal, rest, wanted, cut.equal)
        here, bound = order_tuple(rest), inner.bound(equal)
        left = wanted - inner.before
        if left == inner.equal:
            return equal.withColumn(name, here <= bound)
        others = equal.filter(here != bound).withColumn(name, here < bound)
        return others.unionByName(_mark_some(equal.filter(here == bound), left, name))
    return _mark_some(equal, wanted, name)


def _mark_some(alike: DataFrame, wanted: int, name: str) -> DataFrame:
    """Mark any ``wanted`` rows: whole partitions first, then a part of one.

    The rows are written once, so that both passes see the same partitions.
    """
    part, place = "_part", "_place"
    held = durable(alike).withColumns(
        # The lower bits number the rows of a partition.
        {part: F.spark_partition_id(), place: F.monotonically_increasing_id().bitwiseAND(2**33 - 1)}
    )
    counts = held.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    earlier = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    # One row per partition.
    starts = counts.select(part, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_start"))
    return (
        held.join(F.broadcast(starts), part)
        .withColumn(name, F.col("_start") + F.col(place) < wanted)
        .drop(part, place, "_start")
    )


def head_percent(df: DataFrame, percent: float = 1.0, order=None) -> DataFrame:
    """The leading ``percent`` of the rows in log order, rounded half to even."""
    return head_in_order(df, round(df.count() * percent / 100), order)


def split_hash(key: Sequence[str], seed: int) -> Column:
    """A reproducible pseudo-random order of rows: hash of seed and row key."""
    return F.md5(
        F.concat_ws(
            ":",
            F.lit(str(seed)),
            *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in key],
        )
    )


def train_test_split(
    df: DataFrame,
    key: Sequence[str] | None = None,
    fraction: float = TRAIN_FRACTION,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Add ``is_train``: exactly floor(fraction · n) rows are true.

    ``key`` names a row; by default it is the row id, else the log's primary
    key. The choice depends on seed and key, not on partitioning or row order;
    rows that share a key are told apart as in ``mark_first``.
    """
    key = list(key or row_key(df))
    total = df.count()
    hashed = df.withColumn(_HASH, split_hash(key, seed))
    wanted = math.floor(total * fraction)
    return mark_first(hashed, [_HASH, *key], wanted, total, "is_train").drop(_HASH)

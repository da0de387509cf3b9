"""Running totals, previous values and positions over an ordered key group.

A window function sends each key group to one task. That is the right plan
while groups are small, and it is the plan used here. If a group has more than
``block_rows`` rows, the log is written once in blocks: contiguous ranges of its
order, whatever the keys, each small enough for one task. Large groups are then
windowed block by block, and what earlier blocks of the group contribute (one row
per group and block) is added on; other groups stay whole. Several windows with
different keys share the blocks. Totals are sums of whole numbers, so both plans
give the same values, and which groups count as large is a question of speed alone.

With N rows there are at most N / ``block_rows`` blocks and as many large groups,
so the added rows are no more than a share N / ``block_rows`` ² of the log.

``large`` says which groups those are: ``MEASURE`` counts the rows at hand, None
states that there are none, and a ``LargeGroups`` is the result of an earlier
count, for instance over the source table before expensive steps.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec

from studytrace.functions.columns import ascending, order_tuple
from studytrace.session import durable

BLOCK_ROWS = 2_000_000
BROADCAST_ROWS = 500_000

MEASURE = "measure"

_BLOCK = "_block"
_LARGE = "_large"
_PART = "_part"


def bounded_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Mark ``df`` for broadcast when its known row count is small enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


@dataclass(frozen=True)
class LargeGroups:
    """The key groups with more rows than one task should hold."""

    keys: tuple[str, ...]
    frame: DataFrame | None
    groups: int
    rows: int


def large_groups(
    df: DataFrame,
    keys: Sequence[str],
    block_rows: int = BLOCK_ROWS,
    total: int | None = None,
) -> LargeGroups | None:
    """Find groups above ``block_rows`` rows, or None when there are none.

    At most (row count / block_rows) groups can qualify. Counting combines on
    the map side, so a hot key costs one partial row per task. ``total`` is the
    row count where it is known.
    """
    total = df.count() if total is None else total
    if total <= block_rows:
        return None
    if not keys:
        return LargeGroups((), None, 1, total)
    large = durable(
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > block_rows)
    )
    found = large.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    if not found[0]:
        return None
    return LargeGroups(tuple(keys), large.select(*keys), found[0], found[1])


def any_null(names: Sequence[str]) -> Column:
    """True when one of the columns is null."""
    return F.expr(" OR ".join(f"`{name}` IS NULL" for name in names) or "false")


def _window(
    keys: Sequence[str], order: Sequence[str], scatter: Column | None = None
) -> WindowSpec:
    """Ordered window; key columns are constant in it, so they drop out of the order."""
    partition = [*keys] if scatter is None else [*keys, scatter]
    inner = [name for name in order if name not in keys]
    return W.partitionBy(*partition).orderBy(*ascending(inner or order))


def _in_windows(df, keys, order, windowed: Callable) -> DataFrame:
    """Apply ``windowed(rows, keys, scatter)`` to whole groups.

    Rows lacking a key belong to no group, and there may be very many of them.
    A plain window would gather them all in one task; ``scatter`` spreads them.
    """
    scatter = F.when(any_null(keys), F.xxhash64(*order)) if keys else None
    return windowed(df, keys, scatter)


def with_blocks(df: DataFrame, order: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` written with the number of the block that each row is in.

    Two levels: ranges of the order, as many as the session shuffles into, and
    within a range blocks of at most ``block_rows`` rows. Rows are numbered in
    sorted order, each range far apart from the next. The numbers depend on
    sampled range bounds, so they are pinned before several readers meet.
    """
    sort = ascending(dict.fromkeys(order))
    number = F.monotonically_increasing_id()
    return durable(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn(_BLOCK, F.floor(number / block_rows))
    )


def without_blocks(df: DataFrame) -> DataFrame:
    """``df`` without the column that ``with_blocks`` adds."""
    return df.drop(_BLOCK)


def _in_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    large: LargeGroups,
    block_rows: int,
    windowed: Callable,
    summarise: Sequence[Column],
    carried: Mapping[str, Column],
    combined: Mapping[str, Column],
) -> DataFrame:
    """Apply ``windowed`` to small groups and to blocks of large ones; add the carry.

    ``summarise`` reduces a block of a group to one row, ``carried`` are window
    expressions over a group's block rows, and ``combined`` merges local value
    and carry, which is null in small groups. Rows lacking a key are scattered.
    """
    rows = df if _BLOCK in df.columns else with_blocks(df, order, block_rows)
    part = F.col(_BLOCK)
    if large.frame is not None:
        chosen = bounded_broadcast(large.frame.withColumn(_LARGE, F.lit(True)), large.groups)
        rows = rows.join(chosen, list(keys), "left")
        part = F.when(any_null(keys), F.xxhash64(*order)).when(F.col(_LARGE), part)
    rows = rows.withColumn(_PART, part)
    split = rows.filter(_LARGE) if large.frame is not None else rows
    summary = split.groupBy(*keys, _PART).agg(*summarise)
    carry = summary.select(
        *keys, _PART, *[column.alias(name) for name, column in carried.items()]
    )
    # The same layout serves the window and the join.
    local = windowed(rows, [*keys, _PART], None)
    joined = local.join(carry, [*keys, _PART], "left")
    done = joined.withColumns(dict(combined))
    added = [name for name in done.columns if name not in (*df.columns, _PART, _LARGE, _BLOCK, *carried)]
    return done.select(*df.columns, *added)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    include_current: bool = False,
    block_rows: int = BLOCK_ROWS,
    large: LargeGroups | str | None = MEASURE,
) -> DataFrame:
    """Add the sum of each whole-number expression over the earlier rows.

    "Earlier" means before the row in ``order`` within its ``keys`` group, plus
    the row itself with ``include_current``. Rows with a null key get null.
    ``order`` must be total.
    """
    end = W.currentRow if include_current else -1

    def windowed(rows: DataFrame, within: Sequence[str], scatter) -> DataFrame:
        window = _window(within, order, scatter).rowsBetween(W.unboundedPreceding, end)
        return rows.withColumns(
            {
                name: F.when(
                    ~any_null(keys), F.coalesce(F.sum(value).over(window), F.lit(0))
                )
                for name, value in totals.items()
            }
        )

    if large == MEASURE:
        large = large_groups(df, keys, block_rows)
    if large is None:
        return _in_windows(df, keys, order, windowed)

    earlier = (
        W.partitionBy(*keys).orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    )
    return _in_blocks(
        df,
        keys,
        order,
        large,
        block_rows,
        windowed,
        summarise=[F.sum(value).alias(name) for name, value in totals.items()],
        carried={
            f"_carry_{name}": F.coalesce(F.sum(name).over(earlier), F.lit(0))
            for name in totals
        },
        combined={
            name: F.col(name) + F.coalesce(f"_carry_{name}", F.lit(0)) for name in totals
        },
    )


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    block_rows: int = BLOCK_ROWS,
    large: LargeGroups | str | None = MEASURE,
) -> DataFrame:
    """Add ``value`` of the row just before in the ``keys`` group, null if none."""
    first = "_first_of_block"

    def windowed(rows: DataFrame, within: Sequence[str], scatter) -> DataFrame:
        window = _window(within, order, scatter)
        return rows.withColumn(
            name, F.when(~any_null(keys), F.lag(value).over(window))
        )

    def windowed_in_block(rows: DataFrame, within: Sequence[str], scatter) -> DataFrame:
        window = _window(within, order, scatter)
        return windowed(rows, within, scatter).withColumn(
            first, F.row_number().over(window) == 1
        )

    if large == MEASURE:
        large = large_groups(df, keys, block_rows)
    if large is None:
        return _in_windows(df, keys, order, windowed)

    by_block = W.partitionBy(*keys).orderBy(_PART)
    return _in_blocks(
        df,
        keys,
        order,
        large,
        block_rows,
        windowed_in_block,
        summarise=[F.max_by(F.struct(value.alias("v")), order_tuple(order)).alias("_last")],
        carried={"_carry": F.lag("_last").over(by_block)},
        combined={name: F.when(F.col(first), F.col("_carry.v")).otherwise(F.col(name))},
    ).drop(first)


def positions(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the dense 0-based position of every row in ``order``."""
    return running_totals(df, [], order, {name: F.lit(1)}, block_rows=block_rows)


def ordinals(
    df: DataFrame,
    column: str,
    name: str,
    rows: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Distinct non-null values of ``column`` numbered 0, 1, … in ascending order.

    ``rows`` is the number of distinct values where the caller knows it.
    """
    values = df.select(column).dropna().distinct()
    large = MEASURE if rows is None else large_groups(values, [], block_rows, rows)
    return running_totals(
        values, [], [column], {name: F.lit(1)}, block_rows=block_rows, large=large
    ).withColumn(name, F.col(name).cast("int"))

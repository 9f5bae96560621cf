"""Time series keyed (SegmentID, Direction): ends, trailing windows, observations, grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.functions.event_time import days, seconds, tick_floor
from curbcount.operators.lookup import lookup_join
from curbcount.session import materialise

_END = "__series_end"


def series_range(
    captures: DataFrame,
    keys: Sequence[str] = schemas.SERIES_KEYS,
    ts: str = "Timestamp",
    step_seconds: int = schemas.STEP_SECONDS,
) -> DataFrame:
    """First time less one step, and last time, of every series.

    With the step taken off, a complete history of n days measures exactly n days.
    """
    return captures.groupBy(*keys).agg(
        (F.min(ts) - seconds(step_seconds)).alias("min_history_ds"),
        F.max(ts).alias("max_history_ds"),
    )


def series_ends(
    captures: DataFrame, keys: Sequence[str] = schemas.SERIES_KEYS, ts: str = "Timestamp"
) -> DataFrame:
    """Last time of every series, written once; a combinable aggregate over two or three columns."""
    return materialise(captures.groupBy(*keys).agg(F.max(ts).alias(_END)), "series-ends")


def trim_history(
    captures: DataFrame,
    limit_days: int,
    keys: Sequence[str] = schemas.SERIES_KEYS,
    ts: str = "Timestamp",
    ends: DataFrame | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Rows newer than the end of their own series less ``limit_days`` (strictly).

    A window over the key would put a whole series in one task. Instead the series ends, one
    row per series, are computed first (or given as ``ends``). The earliest end gives a bound
    that reaches the scan, and the exact test is a lookup join on the rest.
    """
    ends = series_ends(captures, keys, ts) if ends is None else ends
    floor = ends.agg((F.min(_END) - days(limit_days)).alias("floor"))
    recent = captures.filter(F.col(ts) > floor.scalar())
    return (
        lookup_join(recent, ends, keys, broadcast_limit)
        .filter(F.col(ts) > F.col(_END) - days(limit_days))
        .drop(_END)
        .select(*captures.columns)
    )


def trim_ranges(
    captures: DataFrame,
    ranges: Sequence[int] = schemas.HISTORY_DAYS,
    keys: Sequence[str] = schemas.SERIES_KEYS,
    ts: str = "Timestamp",
    ends: DataFrame | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """:func:`trim_history` for several lengths in one pass, with ``history_days``.

    Rows are trimmed to the longest range and repeated for every range that still holds them.
    """
    ends = series_ends(captures, keys, ts) if ends is None else ends
    floor = ends.agg((F.min(_END) - days(max(ranges))).alias("floor"))
    joined = lookup_join(captures.filter(F.col(ts) > floor.scalar()), ends, keys, broadcast_limit)
    held = F.array_compact(F.array(*[F.when(F.col(ts) > F.col(_END) - days(d), F.lit(d)) for d in ranges]))
    return joined.withColumn("history_days", F.explode(held)).select(*captures.columns, "history_days")


def observations(
    captures: DataFrame,
    keys: Sequence[str] = schemas.SERIES_KEYS,
    ts: str = "Timestamp",
    value: str = "Vol",
) -> DataFrame:
    """One row per series and second: count, sum, sum of squares, least and greatest value.

    These are all a least-squares fit needs, so repeated observations of one time collapse
    before the shuffle. A series of n days then has at most ``n * 86400`` rows whatever the
    number of raw rows, and ``n * 96`` at the nominal step.
    """
    y = F.col(value).cast("double")
    return (
        captures.withColumn("ds", tick_floor(ts, 1))
        .groupBy(*keys, "ds")
        .agg(
            F.count(y).alias("n"),
            F.sum(y).alias("sum_y"),
            F.sum(y * y).alias("sum_yy"),
            F.min(y).alias("min_y"),
            F.max(y).alias("max_y"),
        )
    )


def future_grid(
    ends: DataFrame,
    steps: int = schemas.HORIZON_STEPS,
    step_seconds: int = schemas.STEP_SECONDS,
    end: str = "max_history_ds",
) -> DataFrame:
    """The next ``steps`` times after the end of each series, as column ``ds``."""
    grid = F.transform(
        F.sequence(F.lit(1), F.lit(steps)),
        lambda i: F.col(end) + F.make_dt_interval(secs=i * F.lit(step_seconds)),
    )
    return ends.withColumn("ds", F.explode(grid))


def running_ticks(
    rows: DataFrame,
    order: str,
    ts: str = "Timestamp",
    block_rows: int = 1_000_000,
    group_blocks: int = 1_000_000,
) -> DataFrame:
    """Adds ``tick``: the greatest event time so far in the order of column ``order``.

    A row that is older than an earlier one belongs to the tick already reached. A row without order has
    no place in it: it stays, with a null tick. The running maximum is computed in blocks of the order
    column, carried from block to block in groups of blocks, and so on: three levels hold any 64-bit
    order, dense or sparse, and no task sees more than ``block_rows`` distinct places of the order or
    ``group_blocks`` (two at least) of a level.
    """
    placed = rows.filter(F.col(order).isNotNull()).withColumn("__block", _group(F.col(order), block_rows))
    tops = materialise(placed.groupBy("__block").agg(F.max(ts).alias("__top")), "block-tops")
    inside = Window.partitionBy("__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ticked = (
        placed.withColumn("__run", F.max(ts).over(inside))
        .join(_carried(tops, max(2, group_blocks)), "__block")
        .withColumn("tick", F.greatest("__run", "__carry"))
        .select(*rows.columns, "tick")
    )
    missing = rows.filter(F.col(order).isNull()).withColumn("tick", F.lit(None).cast(ticked.schema["tick"].dataType))
    return ticked.unionByName(missing)


def _group(place: Column, size: int) -> Column:
    return F.floor(place / F.lit(size)).cast("bigint")


def _carried(tops: DataFrame, size: int) -> DataFrame:
    """(__block, __carry): the greatest ``__top`` of all blocks before each block."""
    if tops.agg(F.count(F.lit(1)) <= F.lit(size)).first()[0]:
        before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
        return tops.select("__block", F.max("__top").over(before).alias("__carry"))
    grouped = tops.withColumn("__group", _group(F.col("__block"), size))
    above = materialise(grouped.groupBy("__group").agg(F.max("__top").alias("__top")), "block-tops")
    carry = _carried(above.withColumnRenamed("__group", "__block"), size).select(F.col("__block").alias("__group"), F.col("__carry").alias("__above"))
    within = Window.partitionBy("__group").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    own = grouped.withColumn("__own", F.max("__top").over(within)).join(carry, "__group")
    return own.select("__block", F.greatest("__own", "__above").alias("__carry"))

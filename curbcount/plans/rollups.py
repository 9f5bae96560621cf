"""Current and recent traffic volumes by location and borough."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.functions.event_time import first_instant_after_tick, tick_floor
from curbcount.functions.event_time import hours as hours_span
from curbcount.operators.lookup import fits_broadcast, lookup_join


def current_tick(captures: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """One row: the newest event time, as ``current_ts``."""
    return captures.agg(F.max(ts).alias("current_ts"))


def recent(
    captures: DataFrame, hours: int = schemas.RECENT_HOURS, ts: str = "Timestamp",
    raw_step: int | None = None,
) -> DataFrame:
    """Rows of the last ``hours`` before the newest event time, lower bound excluded.

    The bound is a scalar subquery of the same plan: no value passes through the driver, and
    the comparison with a stored column is pushed into the scan. If ``ts`` holds raw times
    that still have to be floored to steps of ``raw_step`` seconds, the same rows are found by
    moving the bound instead of computing every row's step.
    """
    if raw_step is None:
        bound = captures.agg((F.max(ts) - hours_span(hours)).alias("bound"))
        return captures.filter(F.col(ts) > bound.scalar())
    edge = tick_floor(F.max(ts), raw_step) - hours_span(hours)
    first = captures.agg(first_instant_after_tick(edge, raw_step).alias("bound"))
    return captures.filter(F.col(ts) >= first.scalar())


def current(captures: DataFrame, ts: str = "Timestamp", raw_step: int | None = None) -> DataFrame:
    """Rows of the newest event time, or of the newest step of raw times."""
    if raw_step is None:
        return captures.filter(F.col(ts) == current_tick(captures, ts).scalar())
    newest = captures.agg(tick_floor(F.max(ts), raw_step).alias("bound"))
    return captures.filter(F.col(ts) >= newest.scalar())


def latest_run(predictions: DataFrame, after: Column, ts: str = "Timestamp") -> DataFrame:
    """Predictions of the newest run for times later than ``after``.

    The newest run is the greatest run time over all predictions, found by a combinable
    aggregate instead of a window over one partition. Empty if that run has no later time.
    """
    newest = predictions.agg(F.max("prediction_ds").alias("newest"))
    return predictions.filter(
        (F.col(ts) > after) & (F.col("prediction_ds") == newest.scalar())
    ).select("SegmentID", ts, "Direction", "prediction_vol")


def partials(
    facts: DataFrame, value: str, by: Sequence[str], segments: DataFrame,
    attributes: Sequence[str], limit: int | None = None,
) -> DataFrame:
    """Sum and count of ``value`` by segment attributes and the columns ``by``.

    A small dimension is broadcast and the facts go straight into the map-side aggregate. A
    large one is joined after the facts have been reduced to one row per segment and ``by``,
    so the rows of a hot segment never meet in one join task. Both ways count a segment
    that occurs twice in the dimension twice, as a join of single rows does.
    """
    places = segments.select("SegmentID", *attributes)
    total, count = F.sum(value).alias("__sum"), F.count(value).alias("__count")
    if fits_broadcast(places, limit):
        joined = facts.select("SegmentID", *by, value).join(F.broadcast(places), "SegmentID")
        return joined.groupBy(*attributes, *by).agg(total, count)
    reduced = facts.groupBy("SegmentID", *by).agg(total, count)
    # Reduced rows are unique per segment and tick, so the hash of a row spreads them.
    joined = lookup_join(reduced, places, ["SegmentID"], limit)
    return joined.groupBy(*attributes, *by).agg(
        F.sum("__sum").alias("__sum"), F.sum("__count").alias("__count")
    )


def _mean() -> Column:
    return F.try_divide(F.col("__sum").cast("double"), F.col("__count"))


def location_totals(
    captures: DataFrame, segments: DataFrame, ts: str = "Timestamp", limit: int | None = None
) -> DataFrame:
    """Total volume by time and coordinates, with the weight of the heat map."""
    sums = partials(captures, "Vol", [ts], segments, ["Long", "Lat"], limit)
    return sums.select(
        ts, "Long", "Lat", F.col("__sum").alias("total_vol"),
        (F.col("__sum") / F.lit(schemas.HEAT_DIVISOR)).alias("weight"),
    )


def borough_means(
    facts: DataFrame, segments: DataFrame, value: str = "Vol", ts: str = "Timestamp",
    limit: int | None = None,
) -> DataFrame:
    """Mean of ``value`` by borough and time, as column ``Vol``; sort with :func:`for_display` at the end."""
    sums = partials(facts, value, [ts], segments, ["Boro"], limit)
    return sums.select("Boro", ts, _mean().alias("Vol"))


def for_display(means: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """Served order: by time, then borough. Not for steps that others build on."""
    return means.orderBy(ts, "Boro")


def borough_partials(
    facts: DataFrame, segments: DataFrame, value: str = "Vol", ts: str = "Timestamp",
    limit: int | None = None,
) -> DataFrame:
    """Mergeable form of the borough means: sum and count."""
    sums = partials(facts, value, [ts], segments, ["Boro"], limit)
    return sums.select("Boro", ts, F.col("__sum").alias("sum_vol"), F.col("__count").alias("n_vol"))


def merge_partials(parts: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """Means from any number of partial sums and counts."""
    merged = parts.groupBy("Boro", ts).agg(F.sum("sum_vol").alias("__sum"), F.sum("n_vol").alias("__count"))
    return merged.select("Boro", ts, _mean().alias("Vol"))


def stitch(history: DataFrame, forecast: DataFrame, ts: str = "Timestamp") -> DataFrame:
    """The newest history point of each borough followed by the forecast after it.

    The forecast line then starts where the history line ends.
    """
    now = current_tick(history, ts)
    seam = history.filter(F.col(ts) == now.scalar()).withColumn("kind", F.lit("history"))
    ahead = forecast.filter(F.col(ts) > now.scalar()).withColumn("kind", F.lit("forecast"))
    return seam.unionByName(ahead)


def borough_series(df: DataFrame, boro: str) -> DataFrame:
    """The rows of one borough."""
    return df.filter(F.col("Boro") == boro)

"""Replay of stored captures as a time-ordered log for the file stream source."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.functions.event_time import MINUTE_FORMAT, tick_floor
from curbcount.session import new_path, scratch
from curbcount.sources import files
from curbcount.sources.topics import Topic, append, encoded

DEFAULT_SLICE_SECONDS = 24 * 3600
SLICE = "slice"


def with_tick(df: DataFrame, ts: str = "Timestamp", step_seconds: int = schemas.STEP_SECONDS) -> DataFrame:
    """Adds ``tick``, the step a row belongs to."""
    return df.withColumn("tick", tick_floor(ts, step_seconds))


def append_minutes(df: DataFrame, topic: Topic) -> None:
    """Live form of :func:`append`: event time as text to the minute."""
    append(df, topic, MINUTE_FORMAT)


def write_replay_log(
    captures: DataFrame,
    path: str,
    ts: str = "Timestamp",
    slice_seconds: int = DEFAULT_SLICE_SECONDS,
    time_format: str = MINUTE_FORMAT,
) -> int:
    """Write the captures as JSON records in slices of event time, oldest first.

    The file stream source takes files by modification time, so later slices are read later.
    A stream whose watermark delay is at least ``slice_seconds`` then drops nothing, however
    the files of one slice fall into micro-batches. One job writes all slices, each by several tasks if it is large; then
    their folders are renamed into place, oldest first, and their files dated in that order, so the number of
    jobs does not grow with the number of slices. A slice replaces itself when the log is written again. Slices without rows are left out, so a gap costs nothing, and their number has no
    limit. Rows without event time belong to no slice; they go to ``<path>-untimed``, in the same form.
    Returns the number of slices from the first to the last.
    """
    spark = captures.sparkSession
    first = captures.agg(F.min(tick_floor(ts, slice_seconds)).alias("lo"))
    number = F.floor(F.timestamp_diff("SECOND", first.scalar(), F.col(ts)) / F.lit(slice_seconds)).cast("bigint")
    with scratch(spark):
        staging = new_path(spark, "replay")
        staged = captures.select(number.alias(SLICE), F.struct(*captures.columns).alias("record"))
        records = staged.select(SLICE, encoded("record", captures.schema, time_format).alias("value"))
        records.hint("rebalance", SLICE).write.partitionBy(SLICE).text(staging)
        names = [e.name.removeprefix(f"{SLICE}=") for e in files.listing(spark, staging) if e.folder]
        numbers = sorted(int(n) for n in names if n.isdigit())
        for name in names:
            if not name.isdigit():
                files.move(spark, f"{staging}/{SLICE}={name}", f"{path}-untimed")
        begun = int(time.time() * 1000) - len(numbers)
        for k, n in enumerate(numbers):
            folder = f"{path}/{SLICE}={n:06d}"
            files.move(spark, f"{staging}/{SLICE}={n}", folder)
            for entry in files.listing(spark, folder):
                files.touch(spark, entry.path, begun + k)
    return numbers[-1] + 1 if numbers else 0

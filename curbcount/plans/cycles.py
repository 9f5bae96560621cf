"""The jobs that run once per cycle: forecast, rollups, accuracy."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.plans import rollups
from curbcount.plans.accuracy import accuracy
from curbcount.plans.forecast import forecast
from curbcount.session import materialise, scratch
from curbcount.sources.snapshots import publish
from curbcount.sources.topics import Topic, append, checked_snapshot, newest_run, snapshot, split_valid

REJECTED = "rejected STRING, reason STRING"


def checked(spark: SparkSession, topic: Topic, keys: Sequence[str], bound=None, quarantine: str | None = None) -> DataFrame:
    """The good records of a log, to be called inside ``scratch``. With ``quarantine`` the others are published there, with
    text and reason, as the version of this cycle; the log is scanned and decoded once for both."""
    if quarantine is None:
        return split_valid(snapshot(spark, topic, bound), keys)[0]
    read = materialise(checked_snapshot(spark, topic, keys, bound), "checked")
    publish(read.filter("reason IS NOT NULL").select("rejected", "reason"), quarantine, 0, uuid.uuid4().hex)
    return read.filter(F.col("reason").isNull()).drop("reason", "rejected")


def forecast_cycle(
    spark: SparkSession, captures: Topic, predictions: Topic, bound=None, run_time: Column | None = None, quarantine: str | None = None
) -> None:
    """Forecast every series from the capture log and append to the prediction log.

    The forecast is written once before it is encoded, so all its rows carry one run time
    even if a task is repeated.
    """
    with scratch(spark):
        history = checked(spark, captures, schemas.CAPTURE_KEYS, bound, quarantine)
        append(materialise(forecast(history, run_time=run_time), "forecast"), predictions)


def rollup_frames(
    captures: DataFrame, segments: DataFrame, predictions: DataFrame
) -> dict[str, DataFrame]:
    """The three served tables from one state of the input tables."""
    now = rollups.current_tick(captures)
    ahead = rollups.latest_run(predictions, now.scalar())
    return {
        "batch": rollups.location_totals(rollups.current(captures), segments).drop("weight"),
        "cache": rollups.for_display(rollups.borough_means(rollups.recent(captures), segments)),
        "prediction": rollups.for_display(rollups.borough_means(ahead, segments, "prediction_vol")),
    }


def rollup_cycle(
    spark: SparkSession, captures: Topic, segments: Topic, predictions: Topic, root: str, version: int,
    bound=None, quarantine: str | None = None,
) -> None:
    """Publish the three served tables as one version each.

    Only recent captures matter, so the decoded log is first cut to the rows the tables need
    and written once; the three tables then share one snapshot. ``bound`` limits how far
    back the captures are read at all: files that end before it are not opened. Nor are files of older runs.
    """
    with scratch(spark):
        valid = checked(spark, captures, schemas.CAPTURE_KEYS, bound, quarantine)
        places, _ = split_valid(snapshot(spark, segments), ["SegmentID"])
        guesses = newest_run(spark, predictions)
        kept = materialise(rollups.recent(valid), "recent-captures")
        for name, table in rollup_frames(kept, places, guesses).items():
            publish(table, f"{root}/{name}", version)


def accuracy_cycle(
    spark: SparkSession, captures: Topic, predictions: Topic, bound=None, root: str | None = None, version: int = 0
) -> DataFrame:
    """The accuracy table over both logs, computed anew; with ``root`` it is published there, too.

    :func:`curbcount.plans.scores.accuracy_writer` keeps the same table up to date from new records only.
    """
    table = accuracy(snapshot(spark, captures, bound), snapshot(spark, predictions, bound))
    if root:
        publish(table, root, version)
    return table

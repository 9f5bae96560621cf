"""Forecast accuracy by length of history and forecast horizon."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.functions.event_time import interval_days, interval_minutes

# Names of the axes as the data model defines them.
AXES = ["range_days", "future_forecasting_minutes"]
#: What a match has of a capture.
ACTUAL = ["SegmentID", "Direction", "Timestamp", "Vol"]


def forecast_axes(predictions: DataFrame) -> DataFrame:
    """Adds the length of history in days and the horizon in minutes."""
    return predictions.withColumns(
        {
            "range_days": interval_days(F.col("max_history_ds") - F.col("min_history_ds")),
            "future_forecasting_minutes": interval_minutes(
                F.col("Timestamp") - F.col("max_history_ds")
            ),
        }
    )


def errors(captures: DataFrame, predictions: DataFrame) -> DataFrame:
    """Distinct matches of captures and predictions with absolute and relative error.

    Every output column is a function of the capture row and the prediction row without its
    run time, so dropping duplicates on both sides first gives the same distinct rows as
    doing it after the join, and re-sent captures or repeated runs do not multiply. Captures
    outside the time span of the predictions are not read. The relative error of a zero
    volume is null.
    """
    first = predictions.agg(F.min("Timestamp").alias("first")).scalar()
    last = predictions.agg(F.max("Timestamp").alias("last")).scalar()
    covered = captures.filter(F.col("Timestamp").between(first, last))
    actual = covered.select(*ACTUAL).distinct()
    guessed = predictions.drop("prediction_ds").distinct()
    return distinct_errors(actual, guessed)


def distinct_errors(actual: DataFrame, guessed: DataFrame) -> DataFrame:
    """:func:`errors` of rows that are known to be distinct, captures of the columns ``ACTUAL``, predictions without run time."""
    return actual.join(guessed, schemas.CAPTURE_KEYS).withColumns(
        {
            "AE": F.abs(F.col("Vol") - F.col("prediction_vol")),
            "APE": F.try_divide(F.col("AE"), F.col("Vol")),
        }
    )


def accuracy(
    captures: DataFrame, predictions: DataFrame, range_days: Sequence[int] = schemas.HISTORY_DAYS
) -> DataFrame:
    """MAE and MAPE per history length and horizon; ``zero_vol`` counts rows MAPE leaves out.

    The history lengths are filtered on the prediction side before anything is shuffled, and
    the axes are computed again after the join, so they are not shuffled either.
    """
    wanted = forecast_axes(predictions).filter(F.col("range_days").isin(*range_days)).drop(*AXES)
    return (
        forecast_axes(errors(captures, wanted))
        .groupBy(*AXES)
        .agg(
            F.avg("AE").alias("MAE"),
            F.avg("APE").alias("MAPE"),
            F.count(F.lit(1)).alias("pairs"),
            F.count_if(F.col("Vol") == 0).alias("zero_vol"),
        )
        .orderBy(*AXES)
    )


def integer_axes(result: DataFrame) -> DataFrame:
    """The axes as integers, for labels."""
    return result.withColumns({axis: F.col(axis).cast("int") for axis in AXES})


def show_accuracy(result: DataFrame, rows: int = 75) -> None:
    result.show(rows, truncate=False)

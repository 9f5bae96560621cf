"""Forecast of the next hour for every series, from several lengths of history."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from curbcount import schemas
from curbcount.functions.event_time import seconds
from curbcount.operators.additive import fit_predict
from curbcount.operators.series import future_grid, observations, series_range, trim_history
from curbcount.plans.long_fit import forecast_all

HISTORY, FUTURE = "history", "future"


DAY_MICROS = 86_400_000_000
_STATS = ("n", "sum_y", "sum_yy", "min_y", "max_y")


def _series_fits(times, stats, ranges, steps: int, step: int, include_history: bool) -> list[tuple]:
    """Fits of one series: times, values, start of history, end of history, range in days."""
    end = times[-1]
    future = end + step * np.arange(1, steps + 1)
    fits = []
    for limit in ranges:
        start = 0 if limit is None else np.searchsorted(times, end - limit * DAY_MICROS, "right")
        at = np.concatenate([times[start:], future]) if include_history else future
        values = fit_predict(times[start:] / DAY_MICROS, *(s[start:] for s in stats), at / DAY_MICROS)
        if values is not None:
            fits.append((at, values, times[start] - step, end, limit))
    return fits


def _whole_series(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows of whole series, and the positions where each begins and the last ends, of a partition sorted by series.

    Many short series share one Arrow batch, which costs less than a batch per series; a
    series that runs over several batches is held until it ends. Only one batch and one
    series are in memory.
    """

    def starts(batch: pd.DataFrame, before: pd.DataFrame | None) -> np.ndarray:
        """Positions where a new series begins, given the rows that came before."""
        new = np.zeros(len(batch), dtype=bool)
        for k in schemas.SERIES_KEYS:
            column = batch[k].to_numpy()
            new[1:] |= column[1:] != column[:-1]
            new[0] |= before is None or before[k].iloc[-1] != column[0]
        return np.flatnonzero(new)

    held: list[pd.DataFrame] = []  # rows of the series that may go on
    for batch in filter(len, batches):
        begins = starts(batch, held[-1] if held else None)
        held.append(batch)
        if not begins.size:
            continue
        pool = pd.concat(held, ignore_index=True)
        cuts = np.unique([0, *(begins + len(pool) - len(batch))])
        if cuts.size > 1:
            yield pool, cuts
        held = [pool.iloc[cuts[-1] :]]
    if held:
        pool = pd.concat(held, ignore_index=True)
        yield pool, np.array([0, len(pool)])


def _fit_sorted(ranges, steps: int, step_seconds: int, include_history: bool, names: Sequence[str]):
    """Function over a partition sorted by series and time: fits each series as it completes."""
    step = step_seconds * 1_000_000

    def fit_all(frame: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame | None:
        times = frame["ds"].to_numpy("datetime64[us]").astype("int64")
        stats = [frame[c].to_numpy("float64") for c in _STATS]
        keys = [frame[k].to_numpy() for k in schemas.SERIES_KEYS]
        fits, owners = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            found = _series_fits(times[lo:hi], [s[lo:hi] for s in stats], ranges, steps, step, include_history)
            fits += found
            owners += [lo] * len(found)
        if not fits:
            return None
        at, values, starts, ends, limits = zip(*fits)
        sizes = [a.size for a in at]
        ds, end, owner = np.concatenate(at), np.repeat(ends, sizes), np.repeat(owners, sizes)
        columns = {
            "ds": ds.astype("datetime64[us]"),
            "yhat": np.concatenate(values),
            "min_history_ds": np.repeat(starts, sizes).astype("datetime64[us]"),
            "max_history_ds": end.astype("datetime64[us]"),
            "history_days": pd.array(np.repeat(np.array(limits, dtype=object), sizes), dtype="Int32"),
            "kind": np.where(ds <= end, HISTORY, FUTURE),
            **{name: key[owner] for name, key in zip(schemas.SERIES_KEYS, keys)},
        }
        return pd.DataFrame({name: columns[name] for name in names})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pool, cuts in _whole_series(batches):
            if (done := fit_all(pool, cuts)) is not None:
                yield done

    return run


def _apply_sorted(function: Callable[[tuple, pd.DataFrame], pd.DataFrame], names: Sequence[str]):
    """Function over a partition sorted by series and time: ``function`` of each series as it completes.

    Results are sent on together; those whose columns differ in type stay apart, so that none is converted on its way.
    """

    def laid_out(result: pd.DataFrame) -> pd.DataFrame:
        if not isinstance(result, pd.DataFrame):
            raise TypeError(f"the function of a series must return a pandas.DataFrame, not {type(result).__name__}")
        given = list(result.columns)
        if given == list(names):
            return result
        by_name = any(isinstance(c, str) for c in given)
        if len(given) != len(names) or (by_name and set(given) != set(names)):
            raise ValueError(f"the function of a series must return the columns {list(names)}, not {given}")
        return result[list(names)] if by_name else result.set_axis(list(names), axis=1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pool, cuts in _whole_series(batches):
            keys = [pool[k] for k in schemas.SERIES_KEYS]
            same, kinds = [], None
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                result = function(tuple(k[lo] for k in keys), pool.iloc[lo:hi].reset_index(drop=True))
                if not len(result.columns) and not len(result):
                    continue
                result = laid_out(result)
                if same and result.dtypes.tolist() != kinds:
                    yield pd.concat(same, ignore_index=True)
                    same = []
                same.append(result)
                kinds = result.dtypes.tolist()
            if same:
                yield pd.concat(same, ignore_index=True)

    return run


def bounded_points(
    captures: DataFrame, limit_days: int | None = max(schemas.HISTORY_DAYS), broadcast_limit: int | None = None
) -> DataFrame:
    """Observations of every series within the last ``limit_days`` before its own end."""
    for needed in (*schemas.SERIES_KEYS, "Timestamp", "Vol"):
        if needed not in captures.columns:
            raise ValueError(f"history must contain column {needed}")
    usable = captures.select(*schemas.SERIES_KEYS, "Timestamp", "Vol").dropna(
        subset=[*schemas.SERIES_KEYS, "Timestamp"]
    )
    if limit_days is not None:
        usable = trim_history(usable, limit_days, broadcast_limit=broadcast_limit)
    return observations(usable)


def apply_per_series(
    captures: DataFrame,
    function: Callable[[tuple, pd.DataFrame], pd.DataFrame],
    schema: StructType | list[str] | str,
    limit_days: int | None = max(schemas.HISTORY_DAYS),
) -> DataFrame:
    """Any function of one series, given its key and its bounded observations in order of time as pandas.

    Many series share an Arrow batch, as in :func:`fit_series`.
    """
    layout = schemas.resolve(schema)
    return _in_series_order(bounded_points(captures, limit_days)).mapInPandas(_apply_sorted(function, layout.names), layout)


def fit_series(
    captures: DataFrame,
    ranges: Sequence[int | None] = schemas.HISTORY_DAYS,
    steps: int = schemas.HORIZON_STEPS,
    step_seconds: int = schemas.STEP_SECONDS,
    broadcast_limit: int | None = None,
    partitions: int | None = None,
    include_history: bool = True,
) -> DataFrame:
    """Fitted (``kind`` history) and forecast (``kind`` future) values of every series.

    ``ranges`` are lengths of history in days, None meaning all of it. History is trimmed to
    the longest range and collapsed to one row per series and second before Python sees it, so
    a series is bounded by time, not by the number of raw rows; all ranges are fitted from that
    one pass. Rows without key or time are left out. Without ``include_history`` only the
    future rows leave Python.
    """
    limit = None if None in ranges else max(ranges)
    points = bounded_points(captures, limit, broadcast_limit)
    keys = [StructField(k, captures.schema[k].dataType) for k in schemas.SERIES_KEYS]
    time = points.schema["ds"].dataType
    layout = StructType(
        keys
        + [StructField("ds", time)]
        + StructType.fromDDL("yhat DOUBLE").fields
        + [StructField("min_history_ds", time), StructField("max_history_ds", time)]
        + [StructField("history_days", IntegerType()), StructField("kind", StringType())]
    )
    fit = _fit_sorted(tuple(ranges), steps, step_seconds, include_history, layout.names)
    return _in_series_order(points, partitions).mapInPandas(fit, layout)


def _in_series_order(points: DataFrame, partitions: int | None = None) -> DataFrame:
    """Whole series in partitions, sorted by series and time."""
    # Fitting costs far more than the bytes of a series suggest, so the number of tasks is set
    # here; adaptive execution would merge the small partitions into a few slow tasks.
    spread = points.repartition(partitions or fit_tasks(points.sparkSession), *schemas.SERIES_KEYS)
    return spread.sortWithinPartitions(*schemas.SERIES_KEYS, "ds")


def fit_tasks(spark: SparkSession) -> int:
    """Number of fitting tasks: the configured shuffle width, at least two per core."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(width, 2 * spark.sparkContext.defaultParallelism)


def in_sample(fitted: DataFrame) -> DataFrame:
    """Fitted values at the times of the history."""
    return fitted.filter(F.col("ds") <= F.col("max_history_ds"))


def future(fitted: DataFrame) -> DataFrame:
    """Values after the end of the history."""
    return fitted.filter(F.col("ds") > F.col("max_history_ds"))


def as_predictions(
    forecasts: DataFrame, run_time: Column | None = None, keep_days: bool = False
) -> DataFrame:
    """Forecast rows in the layout of the prediction table, stamped with the run time.

    ``keep_days`` also keeps the nominal length of history, which the difference of the
    history bounds only shows if the series has no gap at its start.
    """
    stamp = F.current_timestamp() if run_time is None else run_time
    renamed = forecasts.withColumnsRenamed({"ds": "Timestamp", "yhat": "prediction_vol"})
    stamped = renamed.withColumn("prediction_ds", stamp.cast(renamed.schema["Timestamp"].dataType))
    columns = [*schemas.SERIES_KEYS, "Timestamp", "prediction_vol", "min_history_ds", "max_history_ds", "prediction_ds"]
    return stamped.select(*columns, *(["history_days"] if keep_days else []))


def forecast(
    captures: DataFrame,
    ranges: Sequence[int | None] = schemas.HISTORY_DAYS,
    run_time: Column | None = None,
    keep_days: bool = False,
    **options,
) -> DataFrame:
    """The prediction table of one run: every series, every range, the next steps.

    A range without limit is fitted in blocks of time, so no task holds a whole series.
    """
    parts = []
    bounded = [r for r in ranges if r is not None]
    if bounded:
        parts.append(future(fit_series(captures, bounded, include_history=False, **options)).drop("kind"))
    if len(bounded) < len(ranges):
        steps = {k: v for k, v in options.items() if k in ("steps", "step_seconds")}
        parts.append(forecast_all(captures, **steps).withColumn("history_days", F.lit(None).cast("int")))
    return as_predictions(reduce(DataFrame.unionByName, parts), run_time, keep_days)


def trend_fit(captures: DataFrame) -> DataFrame:
    """Straight line through each series by built-in regression aggregates.

    Time is counted in days from a fixed origin, so the aggregate needs no second pass.
    """
    day = trend_days("Timestamp")
    y = F.col("Vol").cast("double")
    return captures.groupBy(*schemas.SERIES_KEYS).agg(
        F.regr_slope(y, day).alias("slope"),
        F.regr_intercept(y, day).alias("intercept"),
        F.count("Vol").alias("n"),
        F.avg("Vol").alias("level"),
        F.max("Timestamp").alias("max_history_ds"),
        (F.min("Timestamp") - seconds(schemas.STEP_SECONDS)).alias("min_history_ds"),
    )


def trend_days(ts: Column | str, origin: str = "2020-01-01 00:00:00") -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("SECOND", F.lit(origin).cast("timestamp_ntz"), ts) / F.lit(86_400.0)


def trend_forecast(captures: DataFrame, steps: int = schemas.HORIZON_STEPS) -> DataFrame:
    """Line model at the next steps; a series without slope gets its mean."""
    line = F.col("intercept") + F.col("slope") * trend_days("ds")
    grid = future_grid(trend_fit(captures).filter("n > 0"), steps)
    return grid.select(
        *schemas.SERIES_KEYS, "ds", F.coalesce(line, F.col("level")).alias("yhat"),
        "min_history_ds", "max_history_ds",
    )


def seasonal_naive(
    captures: DataFrame, range_days: Sequence[int] = schemas.HISTORY_DAYS
) -> DataFrame:
    """Each volume repeated after every lag of ``range_days``, from one scan."""
    lag = F.make_dt_interval(days=F.col("history_days"))
    lagged = captures.withColumn("history_days", F.explode(F.array(*map(F.lit, range_days))))
    return lagged.select(
        *schemas.SERIES_KEYS,
        (F.col("Timestamp") + lag).alias("Timestamp"),
        F.col("Vol").cast("double").alias("prediction_vol"),
        (F.col("Timestamp") - lag).alias("min_history_ds"),
        F.col("Timestamp").alias("max_history_ds"),
        "history_days",
    )


__all__ = [
    "apply_per_series", "as_predictions", "bounded_points", "fit_series", "forecast", "future", "in_sample", "seasonal_naive",
    "series_range", "trend_fit", "trend_forecast",
]

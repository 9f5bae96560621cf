"""Streaming forms of the rollups and the periodic jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from curbcount import schemas
from curbcount.functions.event_time import seconds, tick_floor
from curbcount.operators.lookup import lookup_join
from curbcount.plans.rollups import borough_means, borough_partials, for_display, merge_partials, partials
from curbcount.session import remove
from curbcount.sources import files, topics
from curbcount.sources.generations import Generations
from curbcount.sources.snapshots import publish
from curbcount.sources.tables import DAY

BatchFunction = Callable[[DataFrame, int], None]
#: A table, or a function that reads it as it is now.
Dimension = DataFrame | Callable[[SparkSession], DataFrame]
PARTIALS = "Boro STRING, Timestamp TIMESTAMP_NTZ, sum_vol BIGINT, n_vol BIGINT"
FORECAST_PARTIALS = "Boro STRING, Timestamp TIMESTAMP_NTZ, sum_vol DOUBLE, n_vol BIGINT"
#: Files that a day's rows of one micro-batch go to.
DAY_FILES = 4


def start_micro_batches(
    stream: DataFrame,
    handle: BatchFunction,
    checkpoint: str,
    every_seconds: int | None = schemas.CYCLE_SECONDS,
) -> StreamingQuery:
    """Run ``handle(batch, epoch)`` on every micro-batch.

    ``every_seconds`` None takes what is there and stops. The checkpoint makes a restarted
    query continue where it stopped; a batch may then be handled twice under the same epoch,
    so handlers must write by epoch.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if every_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_seconds} seconds").start()


def start_from_latest(
    spark: SparkSession, topic: topics.Topic, handle: BatchFunction, checkpoint: str,
    every_seconds: int | None = schemas.CYCLE_SECONDS, files_per_trigger: int | None = None,
) -> StreamingQuery:
    """:func:`start_micro_batches` over what is added to a log from now on.

    Brokers begin at their newest record. On files a new checkpoint is first led to the end of the log by a run
    whose handler touches no batch: files are listed and noted as read, but not opened. An old
    checkpoint goes on where it stopped. Epochs count from the end of that run.
    """
    if not topic.brokers and not files.listing(spark, f"{checkpoint}/commits"):
        await_or_stop(start_micro_batches(topics.stream(spark, topic), lambda batch, epoch: None, checkpoint, None))
    return start_micro_batches(topics.stream(spark, topic, files_per_trigger), handle, checkpoint, every_seconds)


def await_or_stop(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for the query; stop it on interrupt or when the time is over. True if it ended."""
    ended = False
    try:
        ended = bool(query.awaitTermination(timeout)) if timeout else not query.awaitTermination()
    except KeyboardInterrupt:
        pass
    if query.isActive:
        query.stop()
    return ended


def start_daily_copy(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "Timestamp",
    every_seconds: int | None = schemas.CYCLE_SECONDS,
) -> StreamingQuery:
    """Keep a typed copy of a log, one folder per event date, each record exactly once.

    Batch jobs then read only the dates and columns they need instead of decoding the log.
    """
    # not a file for every task and date: a few for each date
    dated = stream.withColumn(DAY, F.to_date(ts)).repartition(F.col(DAY), F.pmod(F.xxhash64(*stream.columns), F.lit(DAY_FILES)))
    writer = dated.writeStream.format("parquet").partitionBy(DAY).option("checkpointLocation", checkpoint)
    if every_seconds is None:
        return writer.trigger(availableNow=True).start(path)
    return writer.trigger(processingTime=f"{every_seconds} seconds").start(path)


def event_time(ts: str = "Timestamp") -> Column:
    """Event time in the type a watermark needs."""
    return F.col(ts).cast("timestamp")


def borough_windows(
    stream: DataFrame,
    segments: DataFrame,
    delay: str,
    ts: str = "Timestamp",
    value: str = "Vol",
    step_seconds: int = schemas.STEP_SECONDS,
    limit: int | None = None,
) -> DataFrame:
    """Mean volume per borough and step as a stream; a window is emitted once it is closed.

    The dimension joins each micro-batch: broadcast when it is small, by salted key otherwise. The
    state is one sum and count per borough and open window.
    """
    timed = stream.withColumn("event_time", event_time(ts)).withWatermark("event_time", delay)
    return (
        lookup_join(timed, segments.select("SegmentID", "Boro"), ["SegmentID"], limit)
        .groupBy(F.window("event_time", f"{step_seconds} seconds"), "Boro")
        .agg(F.sum(value).alias("sum_vol"), F.count(value).alias("n_vol"))
        .select(
            "Boro",
            F.col("window.start").cast("timestamp_ntz").alias(ts),
            F.try_divide(F.col("sum_vol").cast("double"), F.col("n_vol")).alias("Vol"),
        )
    )


def open_windows(
    records: DataFrame, closed: DataFrame, segments: DataFrame, delay: str, ts: str = "Timestamp",
    value: str = "Vol", step_seconds: int = schemas.STEP_SECONDS,
) -> DataFrame:
    """The windows a finished stream has left open, from the log it read.

    Only records the watermark has not passed are aggregated; windows that were emitted are left out.
    """
    last = records.agg((F.max(ts) - F.expr(f"INTERVAL {delay}") - seconds(step_seconds)).alias("bound"))
    late = records.filter(F.col(ts) >= last.scalar()).withColumn(ts, tick_floor(ts, step_seconds))
    return borough_means(late, segments, value, ts).join(closed, ["Boro", ts], "left_anti")


def run_of(batch: DataFrame) -> str:
    """The id of the stream a batch belongs to: kept in its checkpoint, new with a new checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def _sums(parts: DataFrame) -> DataFrame:
    return parts.groupBy("Boro", "Timestamp").agg(F.sum("sum_vol").alias("sum_vol"), F.sum("n_vol").alias("n_vol"))


def stored_partials(spark: SparkSession, root: str, layout: str = PARTIALS) -> Generations:
    """The borough sums of all batches, merged in levels as they grow in number."""
    return Generations(spark, root, layout, _sums)


def stored_means(spark: SparkSession, root: str) -> DataFrame:
    """Means of all windows, from the sums of all batches."""
    return merge_partials(stored_partials(spark, root).read())


def dimension_now(spark: SparkSession, segments: Dimension) -> DataFrame:
    """The dimension as it is at this batch: a frame stays what it was when the stream began, a function reads anew."""
    return segments(spark) if callable(segments) else segments


def partial_means_writer(
    root: str, segments: Dimension, value: str = "Vol", ts: str = "Timestamp", limit: int | None = None
) -> BatchFunction:
    """Handler that adds mergeable borough sums, for ticks that span several batches.

    Every batch decides for itself how it meets the dimension, which may grow under the stream: broadcast while it
    is small, beyond that by key after the batch has been reduced, with the heavy keys of the batch spread.
    """

    def handle(batch: DataFrame, epoch: int) -> None:
        store, run = stored_partials(batch.sparkSession, root), run_of(batch)
        places = dimension_now(batch.sparkSession, segments)
        # this batch may be a repeated one, so it and what follows stay outside the merged sets
        store.compact(before=(run, epoch))
        sums = borough_partials(batch, places, value, ts, limit)
        store.add(sums.select("Boro", F.col(ts).alias("Timestamp"), F.col("sum_vol").cast("bigint").alias("sum_vol"), "n_vol"), run, epoch)

    return handle


def latest_captures_writer(root: str, segments: Dimension, limit: int | None = None) -> BatchFunction:
    """Handler for new captures: serve the joined batch, append its borough sums."""
    sums = partial_means_writer(f"{root}/partials", segments, limit=limit)

    def handle(batch: DataFrame, epoch: int) -> None:
        kept = batch.persist()
        try:
            places = dimension_now(batch.sparkSession, segments)
            publish(lookup_join(kept, places, ["SegmentID"], limit), f"{root}/batch", epoch, run_of(batch))
            sums(kept, epoch)
        finally:
            kept.unpersist()

    return handle


def latest_forecasts_writer(root: str, segments: Dimension) -> BatchFunction:
    """Handler for new predictions: serve the borough means of the newest run of the forecast.

    A run may come in several batches, and a batch may hold several runs. The newest run time so far is a fact in a
    small manifest, no sums are opened to find it. Only sums of that run are kept: an older one
    never becomes the newest again. They are merged in levels, so a run of very many batches opens few folders.
    """
    parts = f"{root}-sums"

    def of(spark: SparkSession, run_time: str) -> Generations:
        return stored_partials(spark, f"{parts}/{run_time.replace(':', '').replace(' ', 'T')}", FORECAST_PARTIALS)

    def handle(batch: DataFrame, epoch: int) -> None:
        spark, run = batch.sparkSession, run_of(batch)
        state = stored_partials(spark, f"{parts}/newest", FORECAST_PARTIALS)
        known = state.facts().get("newest", "")
        newest = batch.agg(F.max("prediction_ds").cast("string")).first()[0] or ""
        if newest < known or not newest:
            return
        store = of(spark, newest)
        store.compact(before=(run, epoch))
        ahead = batch.filter(F.col("prediction_ds") == F.lit(newest).cast("timestamp_ntz"))
        sums = partials(ahead, "prediction_vol", ["Timestamp"], dimension_now(spark, segments), ["Boro"])
        store.add(sums.select("Boro", "Timestamp", F.col("__sum").alias("sum_vol"), F.col("__count").alias("n_vol")), run, epoch)
        state.note(newest=newest)
        publish(for_display(merge_partials(store.read())), root, epoch, run)
        if known and known != newest:
            remove(spark, of(spark, known).root)

    return handle


def recompute(job: Callable[[int], None]) -> BatchFunction:
    """Handler that runs a whole batch job per trigger, whatever rows started it."""
    return lambda batch, epoch: job(epoch)


def clock(spark: SparkSession) -> DataFrame:
    """A stream that has something new at every trigger."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load()


def start_periodic(
    spark: SparkSession,
    job: Callable[[int], None],
    checkpoint: str,
    every_seconds: int = schemas.CYCLE_SECONDS,
    source: DataFrame | None = None,
) -> StreamingQuery:
    """Run ``job(epoch)`` every ``every_seconds``; a run that takes longer delays the next.

    The checkpoint is where epochs are counted; give a restarted job the same one. By default a clock drives it. With ``source`` it runs only when that stream has new rows.
    """
    return start_micro_batches(
        clock(spark) if source is None else source,
        recompute(job),
        checkpoint,
        every_seconds,
    )

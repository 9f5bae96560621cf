"""Accuracy kept up to date: mergeable error sums, to which a cycle adds only the new matches.

Distinct captures and predictions are kept as tables in levels, sorted by event time. A new batch meets only the
other side's rows of its own time span: new captures meet all predictions of those times, new predictions the captures
seen before. Every distinct pair is therefore found exactly once, when the later of its two rows comes, however late
that is; rows sent again find nothing new.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.plans.accuracy import ACTUAL, AXES, distinct_errors, forecast_axes
from curbcount.sources.generations import Generations
from curbcount.sources.snapshots import publish

SUMS = (
    "range_days DOUBLE, future_forecasting_minutes DOUBLE, abs_sum DOUBLE, abs_n BIGINT, rel_sum DOUBLE, rel_n BIGINT, "
    "pairs BIGINT, zero_vol BIGINT"
)
#: The served table.
ACCURACY = "range_days DOUBLE, future_forecasting_minutes DOUBLE, MAE DOUBLE, MAPE DOUBLE, pairs BIGINT, zero_vol BIGINT"


def error_sums(pairs: DataFrame) -> DataFrame:
    """Sums of the errors of matched pairs by length of history and horizon."""
    return forecast_axes(pairs).groupBy(*AXES).agg(
        F.sum("AE").cast("double").alias("abs_sum"), F.count("AE").alias("abs_n"), F.sum("APE").cast("double").alias("rel_sum"), F.count("APE").alias("rel_n"),
        F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("Vol") == 0).alias("zero_vol"),
    )


def merge_sums(sums: DataFrame) -> DataFrame:
    names = ["abs_sum", "abs_n", "rel_sum", "rel_n", "pairs", "zero_vol"]
    return sums.groupBy(*AXES).agg(*[F.sum(c).alias(c) for c in names])


def accuracy_of(sums: DataFrame) -> DataFrame:
    """The accuracy table from any number of sums."""
    return merge_sums(sums).select(
        *AXES, F.try_divide("abs_sum", "abs_n").alias("MAE"), F.try_divide("rel_sum", "rel_n").alias("MAPE"), "pairs", "zero_vol"
    ).orderBy(*AXES)


def _by_time(rows: DataFrame) -> DataFrame:
    """In ranges of event time, so that a span of times opens few files of a merged set."""
    return rows.repartitionByRange("Timestamp").sortWithinPartitions("Timestamp")


class Scores:
    """The state below ``root``. ``captures`` and ``predictions`` are the layouts of the two sides."""

    def __init__(
        self, spark: SparkSession, root: str, captures: str = schemas.CAPTURE, predictions: str = schemas.PREDICTION,
        range_days: Sequence[int] = schemas.HISTORY_DAYS,
    ):
        self.range_days = list(range_days)
        seen = schemas.resolve(captures)
        guessed = schemas.resolve(predictions)
        self.captures = Generations(spark, f"{root}/captures", seen, _by_time)
        self.predictions = Generations(spark, f"{root}/predictions", type(guessed)([f for f in guessed.fields if f.name != "prediction_ds"]), _by_time)
        self.sums = Generations(spark, f"{root}/sums", SUMS, merge_sums)

    def add(self, captures: DataFrame, predictions: DataFrame, run: str = "", epoch: int = 0) -> None:
        """Take in a batch of both logs. A batch that is already in the sums changes nothing; one that stopped
        on its way is taken in again from the start, without its own rows of the first time."""
        if self.sums.has(run, epoch):
            return
        here = (run, epoch)
        for store in (self.captures, self.predictions, self.sums):
            store.compact(before=here)
        self.captures.add(self._new_captures(captures, here), *here)
        self.predictions.add(self._new_predictions(predictions, here), *here)
        actual, guessed = self._actual(self.captures.batch(*here)), self.predictions.batch(*here)
        # what is stored is distinct, batches together as well
        before = _within(self.predictions.read(but=here), actual)
        now = distinct_errors(actual, before.unionByName(guessed))
        late = distinct_errors(self._actual(_within(self.captures.read(but=here), guessed)), guessed)
        # last: it marks the batch as taken in
        self.sums.add(merge_sums(error_sums(now).unionByName(error_sums(late))), *here)

    def _actual(self, captures: DataFrame) -> DataFrame:
        """Distinct rows of the columns of a match; a layout with further columns may repeat them."""
        own = captures.select(*ACTUAL)
        return own if len(self.captures.schema) == len(ACTUAL) else own.distinct()

    def _new_captures(self, captures: DataFrame, here: tuple[str, int]) -> DataFrame:
        names = self.captures.schema.names
        given = captures.dropna(subset=schemas.CAPTURE_KEYS).select(*[F.col(f.name).cast(f.dataType) for f in self.captures.schema.fields])
        return _unseen(given, _within(self.captures.read(but=here), given), names)

    def _new_predictions(self, predictions: DataFrame, here: tuple[str, int]) -> DataFrame:
        wanted = forecast_axes(predictions).filter(F.col("range_days").isin(*self.range_days)).drop(*AXES)
        given = wanted.dropna(subset=schemas.CAPTURE_KEYS).select(*[F.col(f.name).cast(f.dataType) for f in self.predictions.schema.fields])
        return _unseen(given, _within(self.predictions.read(but=here), given), self.predictions.schema.names)

    def table(self) -> DataFrame:
        return accuracy_of(self.sums.read())


def _within(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Rows of the times that the others span."""
    first = others.agg(F.min("Timestamp").alias("first")).scalar()
    last = others.agg(F.max("Timestamp").alias("last")).scalar()
    return rows.filter(F.col("Timestamp").between(first, last))


def _unseen(rows: DataFrame, seen: DataFrame, names: list[str]) -> DataFrame:
    """Distinct rows that are not among those seen, nulls being equal. One grouping does both, so each side is shuffled once."""
    both = rows.select(*names, F.lit(False).alias("__seen")).union(seen.select(*names, F.lit(True).alias("__seen")))
    return both.groupBy(*names).agg(F.max("__seen").alias("__seen")).filter(~F.col("__seen")).select(*names)


def accuracy_writer(root: str, **layouts):
    """Handler of a stream of both logs (:func:`both_logs`): take the batch in, serve the accuracy table."""

    def handle(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        scores = Scores(spark, f"{root}/state", **layouts)
        kept = batch.persist()
        try:
            captures = kept.filter("kind = 'capture'").select(*scores.captures.schema.names)
            predictions = kept.filter("kind = 'prediction'").select(*scores.predictions.schema.names)
            scores.add(captures, predictions, run, epoch)
        finally:
            kept.unpersist()
        publish(scores.table(), f"{root}/served", epoch, run)

    return handle


def both_logs(captures: DataFrame, predictions: DataFrame) -> DataFrame:
    """Two streams as one, told apart by ``kind``."""
    ends = captures.withColumn("kind", F.lit("capture")), predictions.withColumn("kind", F.lit("prediction"))
    return ends[0].unionByName(ends[1], allowMissingColumns=True)

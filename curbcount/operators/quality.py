"""Counts that tell whether a column can serve as a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbcount.sources.generations import Generations


def distinct_counts(
    df: DataFrame, columns: Mapping[str, Sequence[str]], approximate: bool = False
) -> DataFrame:
    """One row with the number of distinct values of each named column set.

    Column sets count as whole rows, so a null is a value like any other. All sets share one
    scan; ``approximate`` uses sketches and needs no shuffle of the values.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*(count(F.struct(*cols)).alias(name) for name, cols in columns.items()))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


#: Bits of a sketch's register number; the relative error of a count is about 1.04 / sqrt(2 ^ bits) (one standard error).
SKETCH_BITS = 12
SKETCHES = "day DATE, name STRING, sketch BINARY, rows BIGINT"


def _united(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("day", "name").agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("rows").alias("rows"))


class KeySketches:
    """Distinct keys by day as mergeable sketches, beside the exact form (:func:`distinct_counts`).

    A batch is sketched once and never read again; a span of days is the union of its sketches, of which there is one a day and
    set of keys. Rows without a time belong to a day that is null. A null is a
    value like any other, as in the exact form.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Mapping[str, Sequence[str]], bits: int = SKETCH_BITS):
        self.keys, self.bits = keys, bits
        self.store = Generations(spark, root, SKETCHES, _united)

    def add(self, rows: DataFrame, ts: str = "Timestamp", run: str = "", epoch: int | None = None) -> None:
        """One batch; a batch that comes again replaces itself."""
        self.store.compact(before=(run, epoch) if epoch is not None else None)
        day = F.to_date(ts).alias("day")
        sketches = rows.groupBy(day).agg(*[
            F.hll_sketch_agg(F.to_json(F.struct(*columns)), F.lit(self.bits)).alias(name) for name, columns in self.keys.items()
        ], F.count(F.lit(1)).alias("__rows"))
        each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("sketch"), F.col("__rows").alias("rows")) for n in self.keys]))
        self.store.add(sketches.select("day", each.alias("s")).select("day", "s.*"), run, epoch)

    def counts(self, first: Column | None = None, last: Column | None = None) -> DataFrame:
        """(name, distinct, rows) over all days, or those from ``first`` to ``last``."""
        held = self.store.read()
        for bound, test in ((first, F.col("day").__ge__), (last, F.col("day").__le__)):
            held = held if bound is None else held.filter(test(bound))
        return held.groupBy("name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"), F.sum("rows").alias("rows"))


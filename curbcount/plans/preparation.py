"""Raw counts to a segment dimension, a capture history and live captures per borough."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.functions.event_time import from_parts
from curbcount.functions.geo import latitude, longitude, point_x, point_y
from curbcount.session import materialise, scratch
from curbcount.sources.tables import write_by_borough, write_csv


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Tables of one layout on top of each other, by column name."""
    return reduce(DataFrame.unionByName, tables)


def exclude_segments(
    df: DataFrame, segments: Sequence[int] = schemas.EXCLUDED_SEGMENTS, key: str = "SegmentID"
) -> DataFrame:
    """Drop the rows of known bad segments; rows with a null key stay."""
    return df.filter(~F.coalesce(F.col(key).isin(*segments), F.lit(False))) if segments else df


def segment_dimension(raw: DataFrame) -> DataFrame:
    """Distinct segments with coordinates in degrees, ordered by key.

    Duplicates are removed before the projection, so the trigonometry runs once per segment.
    """
    places = raw.select("Boro", "SegmentID", "WktGeom", "Street", "fromSt", "toSt").distinct()
    x, y = point_x("WktGeom"), point_y("WktGeom")
    return (
        places.withColumns({"Long": longitude(x, y), "Lat": latitude(x, y)})
        .select("SegmentID", "Boro", F.col("Street").alias("street"), "fromSt", "toSt", "Lat", "Long")
        .orderBy("SegmentID")
    )


def raw_captures(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Captures with their borough and a timestamp built from the date parts."""
    stamp = from_parts("Yr", "M", "D", "HH", "MM", strict=strict)
    return raw.select("SegmentID", "Direction", "Vol", stamp.alias("Timestamp"), "Boro")


PARTS = ("history", "live", "untimed")


def with_part(
    captures: DataFrame, cutoff: str = schemas.HISTORY_CUTOFF, ts: str = "Timestamp"
) -> DataFrame:
    """Adds ``part``: history up to and including ``cutoff``, live after it, untimed without a time."""
    bound = F.lit(cutoff).cast("timestamp_ntz")
    label = F.when(F.col(ts) <= bound, "history").when(F.col(ts) > bound, "live").otherwise("untimed")
    return captures.withColumn("part", label)


def split_history(
    captures: DataFrame, cutoff: str = schemas.HISTORY_CUTOFF, ts: str = "Timestamp"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three parts of :func:`with_part` as frames; together they hold every row once."""
    parts = with_part(captures, cutoff, ts)
    return tuple(parts.filter(F.col("part") == name).drop("part") for name in PARTS)


def boroughs(df: DataFrame) -> DataFrame:
    return df.select("Boro").distinct()


def prepare(raw: DataFrame, root: str, cutoff: str = schemas.HISTORY_CUTOFF) -> None:
    """Write the dimension (with header), the history and the live captures (without).

    Rows whose date parts make no time go to ``untimed``, so the three capture folders hold every usable
    row once. The raw rows are parsed once, into a table that the outputs share.
    """
    spark = raw.sparkSession
    with scratch(spark):
        _prepare(materialise(exclude_segments(raw), "usable"), root, cutoff)


def _prepare(usable: DataFrame, root: str, cutoff: str) -> None:
    order = ["SegmentID", "Boro", F.col("street").alias("Street"), "fromSt", "toSt", "Long", "Lat"]
    write_csv(segment_dimension(usable).select(*order), f"{root}/segment", header=True)
    history, live, untimed = split_history(raw_captures(usable, strict=False), cutoff)
    write_csv(history.drop("Boro"), f"{root}/capture")
    write_csv(untimed.drop("Timestamp"), f"{root}/untimed")
    write_by_borough(live, f"{root}/live")

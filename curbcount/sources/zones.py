"""Zone maps of logs: the span of event time of every file, kept beside the log.

A log is text and cannot be pruned by its own statistics. So a small table in a hidden folder of the log has one
row per file and time column, first and last time. A bounded read decodes only the files that may reach its bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbcount import schemas
from curbcount.sources.files import plain, qualified
from curbcount.sources.generations import Generations

#: Hidden from Spark's readers by its first character.
FOLDER = "_zones"
LAYOUT = "file STRING, time STRING, first TIMESTAMP_NTZ, last TIMESTAMP_NTZ"


def _merged(zones: DataFrame) -> DataFrame:
    return zones.groupBy("file", "time").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def store(spark: SparkSession, location: str) -> Generations:
    return Generations(spark, f"{location.rstrip('/')}/{FOLDER}", LAYOUT, _merged)


def _name(path: Column, base: str) -> Column:
    """A file's path below the log, so that a log may be moved as a whole."""
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return F.substring(F.regexp_replace(decoded, "^file:/+", "/"), len(base) + 2, 1 << 20)


def _files(spark: SparkSession, location: str, base: str) -> dict[str, str]:
    """Name below the log and path of every file of it."""
    return {p[len(base) + 1 :]: p for p in map(plain, spark.read.text(location).inputFiles())}


def index(spark: SparkSession, location: str, layout: StructType) -> int:
    """Note the files that have no note yet, each read once; returns their number.

    Several writers may note one file; the notes are the same. Files without lines get none.
    """
    times = schemas.timestamp_columns(layout)
    if not times:
        return 0
    zones = store(spark, location)
    base = qualified(spark, location)
    noted = {r["file"] for r in zones.read().select("file").distinct().collect()} if zones.paths() else set()
    new = {name: path for name, path in _files(spark, location, base).items() if name not in noted}
    if not new:
        return 0
    # of a record only the times are parsed, and a file is named once, not for every record
    record = F.from_json("value", StructType([layout[t] for t in times]))
    read = spark.read.text(list(new.values())).select(F.col("_metadata.file_path").alias("path"), record.alias("r"))
    spans = read.groupBy("path").agg(*[f(F.col("r")[t]).alias(f"{end}_{t}") for t in times for end, f in (("first", F.min), ("last", F.max))])
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("time"), F.col(f"first_{t}").alias("first"), F.col(f"last_{t}").alias("last")) for t in times]))
    zones.add(spans.select(_name(F.col("path"), base).alias("file"), rows.alias("z")).select("file", "z.*").coalesce(1))
    if len(zones.paths()) >= zones.fan:
        zones.compact()
    return len(new)


def read_since(spark: SparkSession, location: str, layout: StructType, ts: str, bound) -> DataFrame:
    """The lines of the files that may hold a time at or after ``bound``. Files whose note has no time hold none."""
    edge = bound if isinstance(bound, Column) else F.lit(bound)
    limit = spark.range(1).select(edge.cast(layout[ts].dataType).alias("t")).first()["t"]
    if limit is None:
        return spark.createDataFrame([], "value STRING")
    noted = _merged(store(spark, location).read().where(F.col("time") == ts))
    late = {r["file"]: r["last"] is not None and r["last"] >= limit for r in noted.select("file", "last").collect()}
    base = qualified(spark, location)
    paths = [path for name, path in _files(spark, location, base).items() if late.get(name, True)]
    return spark.read.text(paths) if paths else spark.createDataFrame([], "value STRING")


def last_noted(spark: SparkSession, location: str, time: str):
    """The last time noted of a column: the log's own is not before it. None without notes."""
    zones = store(spark, location)
    return zones.read().where(F.col("time") == time).agg(F.max("last")).first()[0] if zones.paths() else None

"""CSV and parquet readers and writers for the batch tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbcount import schemas
from curbcount.functions.text import file_label
from curbcount.operators.lookup import table_bytes

CORRUPT = "_corrupt_record"
DAY = "event_date"
BATCH = "batch"
#: In-memory size of a bucket; a task that frees two of them of repetition and joins them takes about four times as much.
BUCKET_BYTES = 64 << 20


def read_csv(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: StructType | list[str] | str,
    header: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Read one path, many paths or folders as one table with a declared schema.

    Folders are filtered to ``*.csv``. Spark splits the files over the executors, so many
    files need no loop. With a header the column names are checked against the schema, since
    CSV binds by position. ``keep_corrupt`` adds a column with the text of malformed lines.
    """
    if not isinstance(spark, SparkSession):
        raise ValueError("a Spark session is needed to read CSV")
    wanted = [paths] if isinstance(paths, str) else list(paths or [])
    if not wanted or not all(wanted):
        raise ValueError("no path to a CSV file given")
    layout = schemas.resolve(schema)
    reader = spark.read.option("header", header).option("enforceSchema", not header)
    if keep_corrupt:
        layout = StructType(layout.fields).add(CORRUPT, "string")
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if any(not p.endswith(".csv") for p in wanted):
        reader = reader.option("pathGlobFilter", "*.csv")
    try:
        return reader.schema(layout).csv(wanted)
    except AnalysisException as error:
        raise ValueError(f"cannot read CSV at {wanted}: {error}") from error


def read_captures(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    return read_csv(spark, paths, schemas.CAPTURE)


def read_segments(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """The dimension file has a header and longitude first; rows without a key are dropped."""
    table = read_csv(spark, paths, schemas.SEGMENT_FILE, header=True)
    names = schemas.resolve(schemas.SEGMENT).names
    return table.withColumnRenamed("Street", "street").select(*names).filter("SegmentID IS NOT NULL")


def read_raw(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    return read_csv(spark, paths, schemas.RAW)


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def write_by_borough(df: DataFrame, path: str, header: bool = False, boro: str = "Boro") -> None:
    """One folder per borough in one pass.

    Blanks in borough names become underscores, so the folder is ``Boro=Staten_Island``. The
    rebalance hint gathers each borough's rows and lets adaptive execution split the large
    ones, so a borough with most of the rows is still written by many tasks.
    """
    labelled = df.withColumn(boro, file_label(boro))
    (
        labelled.hint("rebalance", boro)
        .write.mode("overwrite")
        .option("header", header)
        .partitionBy(boro)
        .csv(path)
    )


def write_by_day(df: DataFrame, path: str, ts: str = "Timestamp", batch: str = "0") -> None:
    """Typed parquet copy, one folder per event date, so time bounds prune folders.

    Rows are added as the batch of this name; a batch that is written again replaces itself.
    """
    dated = df.withColumn(DAY, F.to_date(ts))
    dated.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{path}/{BATCH}={batch}")


def bucket_count(*sides: DataFrame, least: int = 1) -> int:
    """Number of buckets for copies of these tables that are to meet: of the largest, ``BUCKET_BYTES`` in a bucket."""
    return max(least, -(-max(map(table_bytes, sides)) // BUCKET_BYTES))


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """A copy in buckets by the keys of a capture, sorted, as table ``name`` over files at ``path``; returns the table.

    Two copies with as many buckets meet by these keys, and are freed of repeated rows, without a shuffle, as often as they are
    read. Event time is one of the keys, so a hot series is spread over all buckets. Choose their number from the
    size (:func:`bucket_count`); every bucket is one file, and is written, freed of repetition and joined by one task.
    """
    keys = schemas.CAPTURE_KEYS
    dealt = df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
    dealt.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def read_by_day(
    spark: SparkSession, path: str, layout: StructType | list[str] | str, since: Column | None = None, ts: str = "Timestamp"
) -> DataFrame:
    """Read such a copy, or that of a stream, back; ``since`` is an inclusive lower bound on the event time."""
    declared = StructType(schemas.resolve(layout).fields).add(DAY, "date").add(BATCH, "string")
    table = spark.read.schema(declared).parquet(path)
    if since is not None:
        table = table.filter((F.col(DAY) >= F.to_date(since)) & (F.col(ts) >= since))
    return table.drop(DAY, BATCH)

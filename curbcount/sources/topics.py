"""Append-only logs of JSON records ("topics"), on Kafka or on a folder of text files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from curbcount import schemas
from curbcount.functions.event_time import SECOND_FORMAT, format_event_time, parse_event_time
from curbcount.sources import zones
from curbcount.sources.tables import read_csv


@dataclass(frozen=True)
class Topic:
    """A named log of one table.

    ``brokers`` selects Kafka (the connector must be on the class path); otherwise the log is
    the folder ``location`` of text files with one JSON object per line.
    """

    name: str
    schema: StructType | list[str] | str
    location: str | None = None
    brokers: str | None = None

    def layout(self) -> StructType:
        return schemas.resolve(self.schema)


def encode(df: DataFrame, time_format: str = SECOND_FORMAT) -> DataFrame:
    """Rows to one JSON text column ``value``.

    Every timestamp column, found by type, becomes text; null fields are left out.
    """
    return df.select(encoded(None, df.schema, time_format).alias("value"))


def encoded(struct: str | None, layout: StructType, time_format: str = SECOND_FORMAT) -> Column:
    """The JSON text of a record: of the columns of ``layout``, or of the struct column that holds them."""
    times = set(schemas.timestamp_columns(layout))
    fields = []
    for name in layout.names:
        value = F.col(struct)[name] if struct else F.col(name)
        fields.append((format_event_time(value, time_format) if name in times else value).alias(name))
    return F.to_json(F.struct(*fields))


def decode(df: DataFrame, schema: StructType | list[str] | str) -> DataFrame:
    """JSON ``value`` (bytes or text) to flat typed columns.

    Missing or ill-typed fields are null and text that is not JSON gives an all-null row.
    """
    record = F.from_json(F.col("value").cast("string"), schemas.resolve(schema))
    return df.select(record.alias("record")).select("record.*")


def decode_checked(df: DataFrame, schema: StructType | list[str] | str, keys: Sequence[str] = ()) -> DataFrame:
    """:func:`decode` with two more columns: ``reason``, why a record does not count, and its text in ``rejected``.

    The reason is the first of: ``not JSON`` (no JSON object), ``type <field>`` (there is a value that does not fit the
    declared type), ``missing <key>``. It is null for good records, and so is their text. Blank values are missing ones.
    """
    layout = schemas.resolve(schema)
    text = F.col("value").cast("string")
    read = df.select(text.alias("text"), F.from_json(text, layout).alias("r"), F.from_json(text, "map<string,string>").alias("given"))
    reason = F.when(F.col("given").isNull(), "not JSON")
    for name in layout.names:
        there = F.trim(F.col("given")[name])
        reason = reason.when((F.coalesce(there, F.lit("")) != "") & F.col("r")[name].isNull(), f"type {name}")
    for key in keys:
        reason = reason.when(F.col("r")[key].isNull(), f"missing {key}")
    return read.withColumn("reason", reason).select("r.*", "reason", F.when(F.col("reason").isNotNull(), F.col("text")).alias("rejected"))


def split_valid(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose keys are all present, and the rest for quarantine."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.filter(~missing), df.filter(missing)


def coerce(
    df: DataFrame, schema: StructType | list[str] | str, time_format: str = SECOND_FORMAT
) -> DataFrame:
    """Text columns to the declared types, with a flag column ``rejected``.

    Empty event time is allowed and gives null. Any other value that does not fit its type
    marks the row; :func:`require_valid` turns a marked row into an error.
    """
    typed, bad = [], F.lit(False)
    for field in schemas.resolve(schema).fields:
        text = F.col(field.name)
        kind = field.dataType.typeName()
        if kind.startswith("timestamp"):
            value = parse_event_time(text, time_format).cast(field.dataType)
            bad = bad | (value.isNull() & (F.length(F.trim(F.coalesce(text, F.lit("")))) > 0))
        elif isinstance(field.dataType, StringType):
            value = text
        else:
            value = F.trim(text).try_cast(field.dataType)
            bad = bad | value.isNull()
        typed.append(value.alias(field.name))
    return df.select(*typed, bad.alias("rejected"))


def require_valid(coerced: DataFrame) -> DataFrame:
    """Strict form of :func:`coerce`: the first rejected row fails the job."""
    checked = F.assert_true(~F.col("rejected"), F.lit("record does not fit the schema"))
    return coerced.filter(checked.isNull()).drop("rejected")


def since(df: DataFrame, bound, ts: str = "Timestamp") -> DataFrame:
    """Rows at or after ``bound``; no bound keeps everything."""
    if bound is None:
        return df
    if ts not in df.columns:
        raise ValueError(f"there is no column {ts} in {df.columns}")
    return df.filter(F.col(ts) >= (bound if isinstance(bound, Column) else F.lit(bound)))


def append(df: DataFrame, topic: Topic, time_format: str = SECOND_FORMAT) -> None:
    """Encode ``df`` and add it to the log. Of files, the span of event time is noted beside the log."""
    records = encode(df, time_format)
    if topic.brokers:
        (
            records.write.format("kafka")
            .option("kafka.bootstrap.servers", topic.brokers)
            .option("topic", topic.name)
            .save()
        )
    else:
        records.write.mode("append").text(topic.location)
        zones.index(df.sparkSession, topic.location, topic.layout())


def append_csv(spark: SparkSession, paths, topic: Topic, header: bool = False) -> None:
    """CSV files of the topic's layout into the log."""
    append(read_csv(spark, paths, topic.layout(), header=header), topic)


def _broker(reader, topic: Topic, offsets: str) -> DataFrame:
    """The log on Kafka, read from the given end. Option names are the connector's: fixed values."""
    options = {"kafka.bootstrap.servers": topic.brokers, "subscribe": topic.name, "startingOffsets": offsets}
    return reader.format("kafka").options(**options).load()


def checked_snapshot(spark: SparkSession, topic: Topic, keys: Sequence[str], bound=None, ts: str = "Timestamp") -> DataFrame:
    """:func:`snapshot` with the columns of :func:`decode_checked`. Rejected records without a time meet every bound."""
    read = decode_checked(_raw(spark, topic, bound, ts), topic.layout(), keys)
    if bound is None:
        return read
    late = F.col(ts) >= (bound if isinstance(bound, Column) else F.lit(bound))
    return read.filter(late | (F.col(ts).isNull() & F.col("reason").isNotNull()))


def snapshot(spark: SparkSession, topic: Topic, bound=None, ts: str = "Timestamp") -> DataFrame:
    """All records so far, from the earliest one, as a typed table.

    With a bound only those files are opened whose span of event time, as noted when they were written, may
    reach it; files without a note are always read.
    """
    return since(decode(_raw(spark, topic, bound, ts), topic.layout()), bound, ts)


def newest_run(spark: SparkSession, topic: Topic, run: str = "prediction_ds") -> DataFrame:
    """The records that may belong to the newest run: files whose runs are all older than a noted one are not opened."""
    bound = None if topic.brokers else zones.last_noted(spark, topic.location, run)
    return snapshot(spark, topic, bound, run)


def _raw(spark: SparkSession, topic: Topic, bound, ts: str) -> DataFrame:
    if topic.brokers:
        return _broker(spark.read, topic, "earliest")
    if bound is None or ts not in schemas.timestamp_columns(topic.layout()):
        return spark.read.text(topic.location)
    return zones.read_since(spark, topic.location, topic.layout(), ts, bound)


def stream(spark: SparkSession, topic: Topic, files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded form: new records only on Kafka, the whole folder in order on files."""
    if topic.brokers:
        raw = _broker(spark.readStream, topic, "latest")
    else:
        reader = spark.readStream.schema("value string")
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        raw = reader.text(topic.location)
    return decode(raw, topic.layout())

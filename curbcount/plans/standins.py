"""Traffic tables derived from the general test tables (events, customer, nation, region)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.functions.event_time import tick_floor
from curbcount.operators.lookup import lookup_join
from curbcount.plans.forecast import seasonal_naive

# Event users and customers have 64-bit keys.
CAPTURE = schemas.CAPTURE.replace("SegmentID INT", "SegmentID BIGINT")
PREDICTION = schemas.PREDICTION.replace("SegmentID INT", "SegmentID BIGINT")
SEGMENT = "SegmentID BIGINT, Boro STRING, street STRING, Lat DOUBLE, Long DOUBLE"
FIRST_RUN = "2024-02-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def capture(rows: DataFrame) -> DataFrame:
    """Events as captures; rows can be filtered before."""
    return rows.select(
        F.col("user_id").alias("SegmentID"),
        F.col("event_type").alias("Direction"),
        F.floor("value").cast("int").alias("Vol"),
        tick_floor("ts").alias("Timestamp"),
    )


def captures(spark: SparkSession, folder: str) -> DataFrame:
    return capture(events(spark, folder))


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with nation and region."""
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def segments(spark: SparkSession, folder: str) -> DataFrame:
    return places(spark, folder).select(
        F.col("c_custkey").alias("SegmentID"),
        F.col("r_name").alias("Boro"),
        F.col("n_name").alias("street"),
        F.col("n_nationkey").cast("double").alias("Lat"),
        F.col("r_regionkey").cast("double").alias("Long"),
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Seasonal-naive predictions, one run per lag."""
    run = F.lit(FIRST_RUN).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("history_days"))
    naive = seasonal_naive(captures(spark, folder))
    return naive.withColumn("prediction_ds", run).drop("history_days")


def point_text(key: Column, nation: Column) -> Column:
    """A made-up point inside the state-plane zone for every customer key."""
    x = F.lit(950_000) + F.pmod(key, F.lit(1000)) * F.lit(100)
    y = F.lit(150_000) + nation * F.lit(4_000)
    return F.concat(F.lit("POINT ("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """Events joined with their place, in the layout of the raw counts."""
    ts = F.col("ts")
    found = places(spark, folder).select("c_custkey", "c_mktsegment", "n_nationkey", "n_name", "r_name")
    located = lookup_join(
        events(spark, folder).withColumnRenamed("user_id", "c_custkey"), found, ["c_custkey"]
    )
    return located.select(
        F.col("event_id").alias("RequestID"),
        F.col("r_name").alias("Boro"),
        F.year(ts).alias("Yr"), F.month(ts).alias("M"), F.day(ts).alias("D"),
        F.hour(ts).alias("HH"), F.minute(ts).alias("MM"),
        F.floor("value").cast("int").alias("Vol"),
        F.col("c_custkey").alias("SegmentID"),
        point_text(F.col("c_custkey"), F.col("n_nationkey")).alias("WktGeom"),
        F.col("n_name").alias("Street"),
        F.col("c_mktsegment").alias("fromSt"),
        F.col("r_name").alias("toSt"),
        F.col("event_type").alias("Direction"),
    )

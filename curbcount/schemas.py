"""Table layouts as DDL text. Event time has no zone, so it is TIMESTAMP_NTZ in batch."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Names and types of the tables, as the data model defines them.
CAPTURE = "SegmentID INT, Direction STRING, Vol INT, Timestamp TIMESTAMP_NTZ"
SEGMENT = "SegmentID INT, Boro STRING, street STRING, fromSt STRING, toSt STRING, Lat DOUBLE, Long DOUBLE"
# The served dimension file has longitude first; CSV schemas bind by position.
SEGMENT_FILE = "SegmentID INT, Boro STRING, Street STRING, fromSt STRING, toSt STRING, Long DOUBLE, Lat DOUBLE"
RAW = (
    "RequestID INT, Boro STRING, Yr INT, M INT, D INT, HH INT, MM INT, Vol INT, SegmentID INT, "
    "WktGeom STRING, Street STRING, fromSt STRING, toSt STRING, Direction STRING"
)
FORECAST = (
    "SegmentID INT, Direction STRING, ds TIMESTAMP_NTZ, yhat DOUBLE, "
    "min_history_ds TIMESTAMP_NTZ, max_history_ds TIMESTAMP_NTZ"
)
PREDICTION = (
    "SegmentID INT, Direction STRING, Timestamp TIMESTAMP_NTZ, prediction_vol DOUBLE, "
    "min_history_ds TIMESTAMP_NTZ, max_history_ds TIMESTAMP_NTZ, prediction_ds TIMESTAMP_NTZ"
)
SERVED_LOCATIONS = "Timestamp TIMESTAMP_NTZ, Long DOUBLE, Lat DOUBLE, total_vol BIGINT"
SERVED_BOROUGHS = "Boro STRING, Timestamp TIMESTAMP_NTZ, Vol DOUBLE"

SERIES_KEYS = ["SegmentID", "Direction"]
CAPTURE_KEYS = ["SegmentID", "Timestamp", "Direction"]

# Thresholds of the pipeline.
STEP_SECONDS = 15 * 60
RECENT_HOURS = 3
CYCLE_SECONDS = 120
HORIZON_STEPS = 4
HISTORY_DAYS = (7, 3, 1)
HEAT_DIVISOR = 100
EXCLUDED_SEGMENTS = (103857,)
HISTORY_CUTOFF = "2017-06-20 00:00:00"


def resolve(schema: StructType | list[str] | str) -> StructType:
    """A schema given as StructType, DDL text or a list of ``"name TYPE"`` strings."""
    if isinstance(schema, StructType):
        return schema
    return StructType.fromDDL(schema if isinstance(schema, str) else ", ".join(schema))


def timestamp_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if f.dataType.typeName().startswith("timestamp")]

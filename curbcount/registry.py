"""Registered queries and the SQL that checks them, over the general test tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.functions import event_time as et
from curbcount.functions import geo
from curbcount.functions.text import file_label
from curbcount.operators import quality, series
from curbcount.operators.lookup import lookup_join
from curbcount.plans import accuracy, cycles, forecast, long_fit, preparation, rollups, scores
from curbcount.plans import standins as st
from curbcount.session import new_path
from curbcount.sources import snapshots, tables, topics
from curbcount.sources.topics import Topic
from curbcount.streaming import queries as sq
from curbcount.streaming import replay

STEP = schemas.STEP_SECONDS
SINCE = "2024-01-20 00:00:00"
SPLIT_AT = "2024-01-15 00:00:00"
BAD_SEGMENTS = (7, 46)
SLICE_DAYS = 3

_CAPTURE = """capture AS (
  SELECT user_id AS SegmentID, event_type AS Direction, CAST(floor(value) AS INTEGER) AS Vol,
         time_bucket(INTERVAL '15 minutes', ts) AS Timestamp
  FROM events)"""
_SEGMENT = """segment AS (
  SELECT c_custkey AS SegmentID, r_name AS Boro, n_name AS street,
         CAST(n_nationkey AS DOUBLE) AS Lat, CAST(r_regionkey AS DOUBLE) AS Long
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_PREDICTION = f"""prediction AS (
  SELECT SegmentID, Direction, Timestamp + to_days(h) AS Timestamp, CAST(Vol AS DOUBLE) AS prediction_vol,
         Timestamp - to_days(h) AS min_history_ds, Timestamp AS max_history_ds,
         TIMESTAMP '{st.FIRST_RUN}' + to_hours(h) AS prediction_ds
  FROM capture, (VALUES (1), (3), (7)) AS lags(h))"""
_POINT = (
    "'POINT (' || CAST(950000 + c_custkey % 1000 * 100 AS VARCHAR) || ' ' || "
    "CAST(150000 + n_nationkey * 4000 AS VARCHAR) || ')'"
)
_RAW = f"""raw AS (
  SELECT event_id AS RequestID, r_name AS Boro, year(ts) AS Yr, month(ts) AS M, day(ts) AS D,
         hour(ts) AS HH, minute(ts) AS MM, CAST(floor(value) AS INTEGER) AS Vol, user_id AS SegmentID,
         {_POINT} AS WktGeom, n_name AS Street, c_mktsegment AS fromSt, r_name AS toSt,
         event_type AS Direction
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""


def _with(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


_QUERIES: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(function):
        _QUERIES[function.__name__] = function
        if sql:
            _SQL[function.__name__] = sql
        return function

    return add


def _r(c: Column | str, places: int = 6) -> Column:
    return F.round(c, places)


# ---------------------------------------------------------------- rollups

_RECENT_SQL = _with(_CAPTURE, _SEGMENT) + """
SELECT Boro, Timestamp, round(avg(Vol), 6) AS Vol FROM capture JOIN segment USING (SegmentID)
WHERE Timestamp > (SELECT max(Timestamp) FROM capture) - INTERVAL '3 hours'
GROUP BY Boro, Timestamp"""


@_query(_with(_CAPTURE) + "SELECT SegmentID, Direction, Vol, Timestamp FROM capture")
def capture_ticks(spark: SparkSession, folder: str) -> DataFrame:
    return st.captures(spark, folder)


@_query(_RECENT_SQL)
def boro_recent_mean(spark, folder):
    recent = st.capture(rollups.recent(st.events(spark, folder), ts="ts", raw_step=STEP))
    means = rollups.borough_means(recent, st.segments(spark, folder))
    return means.withColumn("Vol", _r("Vol"))


@_query(_with(_CAPTURE, _SEGMENT) + """
SELECT Timestamp, Long, Lat, CAST(sum(Vol) AS BIGINT) AS total_vol, round(sum(Vol) / 100.0, 6) AS weight
FROM capture JOIN segment USING (SegmentID)
WHERE Timestamp = (SELECT max(Timestamp) FROM capture) GROUP BY Timestamp, Long, Lat""")
def geo_current_sum(spark, folder):
    newest = st.capture(rollups.current(st.events(spark, folder), ts="ts", raw_step=STEP))
    totals = rollups.location_totals(newest, st.segments(spark, folder))
    return totals.withColumn("weight", _r("weight"))


@_query(_with(_CAPTURE, _SEGMENT) + """
SELECT Timestamp, Long, Lat, CAST(sum(Vol) AS BIGINT) AS total_vol, round(sum(Vol) / 100.0, 6) AS weight
FROM capture JOIN segment USING (SegmentID) GROUP BY Timestamp, Long, Lat""")
def geo_history_sum(spark, folder):
    """The location totals of every tick, for a look back."""
    totals = rollups.location_totals(st.captures(spark, folder), st.segments(spark, folder))
    return totals.withColumn("weight", _r("weight"))


_LATEST = """latest AS (
  SELECT SegmentID, Timestamp, Direction, prediction_vol FROM prediction
  WHERE Timestamp > (SELECT max(Timestamp) FROM capture)
    AND prediction_ds = (SELECT max(prediction_ds) FROM prediction))"""


def _latest(spark, folder) -> DataFrame:
    now = st.events(spark, folder).agg(et.tick_floor(F.max("ts")).alias("now"))
    return rollups.latest_run(st.predictions(spark, folder), now.scalar())


@_query(_with(_CAPTURE, _PREDICTION, _LATEST) + "SELECT * FROM latest")
def latest_run_future(spark, folder):
    return _latest(spark, folder)


_BORO_FORECAST = """boro_forecast AS (
  SELECT Boro, Timestamp, round(avg(prediction_vol), 6) AS Vol
  FROM latest JOIN segment USING (SegmentID) GROUP BY Boro, Timestamp)"""


@_query(_with(_CAPTURE, _SEGMENT, _PREDICTION, _LATEST, _BORO_FORECAST) + "SELECT * FROM boro_forecast")
def boro_forecast_mean(spark, folder):
    means = rollups.borough_means(_latest(spark, folder), st.segments(spark, folder), "prediction_vol")
    return means.withColumn("Vol", _r("Vol"))


@_query(_with(_CAPTURE, _SEGMENT, _PREDICTION, _LATEST, _BORO_FORECAST) + """, 
boro_history AS (
  SELECT Boro, Timestamp, round(avg(Vol), 6) AS Vol FROM capture JOIN segment USING (SegmentID)
  WHERE Timestamp > (SELECT max(Timestamp) FROM capture) - INTERVAL '3 hours' GROUP BY Boro, Timestamp)
SELECT Boro, Timestamp, Vol, 'history' AS kind FROM boro_history
WHERE Timestamp = (SELECT max(Timestamp) FROM boro_history)
UNION ALL SELECT Boro, Timestamp, Vol, 'forecast' FROM boro_forecast
WHERE Timestamp > (SELECT max(Timestamp) FROM boro_history)""")
def stitched_series(spark, folder):
    return rollups.stitch(boro_recent_mean(spark, folder), boro_forecast_mean(spark, folder))


@_query(_with(_CAPTURE, _SEGMENT) + """
SELECT Boro, Timestamp, round(sum(Vol) / count(Vol), 6) AS Vol
FROM capture JOIN segment USING (SegmentID) GROUP BY Boro, Timestamp""")
def mean_from_partials(spark, folder):
    parts = rollups.borough_partials(st.captures(spark, folder), st.segments(spark, folder))
    return rollups.merge_partials(parts).withColumn("Vol", _r("Vol"))


@_query(_with(_CAPTURE, _SEGMENT) + """
SELECT SegmentID, Direction, Vol, Timestamp, Boro, street FROM capture JOIN segment USING (SegmentID)
WHERE Boro = 'ASIA'""")
def one_borough(spark, folder):
    rows = lookup_join(st.captures(spark, folder), st.segments(spark, folder), ["SegmentID"])
    return rollups.borough_series(rows, "ASIA").select(
        "SegmentID", "Direction", "Vol", "Timestamp", "Boro", "street"
    )


# ---------------------------------------------------------------- accuracy

_ERRORS = """matched AS (
  SELECT DISTINCT SegmentID, Direction, Timestamp, Vol, prediction_vol, min_history_ds, max_history_ds
  FROM capture JOIN prediction USING (SegmentID, Timestamp, Direction)),
scored AS (
  SELECT *, abs(Vol - prediction_vol) AS AE, abs(Vol - prediction_vol) / nullif(Vol, 0) AS APE,
         floor(epoch(max_history_ds - min_history_ds)) / 60 / 60 / 24 AS range_days,
         floor(epoch(Timestamp - max_history_ds)) / 60 AS future_forecasting_minutes
  FROM matched)"""


@_query(_with(_CAPTURE, _PREDICTION, _ERRORS) + """
SELECT CAST(range_days AS INTEGER) AS range_days,
       CAST(future_forecasting_minutes AS INTEGER) AS future_forecasting_minutes,
       round(avg(AE), 6) AS MAE, round(avg(APE), 6) AS MAPE, count(*) AS pairs,
       count(*) FILTER (Vol = 0) AS zero_vol
FROM scored WHERE range_days IN (1, 3, 7) GROUP BY ALL""")
def accuracy_by_horizon(spark, folder):
    result = accuracy.accuracy(st.captures(spark, folder), st.predictions(spark, folder))
    return accuracy.integer_axes(result).withColumns({"MAE": _r("MAE"), "MAPE": _r("MAPE")})


@_query(_with(_CAPTURE, _PREDICTION, _ERRORS) + """
SELECT SegmentID, Direction, Timestamp, Vol, prediction_vol, min_history_ds, max_history_ds,
       AE, round(APE, 6) AS APE, range_days, future_forecasting_minutes FROM scored""")
def forecast_errors(spark, folder):
    axes = accuracy.forecast_axes(st.predictions(spark, folder))
    return accuracy.errors(st.captures(spark, folder), axes).withColumn("APE", _r("APE"))


# ---------------------------------------------------------------- codec and scalars


@_query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_decode(spark, folder):
    rows = st.events(spark, folder)
    return rows.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@_query(_with(_CAPTURE) + """
SELECT '{"SegmentID":' || SegmentID || ',"Direction":"' || Direction || '","Vol":' || Vol ||
       ',"Timestamp":"' || strftime(Timestamp, '%Y-%m-%d %H:%M:%S') || '"}' AS value FROM capture""")
def json_encode(spark, folder):
    return topics.encode(st.captures(spark, folder))


@_query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS to_second,
       strftime(ts, '%Y-%m-%d %H:%M') AS to_minute FROM events""")
def format_timestamps(spark, folder):
    return st.events(spark, folder).select(
        "event_id",
        et.format_event_time("ts").alias("to_second"),
        et.format_event_time("ts", et.MINUTE_FORMAT).alias("to_minute"),
    )


@_query("""SELECT event_id, floor(epoch(ts - TIMESTAMP '2024-01-01')) / 60 / 60 / 24 AS in_days,
       floor(epoch(ts - TIMESTAMP '2024-01-01')) / 60 AS in_minutes,
       (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 900e6 AS quarters FROM events""")
def interval_days(spark, folder):
    origin = F.lit("2024-01-01").cast("timestamp_ntz")
    span = F.col("ts") - origin
    return st.events(spark, folder).select(
        "event_id",
        et.interval_days(span).alias("in_days"),
        et.interval_minutes(span).alias("in_minutes"),
        et.steps_between("ts", origin).alias("quarters"),
    )


@_query("""WITH texts AS (
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'not a time'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp FROM events)
SELECT event_id, try_strptime(nullif(stamp, ''), '%Y-%m-%d %H:%M:%S') AS parsed FROM texts""")
def parse_timestamps(spark, folder):
    kind = F.pmod("event_id", F.lit(4))
    text = F.when(kind == 0, "").when(kind == 1, "not a time").otherwise(et.format_event_time("ts"))
    return st.events(spark, folder).select("event_id", et.parse_event_time(text).alias("parsed"))


@_query("""WITH texts AS (
  SELECT CASE WHEN event_id % 5 = 0 THEN 'x' || user_id ELSE CAST(user_id AS VARCHAR) END AS SegmentID,
         event_type AS Direction, CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(floor(value) AS BIGINT)::VARCHAR END AS Vol,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS Timestamp FROM events)
SELECT TRY_CAST(SegmentID AS BIGINT) AS SegmentID, Direction, TRY_CAST(Vol AS INTEGER) AS Vol,
       try_strptime(Timestamp, '%Y-%m-%d %H:%M:%S') AS Timestamp,
       TRY_CAST(SegmentID AS BIGINT) IS NULL OR TRY_CAST(Vol AS INTEGER) IS NULL AS rejected FROM texts""")
def coerced_records(spark, folder):
    user, vol = F.col("user_id").cast("string"), F.floor("value").cast("string")
    texts = st.events(spark, folder).select(
        F.when(F.pmod("event_id", F.lit(5)) == 0, F.concat(F.lit("x"), user)).otherwise(user).alias("SegmentID"),
        F.col("event_type").alias("Direction"),
        F.when(F.pmod("event_id", F.lit(7)) == 0, "").otherwise(vol).alias("Vol"),
        et.format_event_time("ts").alias("Timestamp"),
    )
    return topics.coerce(texts, st.CAPTURE)


@_query(_with(_CAPTURE) + f"SELECT * FROM capture WHERE Timestamp >= TIMESTAMP '{SINCE}'")
def history_from(spark, folder):
    # The bound lies on a step, so it can be applied to the stored time.
    bound = F.lit(SINCE).cast("timestamp_ntz")
    return st.capture(topics.since(st.events(spark, folder), bound, ts="ts"))


@_query("""SELECT event_id, make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), 0.0) AS built
FROM events""")
def timestamp_from_parts(spark, folder):
    ts = F.col("ts")
    parts = [F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.minute(ts)]
    return st.events(spark, folder).select("event_id", et.from_parts(*parts).alias("built"))


# ---------------------------------------------------------------- preparation


@_query(_with(_CAPTURE) + f"""
SELECT CASE WHEN Timestamp <= TIMESTAMP '{SPLIT_AT}' THEN 'history' ELSE 'live' END AS part,
       count(*) AS captures, CAST(sum(Vol) AS BIGINT) AS total_vol FROM capture GROUP BY 1""")
def history_live_split(spark, folder):
    return _part_counts(st.captures(spark, folder))


def _part_counts(captures: DataFrame) -> DataFrame:
    labelled = preparation.with_part(captures, SPLIT_AT)
    return labelled.groupBy("part").agg(F.count(F.lit(1)).alias("captures"), F.sum("Vol").alias("total_vol"))


# Every seventh event without a time, every eleventh without an id.
_GAPPED = """gapped AS (
  SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN event_id END AS place, user_id AS SegmentID, event_type AS Direction,
         CAST(floor(value) AS INTEGER) AS Vol, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts FROM events)"""


def _gapped(spark: SparkSession, folder: str) -> DataFrame:
    rows = st.events(spark, folder)
    return rows.select(
        "event_id", F.when(F.pmod("event_id", F.lit(11)) != 0, F.col("event_id")).alias("place"),
        F.col("user_id").alias("SegmentID"), F.col("event_type").alias("Direction"), F.floor("value").cast("int").alias("Vol"),
        F.when(F.pmod("event_id", F.lit(7)) != 0, F.col("ts")).alias("ts"),
    )


@_query(_with(_GAPPED) + f"""
SELECT CASE WHEN ts IS NULL THEN 'untimed' WHEN ts <= TIMESTAMP '{SPLIT_AT}' THEN 'history' ELSE 'live' END AS part,
       count(*) AS captures, CAST(sum(Vol) AS BIGINT) AS total_vol FROM gapped GROUP BY 1""")
def split_balance(spark, folder):
    """No row is lost in the split: those without a time are a part of their own."""
    return _part_counts(_gapped(spark, folder).withColumnRenamed("ts", "Timestamp"))


@_query(_with(_GAPPED) + "SELECT 'log' AS part, count(ts) AS records FROM gapped UNION ALL SELECT 'untimed', count(*) - count(ts) FROM gapped")
def replay_balance(spark, folder):
    """Rows of the replay log and rows set aside: together all rows."""
    root = new_path(spark, "replay-balance")
    rows = _gapped(spark, folder).select("SegmentID", "Direction", "Vol", F.col("ts").alias("Timestamp"))
    replay.write_replay_log(rows, f"{root}/log", slice_seconds=SLICE_DAYS * 86_400)
    parts = [spark.read.text(f"{root}/log{end}").select(F.lit(part).alias("part")) for part, end in (("log", ""), ("untimed", "-untimed"))]
    return preparation.stack(parts).groupBy("part").agg(F.count(F.lit(1)).alias("records"))


@_query(_with(_GAPPED) + """
SELECT event_id, place, ts, max(ts) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING) AS tick FROM gapped WHERE place IS NOT NULL
UNION ALL SELECT event_id, place, ts, NULL FROM gapped WHERE place IS NULL""")
def ticks_balance(spark, folder):
    """Rows without order stay, without a tick; small blocks carry over several levels."""
    return series.running_ticks(_gapped(spark, folder).select("event_id", "place", "ts"), "place", ts="ts", block_rows=20, group_blocks=20)


@_query(_with(_CAPTURE) + "SELECT * FROM capture WHERE SegmentID NOT IN (7, 46)")
def exclude_segments(spark, folder):
    return preparation.exclude_segments(st.captures(spark, folder), BAD_SEGMENTS)


@_query(_with(_SEGMENT) + "SELECT DISTINCT Boro, street, Lat, Long FROM segment")
def dimension_distinct(spark, folder):
    named = st.segments(spark, folder).select("Boro", "street", "Lat", "Long")
    return named.distinct().orderBy("Boro", "street")


@_query(_with(_RAW) + """
SELECT count(DISTINCT SegmentID) AS segments, count(DISTINCT WktGeom) AS points,
       count(DISTINCT Boro || '|' || Street || '|' || fromSt || '|' || toSt) AS streets FROM raw""")
def key_quality(spark, folder):
    return quality.distinct_counts(
        st.raw(spark, folder),
        {"segments": ["SegmentID"], "points": ["WktGeom"], "streets": ["Boro", "Street", "fromSt", "toSt"]},
    )


@_query(_with(_CAPTURE) + """
SELECT SegmentID, Direction, Timestamp, count(*) AS copies FROM capture
GROUP BY SegmentID, Direction, Timestamp HAVING count(*) > 1""")
def duplicate_captures(spark, folder):
    return quality.duplicate_keys(
        st.captures(spark, folder), ["SegmentID", "Direction", "Timestamp"]
    )


@_query("""SELECT DISTINCT r_name AS Boro, replace(r_name, ' ', '_') AS label
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def boro_list(spark, folder):
    found = preparation.boroughs(st.segments(spark, folder))
    return found.withColumn("label", file_label("Boro"))


@_query("""SELECT c_custkey, CAST(950000 + c_custkey % 1000 * 100 AS DOUBLE) AS x,
       CAST(150000 + n_nationkey * 4000 AS DOUBLE) AS y
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def wkt_points(spark, folder):
    text = st.point_text(F.col("c_custkey"), F.col("n_nationkey"))
    return st.places(spark, folder).select(
        "c_custkey", geo.point_x(text).alias("x"), geo.point_y(text).alias("y")
    )


def _projection_sql(points: str) -> str:
    """Columns Long and Lat from x and y in feet, as SQL over the view ``points``.

    The zone (EPSG 2263) is stated here once more, and its constants are derived in SQL, so that a wrong
    value in the code under test is found.
    """
    phi = "pi() / 2 - 2 * atan(t)"
    for _ in range(5):
        phi = f"pi() / 2 - 2 * atan(t * pow((1 - e * sin({phi})) / (1 + e * sin({phi})), e / 2))"
    scale = "cos(radians({0})) / sqrt(1 - e * e * sin(radians({0})) * sin(radians({0})))"
    half = "tan(pi() / 4 - radians({0}) / 2) / pow((1 - e * sin(radians({0}))) / (1 + e * sin(radians({0}))), e / 2)"
    return f"""ellipsoid AS (SELECT sqrt(2 / 298.257222101 - 1 / (298.257222101 * 298.257222101)) AS e, 6378137.0::DOUBLE AS a),
zone AS (
  SELECT e, a, {scale.format("(40 + 40 / 60.0)")} AS m1, {scale.format("(41 + 2 / 60.0)")} AS m2, {half.format("(40 + 40 / 60.0)")} AS t1,
         {half.format("(41 + 2 / 60.0)")} AS t2, {half.format("(40 + 10 / 60.0)")} AS t0 FROM ellipsoid),
cone AS (SELECT *, ln(m1 / m2) / ln(t1 / t2) AS n FROM zone),
radii AS (SELECT *, a * m1 / (n * pow(t1, n)) AS radius FROM cone),
planar AS (
  SELECT p.*, e, n, radius, x * (1200.0::DOUBLE / 3937) - 300000 AS east,
         radius * pow(t0, n) - y * (1200.0::DOUBLE / 3937) AS south FROM {points} p, radii),
polar AS (SELECT *, pow(sqrt(east * east + south * south) / radius, 1 / n) AS t FROM planar),
projected AS (
  SELECT *, round(degrees(atan2(east, south) / n) - 74, 6) AS Long, round(degrees({phi}), 6) AS Lat FROM polar)"""


@_query("""WITH points AS (
  SELECT c_custkey, CAST(950000 + c_custkey % 1000 * 100 AS DOUBLE) AS x,
         CAST(150000 + n_nationkey * 4000 AS DOUBLE) AS y
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
""" + _projection_sql("points") + " SELECT c_custkey, Long, Lat FROM projected")
def project_points(spark, folder):
    x, y = F.col("x"), F.col("y")
    return wkt_points(spark, folder).select(
        "c_custkey", _r(geo.longitude(x, y)).alias("Long"), _r(geo.latitude(x, y)).alias("Lat")
    )


@_query(_with(_RAW) + """, points AS (
  SELECT DISTINCT SegmentID, Boro, Street AS street, fromSt, toSt,
         CAST(split_part(replace(replace(WktGeom, 'POINT (', ''), ')', ''), ' ', 1) AS DOUBLE) AS x,
         CAST(split_part(replace(replace(WktGeom, 'POINT (', ''), ')', ''), ' ', 2) AS DOUBLE) AS y
  FROM raw WHERE SegmentID NOT IN (7, 46)),
""" + _projection_sql("points") + " SELECT SegmentID, Boro, street, fromSt, toSt, Lat, Long FROM projected")
def raw_dimension(spark, folder):
    usable = preparation.exclude_segments(st.raw(spark, folder), BAD_SEGMENTS)
    return preparation.segment_dimension(usable).withColumns({"Lat": _r("Lat"), "Long": _r("Long")})


@_query(_with(_RAW) + f"""
SELECT SegmentID, Direction, Vol, make_timestamp(Yr, M, D, HH, MM, 0.0) AS Timestamp,
       replace(Boro, ' ', '_') AS Boro FROM raw
WHERE make_timestamp(Yr, M, D, HH, MM, 0.0) > TIMESTAMP '{SPLIT_AT}'""")
def boro_files(spark, folder):
    """Live captures written as one CSV folder per borough and read back together."""
    _, live, _ = preparation.split_history(preparation.raw_captures(st.raw(spark, folder)), SPLIT_AT)
    root = new_path(spark, "boro-files")
    tables.write_by_borough(live, root)
    return tables.read_csv(spark, root, f"{st.CAPTURE}, Boro STRING")


@_query(_with(_RAW) + f""", usable AS (
  SELECT *, make_timestamp(Yr, M, D, HH, MM, 0.0) AS ts FROM raw WHERE SegmentID <> {schemas.EXCLUDED_SEGMENTS[0]})
SELECT 'capture' AS part, count(*) AS n, CAST(sum(Vol) AS BIGINT) AS total FROM usable WHERE ts <= TIMESTAMP '{SPLIT_AT}'
UNION ALL SELECT 'live', count(*), CAST(sum(Vol) AS BIGINT) FROM usable WHERE ts > TIMESTAMP '{SPLIT_AT}'
UNION ALL SELECT 'segment', count(*), CAST(sum(SegmentID) AS BIGINT) FROM (SELECT DISTINCT Boro, SegmentID, WktGeom, Street, fromSt, toSt FROM usable)
UNION ALL SELECT 'untimed', 0, NULL""")
def prepared_outputs(spark, folder):
    """Raw CSV in, all outputs of the preparation written and read back."""
    root = new_path(spark, "prepared")
    tables.write_csv(st.raw(spark, folder), f"{root}/raw")
    preparation.prepare(tables.read_raw(spark, f"{root}/raw"), root, SPLIT_AT)
    sums = {
        "capture": tables.read_captures(spark, f"{root}/capture"),
        "live": tables.read_csv(spark, f"{root}/live", f"{schemas.CAPTURE}, Boro STRING"),
        "segment": tables.read_segments(spark, f"{root}/segment").withColumn("Vol", F.col("SegmentID")),
        "untimed": tables.read_csv(spark, f"{root}/untimed", "SegmentID INT, Direction STRING, Vol INT, Boro STRING"),
    }
    return preparation.stack([
        frame.agg(F.count(F.lit(1)).alias("n"), F.sum("Vol").alias("total")).withColumn("part", F.lit(part))
        for part, frame in sums.items()
    ])


# ---------------------------------------------------------------- series and forecasts


@_query(_with(_CAPTURE) + """
SELECT SegmentID, Direction, min(Timestamp) - INTERVAL '15 minutes' AS min_history_ds,
       max(Timestamp) AS max_history_ds FROM capture GROUP BY ALL""")
def series_range(spark, folder):
    return series.series_range(st.captures(spark, folder))


def _trim_sql(days: int) -> str:
    return f"""
SELECT SegmentID, Direction, Vol, Timestamp, {days} AS history_days FROM (
  SELECT *, max(Timestamp) OVER (PARTITION BY SegmentID, Direction) AS last FROM capture)
WHERE Timestamp > last - INTERVAL '{days} days'"""


@_query(_with(_CAPTURE) + " UNION ALL ".join(_trim_sql(d) for d in schemas.HISTORY_DAYS))
def trim_history(spark, folder):
    return series.trim_ranges(st.captures(spark, folder))


_ENDS = """ends AS (
  SELECT SegmentID, Direction, max(Timestamp) AS max_history_ds FROM capture GROUP BY ALL)"""


@_query(_with(_CAPTURE, _ENDS) + """
SELECT SegmentID, Direction, max_history_ds, max_history_ds + to_minutes(15 * i) AS ds
FROM ends, (VALUES (1), (2), (3), (4)) AS steps(i)""")
def future_grid(spark, folder):
    ends = series.series_range(st.captures(spark, folder)).drop("min_history_ds")
    return series.future_grid(ends)


_LINE = """line AS (
  SELECT SegmentID, Direction,
         regr_slope(CAST(Vol AS DOUBLE), epoch(Timestamp - TIMESTAMP '2020-01-01') / 86400) AS slope,
         regr_intercept(CAST(Vol AS DOUBLE), epoch(Timestamp - TIMESTAMP '2020-01-01') / 86400) AS intercept,
         count(Vol) AS n, avg(Vol) AS level, max(Timestamp) AS max_history_ds,
         min(Timestamp) - INTERVAL '15 minutes' AS min_history_ds
  FROM capture GROUP BY SegmentID, Direction)"""


@_query(_with(_CAPTURE, _LINE) + """
SELECT SegmentID, Direction, round(slope, 4) AS slope, round(intercept, 2) AS intercept, n,
       round(level, 6) AS level, max_history_ds, min_history_ds FROM line""")
def trend_fit(spark, folder):
    return forecast.trend_fit(st.captures(spark, folder)).withColumns(
        {"slope": _r("slope", 4), "intercept": _r("intercept", 2), "level": _r("level")}
    )


@_query(_with(_CAPTURE, _LINE) + """
, grid AS (SELECT *, max_history_ds + to_minutes(15 * i) AS ds FROM line, (VALUES (1), (2), (3), (4)) AS s(i))
SELECT SegmentID, Direction, ds, min_history_ds, max_history_ds,
       round(coalesce(intercept + slope * epoch(ds - TIMESTAMP '2020-01-01') / 86400, level), 4) AS yhat FROM grid""")
def trend_forecast(spark, folder):
    return forecast.trend_forecast(st.captures(spark, folder)).withColumn("yhat", _r("yhat", 4))


@_query(_with(_CAPTURE) + """
SELECT SegmentID, Direction, Timestamp + to_days(h) AS Timestamp, CAST(Vol AS DOUBLE) AS prediction_vol,
       Timestamp - to_days(h) AS min_history_ds, Timestamp AS max_history_ds, h AS history_days
FROM capture, (VALUES (1), (3), (7)) AS lags(h)""")
def seasonal_naive(spark, folder):
    return forecast.seasonal_naive(st.captures(spark, folder))


def _run_time() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")


@_query()
def grouped_forecast(spark, folder):
    return forecast.forecast(st.captures(spark, folder), run_time=_run_time(), keep_days=True)


@_query(_with(_CAPTURE, _ENDS) + """
SELECT SegmentID, Direction, max_history_ds + to_minutes(15 * i) AS Timestamp, h AS history_days,
       CAST(SegmentID % 50 AS DOUBLE) AS prediction_vol
FROM ends, (VALUES (1), (3), (7)) AS lags(h), (VALUES (1), (2), (3), (4)) AS steps(i)""")
def forecast_of_constants(spark, folder):
    """Every series made constant, many of them of one observation: the forecast is that value."""
    flat = st.captures(spark, folder).withColumn("Vol", (F.col("SegmentID") % 50).cast("int"))
    made = forecast.forecast(flat, run_time=_run_time(), keep_days=True)
    return made.select(*schemas.SERIES_KEYS, "Timestamp", "history_days", _r("prediction_vol").alias("prediction_vol"))


_WINDOWS = _with(_CAPTURE, _ENDS) + """, windows AS (
  SELECT SegmentID, Direction, h AS history_days, max_history_ds,
         min(Timestamp) - INTERVAL '15 minutes' AS min_history_ds
  FROM capture JOIN ends USING (SegmentID, Direction), (VALUES (1), (3), (7)) AS lags(h)
  WHERE Timestamp > max_history_ds - to_days(h) GROUP BY ALL)"""


@_query(_WINDOWS + """
SELECT SegmentID, Direction, max_history_ds + to_minutes(15 * i) AS Timestamp, min_history_ds, max_history_ds,
       TIMESTAMP '2024-02-01' AS prediction_ds, history_days
FROM windows, (VALUES (1), (2), (3), (4)) AS steps(i)""")
def grouped_forecast_rows(spark, folder):
    """The same forecast without its values: which rows it must have is plain SQL."""
    return grouped_forecast(spark, folder).drop("prediction_vol")


@_query(_WINDOWS + """
SELECT DISTINCT c.SegmentID, c.Direction, c.Timestamp AS ds, min_history_ds, w.max_history_ds, history_days
FROM capture c JOIN windows w USING (SegmentID, Direction)
WHERE Timestamp > w.max_history_ds - to_days(history_days)""")
def in_sample_rows(spark, folder):
    fitted = forecast.in_sample(forecast.fit_series(st.captures(spark, folder)))
    return fitted.select(*schemas.SERIES_KEYS, "ds", "min_history_ds", "max_history_ds", "history_days")


@_query(_with(_CAPTURE) + """, ends AS (
  SELECT SegmentID % 2 AS SegmentID, Direction, max(Timestamp) AS last FROM capture GROUP BY ALL)
SELECT SegmentID, Direction, last + to_minutes(15 * i) AS ds, true AS equal FROM ends, (VALUES (1), (2), (3), (4)) AS steps(i)""")
def whole_history_fit(spark, folder):
    """All history fitted in blocks of two days, against the fit of every series in one task.

    Segments are united by parity: sums in another order change the last bits, and a series with hardly more observations than
    parameters magnifies them.
    """
    captures = st.captures(spark, folder).withColumn("SegmentID", F.pmod("SegmentID", F.lit(2)))
    blocks = long_fit.forecast_all(captures, block_seconds=2 * 86_400)
    once = forecast.future(forecast.fit_series(captures, (None,), include_history=False))
    met = blocks.join(once.select(*schemas.SERIES_KEYS, "ds", F.col("yhat").alias("other")), [*schemas.SERIES_KEYS, "ds"])
    near = F.abs(F.col("yhat") - F.col("other")) <= F.lit(1e-6) * F.greatest(F.lit(1.0), F.abs("other"))
    return met.select(*schemas.SERIES_KEYS, "ds", near.alias("equal"))


def _smoothed(key: tuple, points: pd.DataFrame) -> pd.DataFrame:
    """Exponential smoothing: every value takes the level three tenths of the way to itself."""
    values = points["sum_y"].to_numpy() / points["n"].to_numpy()
    level = values[0]
    for value in values[1:]:
        level += 0.3 * (value - level)
    return pd.DataFrame({"SegmentID": [key[0]], "Direction": [key[1]], "n": [len(values)], "level": [round(level, 6)]})


@_query(_with(_CAPTURE) + f""", points AS (
  SELECT SegmentID, Direction, Timestamp, avg(Vol) AS y FROM ({_trim_sql(7)}) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY SegmentID, Direction ORDER BY Timestamp) AS i, count(*) OVER (PARTITION BY SegmentID, Direction) AS n FROM points)
SELECT SegmentID, Direction, max(n) AS n, round(sum(y * pow(0.7, n - i) * CASE WHEN i = 1 THEN 1 ELSE 0.3 END), 6) AS level
FROM ranked GROUP BY SegmentID, Direction""")
def own_model(spark, folder):
    """A user's own function of one series in order, here exponential smoothing of the last seven days."""
    layout = "SegmentID BIGINT, Direction STRING, n BIGINT, level DOUBLE"
    return forecast.apply_per_series(st.captures(spark, folder), _smoothed, layout, limit_days=7)


# ---------------------------------------------------------------- sources and sinks


@_query(_with(_CAPTURE) + "SELECT * FROM capture")
def csv_captures(spark, folder):
    root = new_path(spark, "csv-captures")
    tables.write_csv(st.captures(spark, folder), root)
    return tables.read_csv(spark, root, st.CAPTURE)


@_query(_with(_SEGMENT) + "SELECT SegmentID, Boro, street, Lat, Long FROM segment")
def csv_segments(spark, folder):
    """The dimension as a served file with a header, longitude first."""
    root = new_path(spark, "csv-segments")
    order = ["SegmentID", "Boro", "street", "Long", "Lat"]
    tables.write_csv(st.segments(spark, folder).select(*order), root, header=True)
    layout = "SegmentID BIGINT, Boro STRING, street STRING, Long DOUBLE, Lat DOUBLE"
    return tables.read_csv(spark, root, layout, header=True)


@_query(_with(_CAPTURE) + f"SELECT * FROM capture WHERE Timestamp >= TIMESTAMP '{SINCE}'")
def daily_copy(spark, folder):
    """Typed copy by event date, read from a bound on; older dates are not opened."""
    root = new_path(spark, "daily")
    tables.write_by_day(st.captures(spark, folder), root)
    return tables.read_by_day(spark, root, st.CAPTURE, F.lit(SINCE).cast("timestamp_ntz"))


@_query(_with(_CAPTURE) + "SELECT * FROM capture")
def daily_copy_whole(spark, folder):
    root = new_path(spark, "daily")
    tables.write_by_day(st.captures(spark, folder), root)
    return tables.read_by_day(spark, root, st.CAPTURE)


@_query(_with(_CAPTURE) + "SELECT * FROM capture")
def topic_roundtrip(spark, folder):
    topic = Topic("captures", st.CAPTURE, new_path(spark, "topic"))
    topics.append(st.captures(spark, folder), topic)
    return topics.snapshot(spark, topic)


@_query(_with(_CAPTURE) + "SELECT * FROM capture UNION ALL SELECT * FROM capture")
def csv_to_topic(spark, folder):
    """CSV files into the log, twice: a log keeps both."""
    root, topic = new_path(spark, "csv"), Topic("captures", st.CAPTURE, new_path(spark, "topic"))
    tables.write_csv(st.captures(spark, folder), root)
    topics.append_csv(spark, root, topic)
    topics.append_csv(spark, root, topic)
    return topics.snapshot(spark, topic)


@_query(_with(_CAPTURE) + f"SELECT * FROM capture WHERE Timestamp >= TIMESTAMP '{SINCE}'")
def history_from_log(spark, folder):
    """A log of several appends read from a bound on: only the files whose times reach it are opened."""
    topic = Topic("captures", st.CAPTURE, new_path(spark, "topic"))
    for part in preparation.split_history(st.captures(spark, folder), SPLIT_AT)[:2]:
        topics.append(part, topic)
    return topics.snapshot(spark, topic, F.lit(SINCE).cast("timestamp_ntz"))


@_query("""SELECT user_id AS SegmentID, event_type AS Direction, CAST(floor(value) AS INTEGER) AS Vol,
       date_trunc('minute', ts) AS Timestamp FROM events""")
def minute_records(spark, folder):
    """Records with event time to the minute, as live captures are sent."""
    topic = Topic("captures", st.CAPTURE, new_path(spark, "topic"))
    replay.append_minutes(_raw_time(st.events(spark, folder)), topic)
    return topics.snapshot(spark, topic)


def _raw_time(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("user_id").alias("SegmentID"), F.col("event_type").alias("Direction"),
        F.floor("value").cast("int").alias("Vol"), F.col("ts").alias("Timestamp"),
    )


@_query("""WITH texts AS (
  SELECT user_id, event_type, CASE WHEN event_id % 5 = 0 THEN 'broken' ELSE
         '{"SegmentID":' || user_id || ',"Direction":"' || event_type || '"}' END AS value FROM events)
SELECT 'valid' AS part, count(*) AS records FROM texts WHERE value <> 'broken'
UNION ALL SELECT 'quarantine', count(*) FROM texts WHERE value = 'broken'""")
def quarantined_records(spark, folder):
    good = F.to_json(F.struct(F.col("user_id").alias("SegmentID"), F.col("event_type").alias("Direction")))
    value = F.when(F.pmod("event_id", F.lit(5)) == 0, "broken").otherwise(good)
    rows = topics.decode(st.events(spark, folder).select(value.alias("value")), st.CAPTURE)
    valid, rest = topics.split_valid(rows, ["SegmentID"])
    parts = preparation.stack([
        valid.withColumn("part", F.lit("valid")), rest.withColumn("part", F.lit("quarantine")),
    ])
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("records"))


@_query(_RECENT_SQL)
def served_means(spark, folder):
    """The published borough table: the second version replaces the first for readers."""
    root = new_path(spark, "served")
    means = boro_recent_mean(spark, folder)
    snapshots.publish(means.withColumn("Vol", -F.col("Vol")), root, 1)
    snapshots.publish(means, root, 2)
    return snapshots.read_latest(spark, root, schemas.SERVED_BOROUGHS)


@_query(_RECENT_SQL)
def served_after_restart(spark, folder):
    """A job that starts again counts from 0; readers get what it serves, not the old 40th version."""
    root = new_path(spark, "restarted")
    means = boro_recent_mean(spark, folder)
    snapshots.publish(means.withColumn("Vol", -F.col("Vol")), root, 40, "first checkpoint")
    snapshots.publish(means, root, 0, "second checkpoint")
    return snapshots.read_latest(spark, root, schemas.SERVED_BOROUGHS)


@_query(_with(_CAPTURE, _SEGMENT) + """
SELECT Boro, Timestamp, round(avg(Vol), 6) AS Vol FROM capture JOIN segment USING (SegmentID)
GROUP BY Boro, Timestamp""")
def appended_partials(spark, folder):
    """Sums of two halves appended to one file set without header, merged when read."""
    root = new_path(spark, "appended")
    places = st.segments(spark, folder)
    for part in preparation.split_history(st.captures(spark, folder), "2024-01-15 00:10:00"):
        tables.write_csv(rollups.borough_partials(part, places), root, mode="append")
    layout = "Boro STRING, Timestamp TIMESTAMP_NTZ, sum_vol BIGINT, n_vol BIGINT"
    parts = tables.read_csv(spark, root, layout)
    return rollups.merge_partials(parts).withColumn("Vol", _r("Vol"))


# ---------------------------------------------------------------- streams


@_query("""SELECT event_id, ts + CASE WHEN event_id % 10 = 0 THEN INTERVAL '-2 hours' ELSE INTERVAL '0 hours' END AS ts,
       max(ts + CASE WHEN event_id % 10 = 0 THEN INTERVAL '-2 hours' ELSE INTERVAL '0 hours' END)
         OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS tick FROM events""")
def replay_ticks(spark, folder):
    """Every tenth row arrives late and joins the tick already reached."""
    late = F.when(F.pmod("event_id", F.lit(10)) == 0, F.col("ts") - et.hours(2)).otherwise(F.col("ts"))
    rows = st.events(spark, folder).select("event_id", late.alias("ts"))
    return series.running_ticks(rows, "event_id", ts="ts")


def _replayed(spark, folder, root: str) -> Topic:
    replay.write_replay_log(
        _raw_time(st.events(spark, folder)), f"{root}/log", slice_seconds=SLICE_DAYS * 86_400
    )
    return Topic("captures", st.CAPTURE, f"{root}/log")


@_query("""WITH minutes AS (
  SELECT user_id AS SegmentID, CAST(floor(value) AS INTEGER) AS Vol, date_trunc('minute', ts) AS Timestamp FROM events),
windows AS (
  SELECT r_name AS Boro, time_bucket(INTERVAL '15 minutes', Timestamp) AS Timestamp, round(avg(Vol), 6) AS Vol
  FROM minutes JOIN customer ON SegmentID = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
SELECT * FROM windows""")
def stream_boro_mean(spark, folder):
    """Watermarked windows over the replay log, and those the watermark leaves open at its end."""
    root = new_path(spark, "stream-windows")
    topic, places = _replayed(spark, folder, root), st.segments(spark, folder)
    means = sq.borough_windows(topics.stream(spark, topic), places, f"{SLICE_DAYS} days")
    writer = means.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    query = writer.option("checkpointLocation", f"{root}/checkpoint").start(f"{root}/out")
    sq.await_or_stop(query)
    out = spark.read.schema(schemas.SERVED_BOROUGHS).parquet(f"{root}/out")
    rest = sq.open_windows(topics.snapshot(spark, topic), out, places, f"{SLICE_DAYS} days")
    return out.unionByName(rest).withColumn("Vol", _r("Vol"))


@_query(f"""SELECT user_id AS SegmentID, event_type AS Direction, CAST(floor(value) AS INTEGER) AS Vol,
       date_trunc('minute', ts) AS Timestamp FROM events WHERE date_trunc('minute', ts) >= TIMESTAMP '{SINCE}'""")
def stream_daily_copy(spark, folder):
    """The log copied to typed files by a stream, read from a bound on."""
    root = new_path(spark, "stream-copy")
    rows = topics.stream(spark, _replayed(spark, folder, root))
    sq.await_or_stop(sq.start_daily_copy(rows, f"{root}/copy", f"{root}/checkpoint", every_seconds=None))
    return tables.read_by_day(spark, f"{root}/copy", st.CAPTURE, F.lit(SINCE).cast("timestamp_ntz"))


@_query("""SELECT user_id AS SegmentID, event_type AS Direction, CAST(floor(value) AS INTEGER) AS Vol,
       date_trunc('minute', ts) AS Timestamp FROM events""")
def stream_daily_copy_whole(spark, folder):
    root = new_path(spark, "stream-copy")
    rows = topics.stream(spark, _replayed(spark, folder, root))
    sq.await_or_stop(sq.start_daily_copy(rows, f"{root}/copy", f"{root}/checkpoint", every_seconds=None))
    return tables.read_by_day(spark, f"{root}/copy", st.CAPTURE)


@_query(_with(_CAPTURE, _SEGMENT) + """
SELECT Boro, Timestamp, round(avg(Vol), 6) AS Vol FROM capture JOIN segment USING (SegmentID)
GROUP BY Boro, Timestamp""")
def stream_partial_means(spark, folder):
    """Micro-batches leave sums by epoch; merged they give every window's exact mean."""
    root = new_path(spark, "stream-partials")
    rows = topics.stream(spark, _replayed(spark, folder, root), files_per_trigger=4)
    ticked = replay.with_tick(rows).drop("Timestamp").withColumnRenamed("tick", "Timestamp")
    handle = sq.latest_captures_writer(f"{root}/served", st.segments(spark, folder))
    query = sq.start_micro_batches(ticked, handle, f"{root}/checkpoint", every_seconds=None)
    sq.await_or_stop(query)
    return sq.stored_means(spark, f"{root}/served/partials").withColumn("Vol", _r("Vol"))


@_query(_with(_CAPTURE, _SEGMENT, _PREDICTION) + """
SELECT Boro, Timestamp, round(avg(prediction_vol), 6) AS Vol FROM prediction JOIN segment USING (SegmentID)
WHERE prediction_ds = (SELECT max(prediction_ds) FROM prediction) GROUP BY Boro, Timestamp""")
def stream_latest_forecasts(spark, folder):
    """Every run comes in several files and every batch is one file; the newest run is served whole."""
    root = new_path(spark, "stream-forecasts")
    topic = Topic("predictions", st.PREDICTION, f"{root}/log")
    topics.append(st.predictions(spark, folder).repartition(3), topic)
    handle = sq.latest_forecasts_writer(f"{root}/served", st.segments(spark, folder))
    query = sq.start_micro_batches(
        topics.stream(spark, topic, files_per_trigger=1), handle, f"{root}/checkpoint", every_seconds=None
    )
    sq.await_or_stop(query)
    served = snapshots.read_latest(spark, f"{root}/served", schemas.SERVED_BOROUGHS)
    return served.withColumn("Vol", _r("Vol"))


@_query(_with(_CAPTURE, _SEGMENT, _PREDICTION, _LATEST, _BORO_FORECAST) + """
SELECT 'cache' AS served, Boro, Timestamp, NULL::DOUBLE AS Long, NULL::DOUBLE AS Lat, round(avg(Vol), 6) AS Vol
FROM capture JOIN segment USING (SegmentID)
WHERE Timestamp > (SELECT max(Timestamp) FROM capture) - INTERVAL '3 hours' GROUP BY Boro, Timestamp
UNION ALL SELECT 'prediction', Boro, Timestamp, NULL, NULL, Vol FROM boro_forecast
UNION ALL SELECT 'batch', NULL, Timestamp, Long, Lat, CAST(sum(Vol) AS DOUBLE) FROM capture JOIN segment USING (SegmentID)
WHERE Timestamp = (SELECT max(Timestamp) FROM capture) GROUP BY Timestamp, Long, Lat""")
def periodic_rollups(spark, folder):
    """The rollup cycle, started by new captures, over the three logs."""
    root = new_path(spark, "periodic")
    captures = Topic("captures", st.CAPTURE, f"{root}/captures")
    places = Topic("segments", st.SEGMENT, f"{root}/segments")
    guesses = Topic("predictions", st.PREDICTION, f"{root}/predictions")
    topics.append(st.captures(spark, folder), captures)
    topics.append(st.segments(spark, folder), places)
    topics.append(st.predictions(spark, folder), guesses)
    job = sq.recompute(
        lambda epoch: cycles.rollup_cycle(spark, captures, places, guesses, f"{root}/served", epoch)
    )
    query = sq.start_micro_batches(
        topics.stream(spark, captures), job, f"{root}/checkpoint", every_seconds=None
    )
    sq.await_or_stop(query)
    served = [
        snapshots.read_latest(spark, f"{root}/served/{name}", schemas.SERVED_BOROUGHS).withColumn(
            "served", F.lit(name)
        )
        for name in ("cache", "prediction")
    ]
    places = snapshots.read_latest(spark, f"{root}/served/batch", schemas.SERVED_LOCATIONS)
    totals = places.select("Timestamp", "Long", "Lat", F.col("total_vol").cast("double").alias("Vol"), F.lit("batch").alias("served"))
    return preparation.stack(served).withColumn("Vol", _r("Vol")).unionByName(totals, allowMissingColumns=True)


@_query(_WINDOWS + """
SELECT SegmentID, Direction, max_history_ds + to_minutes(15 * i) AS Timestamp, min_history_ds, max_history_ds,
       TIMESTAMP '2024-02-01' AS prediction_ds
FROM windows, (VALUES (1), (2), (3), (4)) AS steps(i)""")
def forecast_cycle_rows(spark, folder):
    """Forecast from the capture log to the prediction log; values are left out of the check."""
    root = new_path(spark, "forecast-cycle")
    captures = Topic("captures", st.CAPTURE, f"{root}/captures")
    guesses = Topic("predictions", st.PREDICTION, f"{root}/predictions")
    topics.append(st.captures(spark, folder), captures)
    cycles.forecast_cycle(spark, captures, guesses, run_time=_run_time())
    return topics.snapshot(spark, guesses).drop("prediction_vol")


@_query(_with(_CAPTURE, _SEGMENT) + f"""
SELECT Boro, Timestamp, round(avg(Vol), 6) AS Vol FROM capture JOIN segment USING (SegmentID)
WHERE SegmentID % 2 = 0 OR Timestamp > TIMESTAMP '{SPLIT_AT}' GROUP BY Boro, Timestamp""")
def stream_growing_dimension(spark, folder):
    """The dimension is a log that grows between two batches: every batch meets all of it that is there, and chooses anew
    how (by a limit between the two sizes)."""
    root = new_path(spark, "growing")
    topic, places = Topic("captures", st.CAPTURE, f"{root}/log"), Topic("segments", st.SEGMENT, f"{root}/segments")
    handle = sq.partial_means_writer(f"{root}/sums", lambda session: topics.snapshot(session, places), limit=1_000)
    parts = preparation.split_history(st.captures(spark, folder), SPLIT_AT)
    for captures, known in zip(parts, ("SegmentID % 2 = 0", "SegmentID % 2 = 1")):
        topics.append(st.segments(spark, folder).filter(known), places)
        topics.append(captures, topic)
        sq.await_or_stop(sq.start_micro_batches(topics.stream(spark, topic), handle, f"{root}/checkpoint", every_seconds=None))
    return sq.stored_means(spark, f"{root}/sums").withColumn("Vol", _r("Vol"))


@_query(_with(_RAW) + """
SELECT 'points' AS name, count(*) AS rows, true AS near FROM raw
UNION ALL SELECT 'segments', count(*), true FROM raw UNION ALL SELECT 'streets', count(*), true FROM raw""")
def sketched_keys(spark, folder):
    """Key counts from sketches by day, united when read, within 5 % (three standard errors) of the exact ones."""
    keys = {"segments": ["SegmentID"], "points": ["WktGeom"], "streets": ["Boro", "Street", "fromSt", "toSt"]}
    rows = st.raw(spark, folder).withColumn("Timestamp", F.make_timestamp_ntz("Yr", "M", "D", "HH", "MM", F.lit(0)))
    sketches = quality.KeySketches(spark, new_path(spark, "sketches"), keys)
    for epoch, part in enumerate((rows.filter("RequestID % 2 = 0"), rows.filter("RequestID % 2 = 1"))):
        sketches.add(part, run="a", epoch=epoch)
    exact = quality.distinct_counts(rows, keys).unpivot([], list(keys), "name", "exact")
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.lit(0.05) * F.col("exact")
    return sketches.counts().join(exact, "name").select("name", "rows", near.alias("near"))


_ACCURACY = _with(_CAPTURE, _PREDICTION, _ERRORS) + """
SELECT range_days, future_forecasting_minutes, round(avg(AE), 6) AS MAE, round(avg(APE), 6) AS MAPE, count(*) AS pairs,
       count(*) FILTER (Vol = 0) AS zero_vol
FROM scored WHERE range_days IN (1, 3, 7) GROUP BY ALL"""


@_query(_ACCURACY)
def stream_accuracy(spark, folder):
    """Accuracy kept up to date by a stream of both logs: captures and predictions come in parts, in no order of time,
    some of them twice; the served table is that of both whole tables."""
    root = new_path(spark, "stream-accuracy")
    captures, guesses = Topic("captures", st.CAPTURE, f"{root}/captures"), Topic("predictions", st.PREDICTION, f"{root}/predictions")
    history, live, _ = preparation.split_history(st.captures(spark, folder), SPLIT_AT)
    late = F.pmod("SegmentID", F.lit(3)) == 0
    handle = scores.accuracy_writer(f"{root}/accuracy", captures=st.CAPTURE, predictions=st.PREDICTION)
    again = st.captures(spark, folder).filter(late)
    for seen, guessed in ((live, "SegmentID % 2 = 0"), (history.filter(~late), "SegmentID % 2 = 1"), (again, "SegmentID % 2 = 0")):
        topics.append(seen, captures)
        topics.append(st.predictions(spark, folder).filter(guessed), guesses)
        both = scores.both_logs(topics.stream(spark, captures), topics.stream(spark, guesses))
        sq.await_or_stop(sq.start_micro_batches(both, handle, f"{root}/checkpoint", every_seconds=None))
    served = snapshots.read_latest(spark, f"{root}/accuracy/served", scores.ACCURACY)
    return served.withColumns({"MAE": _r("MAE"), "MAPE": _r("MAPE")})


@_query(_ACCURACY)
def bucketed_accuracy(spark, folder):
    """The same table from bucketed copies of both sides, which meet without a shuffle."""
    root = new_path(spark, "bucketed")
    names = [f"{side}_{root[-32:]}" for side in ("captures", "predictions")]
    sides = st.captures(spark, folder), st.predictions(spark, folder)
    buckets = tables.bucket_count(*sides, least=8)
    captures, guesses = (tables.write_bucketed(side, name, f"{root}/{name}", buckets) for side, name in zip(sides, names))
    result = accuracy.accuracy(captures, guesses)
    return result.withColumns({"MAE": _r("MAE"), "MAPE": _r("MAPE")})


@_query(_ACCURACY)
def published_accuracy(spark, folder):
    """The same table computed anew by a cycle over both logs, and served."""
    root = new_path(spark, "accuracy")
    captures, guesses = Topic("captures", st.CAPTURE, f"{root}/captures"), Topic("predictions", st.PREDICTION, f"{root}/predictions")
    topics.append(st.captures(spark, folder), captures)
    topics.append(st.predictions(spark, folder), guesses)
    cycles.accuracy_cycle(spark, captures, guesses, root=f"{root}/served", version=1)
    served = snapshots.read_latest(spark, f"{root}/served", scores.ACCURACY)
    return served.withColumns({"MAE": _r("MAE"), "MAPE": _r("MAPE")})


@_query(_with(_CAPTURE) + f"SELECT * FROM capture WHERE Timestamp > TIMESTAMP '{SPLIT_AT}'")
def stream_from_latest(spark, folder):
    """A stream that starts at the end of a log: of what was there before it has nothing, of what comes, all."""
    root = new_path(spark, "from-latest")
    topic = Topic("captures", st.CAPTURE, f"{root}/log")
    history, live, _ = preparation.split_history(st.captures(spark, folder), SPLIT_AT)
    copy = lambda batch, epoch: tables.write_by_day(batch, f"{root}/copy", batch=str(epoch))
    topics.append(history, topic)
    sq.await_or_stop(sq.start_from_latest(spark, topic, copy, f"{root}/checkpoint", every_seconds=None))
    topics.append(live, topic)
    sq.await_or_stop(sq.start_from_latest(spark, topic, copy, f"{root}/checkpoint", every_seconds=None))
    return tables.read_by_day(spark, f"{root}/copy", st.CAPTURE)


@_query("""WITH texts AS (
  SELECT CASE event_id % 5 WHEN 0 THEN 'broken' WHEN 1 THEN '{"SegmentID":"x","Direction":"N","Timestamp":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}'
              WHEN 2 THEN '{"SegmentID":' || user_id || ',"Direction":"' || event_type || '"}'
              ELSE '{"SegmentID":' || user_id || ',"Direction":"' || event_type || '","Vol":1,"Timestamp":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}' END AS value,
         CASE event_id % 5 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'type SegmentID' WHEN 2 THEN 'missing Timestamp' END AS reason FROM events)
SELECT value AS rejected, reason, count(*) AS records FROM texts WHERE reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT NULL, NULL, count(*) FROM texts WHERE reason IS NULL""")
def cycle_quarantine(spark, folder):
    """What a cycle rejects is published with text and reason; with the good records it is the whole log."""
    root = new_path(spark, "quarantine")
    topic = Topic("captures", st.CAPTURE, f"{root}/log")
    kind, time = F.pmod("event_id", F.lit(5)), et.format_event_time("ts")
    good = F.struct(F.col("user_id").alias("SegmentID"), F.col("event_type").alias("Direction"), F.lit(1).alias("Vol"), time.alias("Timestamp"))
    texts = F.when(kind == 0, "broken").when(kind == 1, F.to_json(F.struct(F.lit("x").alias("SegmentID"), F.lit("N").alias("Direction"), time.alias("Timestamp"))))
    texts = texts.when(kind == 2, F.to_json(F.struct(F.col("user_id").alias("SegmentID"), F.col("event_type").alias("Direction")))).otherwise(F.to_json(good))
    st.events(spark, folder).select(texts.alias("value")).write.text(topic.location)
    valid = cycles.checked(spark, topic, schemas.CAPTURE_KEYS, quarantine=f"{root}/rejected")
    kept = valid.select(F.lit(None).cast("string").alias("rejected"), F.lit(None).cast("string").alias("reason"))
    stored = snapshots.read_latest(spark, f"{root}/rejected", cycles.REJECTED)
    return stored.unionByName(kept).groupBy("rejected", "reason").agg(F.count(F.lit(1)).alias("records"))


@_query("SELECT 1 AS runs, true AS stamped_now")
def run_time_now(spark, folder):
    """Without a given run time all rows of a forecast carry one, between its start and its end."""
    clock = lambda: spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").alias("t")).first()["t"]
    root, begun = new_path(spark, "stamped"), clock()
    forecast.as_predictions(forecast.trend_forecast(st.captures(spark, folder))).write.parquet(root)
    stored = spark.read.parquet(root)
    during = F.min("prediction_ds").between(F.lit(begun), F.lit(clock())) & F.max("prediction_ds").between(F.lit(begun), F.lit(clock()))
    return stored.agg(F.count_distinct("prediction_ds").cast("int").alias("runs"), during.alias("stamped_now"))


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curbcount.functions import event_time as et
from curbcount.functions import geo
from curbcount.functions.text import file_label

from .conftest import at, rows


def one(spark, **columns):
    frame = spark.range(1)
    result = frame.select(*(c.alias(n) for n, c in columns.items())).first()
    return result.asDict()


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_tick_floor_and_bound(spark):
    got = one(
        spark,
        inside=et.tick_floor(ntz("2024-01-03 10:17:33.5")),
        edge=et.tick_floor(ntz("2024-01-03 10:15:00")),
        before_epoch=et.tick_floor(ntz("1969-12-31 23:59:59")),
        second=et.tick_floor(ntz("2024-01-03 10:17:33.9"), 1),
    )
    assert got == {
        "inside": at("2024-01-03 10:15"), "edge": at("2024-01-03 10:15"),
        "before_epoch": at("1969-12-31 23:45"), "second": at("2024-01-03 10:17:33"),
    }
    frame = spark.sql(
        "SELECT explode(sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-01 02:00', interval 1 minute)) ts"
    )
    bound = ntz("2024-01-01 00:30:00")
    by_tick = frame.filter(et.tick_floor("ts") > bound)
    by_time = frame.filter(F.col("ts") >= et.first_instant_after_tick(bound))
    assert rows(by_tick) == rows(by_time)


def test_intervals_truncate_and_do_not_overflow(spark):
    span = ntz("2024-01-02 00:00:00.9") - ntz("2024-01-01")
    century = ntz("2100-01-01") - ntz("1900-01-01")
    got = one(
        spark, s=et.whole_seconds(span), d=et.interval_days(century), m=et.interval_minutes(span),
        q=et.steps_between(ntz("2024-01-01 00:37:30"), ntz("2024-01-01")),
    )
    assert got == {"s": 86400, "d": 73049.0, "m": 1440.0, "q": 2.5}


def test_parse_event_time(spark):
    texts = ["2017-06-20 00:15:00", " 2017-6-2 1:02:03 ", "", "soon", "2017-13-01 00:00:00", "2017-06-20", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(et.parse_event_time("t")).collect()]
    assert got == [at("2017-06-20 00:15"), at("2017-06-02 01:02:03"), None, None, None, None, None]
    minute = frame.sparkSession.range(1).select(et.parse_event_time(F.lit("2017-06-20 00:15"), et.MINUTE_FORMAT))
    assert minute.first()[0] == at("2017-06-20 00:15")
    with pytest.raises(ValueError):
        et.parse_event_time("t", "dd.MM.yyyy")


def test_from_parts_strict_or_null(spark):
    good = et.from_parts(*(F.lit(v) for v in (2017, 6, 2, 13, 5)))
    assert one(spark, t=good)["t"] == at("2017-06-02 13:05")
    bad = spark.createDataFrame([(2017, 13, 2, 13, 5)], "y int, m int, d int, h int, i int")
    assert bad.select(et.from_parts(*"ymdhi", strict=False)).first()[0] is None
    with pytest.raises(Exception, match="(?i)month|invalid"):
        bad.select(et.from_parts(*"ymdhi")).collect()


def test_file_label(spark):
    assert one(spark, l=file_label(F.lit("Staten Island")))["l"] == "Staten_Island"


def test_point_text(spark):
    texts = ["POINT (1.5 -2)", "point(3 4e2)", "", "POINT EMPTY", "text", "LINESTRING (1 2, 3 4)", None]
    frame = spark.createDataFrame([(t,) for t in texts], "w string")
    got = [tuple(r) for r in frame.select(geo.point_x("w"), geo.point_y("w")).collect()]
    assert got == [(1.5, -2.0), (3.0, 400.0)] + [(None, None)] * 5


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.floats(-74.3, -73.6), st.floats(40.4, 41.0)), min_size=1, max_size=20))
def test_projection_inverts(spark, points):
    cone = geo.ConformalCone()
    frame = spark.createDataFrame([(*p, *cone.forward(*p)) for p in points], "lo double, la double, x double, y double")
    x, y = F.col("x"), F.col("y")
    worst = frame.agg(
        F.max(F.abs(geo.longitude(x, y) - F.col("lo"))), F.max(F.abs(geo.latitude(x, y) - F.col("la")))
    ).first()
    assert max(worst) < 1e-9


def test_projection_origin(spark):
    got = one(
        spark,
        lo=geo.longitude(F.lit(geo.FALSE_EASTING / geo.SURVEY_FOOT), F.lit(0.0)),
        la=geo.latitude(F.lit(geo.FALSE_EASTING / geo.SURVEY_FOOT), F.lit(0.0)),
    )
    assert math.isclose(got["lo"], -74.0) and math.isclose(got["la"], geo.ORIGIN_LAT, rel_tol=1e-12)

import pytest
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.functions.geo import ConformalCone
from curbcount.operators import quality
from curbcount.plans import preparation
from curbcount.sources import tables

from .conftest import at, rows

X, Y = ConformalCone().forward(-73.9, 40.8)
POINT = f"POINT ({X!r} {Y!r})"


def raw(seg, day, hour, minute, vol, boro="Bronx", street="A", direction="NB"):
    return (1, boro, 2017, 6, day, hour, minute, vol, seg, POINT, street, "from", "to", direction)


RAW = [
    raw(1, 19, 23, 45, 5), raw(1, 20, 0, 0, 6), raw(1, 20, 0, 15, 7),
    raw(2, 20, 9, 5, 8, boro="Staten Island", street="B"), raw(103857, 20, 9, 5, 99),
]


@pytest.fixture(scope="module")
def table(make):
    return make(RAW, schemas.RAW)


def test_exclusion_keeps_null_keys(make):
    frame = make([(1,), (103857,), (None,)], "SegmentID INT")
    assert rows(preparation.exclude_segments(frame)) == [(1,), (None,)]
    assert preparation.exclude_segments(frame, ()).count() == 3


def test_dimension(table):
    got = preparation.segment_dimension(preparation.exclude_segments(table))
    assert got.columns == schemas.resolve(schemas.SEGMENT).names
    first, second = got.collect()
    assert (first["SegmentID"], second["SegmentID"]) == (1, 2)
    assert abs(first["Lat"] - 40.8) < 1e-9 and abs(first["Long"] + 73.9) < 1e-9
    assert rows(got.distinct()) == rows(got)


def test_split_is_disjoint_and_whole(table):
    captures = preparation.raw_captures(table)
    history, live, untimed = preparation.split_history(captures)
    assert history.agg(F.max("Timestamp")).first()[0] == at("2017-06-20 00:00")
    assert live.agg(F.min("Timestamp")).first()[0] == at("2017-06-20 00:15")
    assert rows(history.unionByName(live)) == rows(captures) and untimed.count() == 0
    none = captures.withColumn("Timestamp", F.lit(None).cast("timestamp_ntz"))
    assert [part.count() for part in preparation.split_history(captures.unionByName(none))] == [history.count(), live.count(), captures.count()]


def test_boroughs_and_stack(table):
    assert rows(preparation.boroughs(table)) == [("Bronx",), ("Staten Island",)]
    turned = table.select(*reversed(table.columns))
    assert rows(preparation.stack([table, turned])) == sorted(RAW * 2, key=lambda r: tuple(map(str, r)))


def test_key_counts(table):
    counted = quality.distinct_counts(
        table, {"segments": ["SegmentID"], "points": ["WktGeom"], "streets": ["Boro", "Street", "fromSt", "toSt"]}
    )
    assert tuple(counted.first()) == (3, 1, 2)
    close = quality.distinct_counts(table, {"segments": ["SegmentID"]}, approximate=True)
    assert close.first()["segments"] == 3
    with_null = table.limit(1).unionByName(table.limit(1).withColumn("Boro", F.lit(None).cast("string")))
    assert quality.distinct_counts(with_null, {"b": ["Boro"]}).first()["b"] == 2
    assert rows(quality.duplicate_keys(table, ["SegmentID", "Direction"])) == [(1, "NB", 3)]


def test_prepared_files(spark, table, tmp_path):
    preparation.prepare(table, str(tmp_path))
    places = tables.read_segments(spark, str(tmp_path / "segment"))
    assert [r["SegmentID"] for r in places.orderBy("SegmentID").collect()] == [1, 2]
    assert places.first()["Lat"] == pytest.approx(40.8)
    history = tables.read_captures(spark, str(tmp_path / "capture"))
    assert rows(history) == [(1, "NB", 5, at("2017-06-19 23:45")), (1, "NB", 6, at("2017-06-20 00:00"))]
    live = tables.read_csv(spark, str(tmp_path / "live"), f"{schemas.CAPTURE}, Boro STRING")
    assert rows(live.select("SegmentID", "Boro")) == [(1, "Bronx"), (2, "Staten_Island")]

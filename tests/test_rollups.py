import pytest
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.operators.lookup import fits_broadcast, lookup_join, table_bytes
from curbcount.plans import rollups

from .conftest import at, plan, rows

NOW = "2017-06-20 12:00"
CAPTURES = [
    (1, "NB", 10, at(NOW)), (2, "NB", 30, at(NOW)), (3, "EB", 5, at(NOW)), (9, "EB", 99, at(NOW)),
    (1, "NB", 4, at("2017-06-20 09:15")), (1, "SB", None, at("2017-06-20 09:15")),
    (1, "NB", 1, at("2017-06-20 09:00")), (3, "EB", 2, at("2017-06-20 08:45")),
]
RUN1, RUN2 = at("2017-06-20 12:01"), at("2017-06-20 12:03")


def prediction(seg, ts, vol, run):
    return (seg, "NB", at(ts), vol, at("2017-06-13 12:00"), at(NOW), run)


PREDICTIONS = [
    prediction(1, "2017-06-20 12:15", 10.0, RUN1), prediction(1, "2017-06-20 12:15", 20.0, RUN2),
    prediction(2, "2017-06-20 12:15", 40.0, RUN2), prediction(1, NOW, 7.0, RUN2),
]


def test_bounds_of_current_and_recent(make):
    frame = make(CAPTURES)
    assert rows(rollups.current_tick(frame)) == [(at(NOW),)]
    assert rollups.current(frame).count() == 4
    # 09:00 lies exactly three hours back and is excluded.
    assert {r["Timestamp"] for r in rollups.recent(frame).collect()} == {at(NOW), at("2017-06-20 09:15")}


def test_raw_times_give_the_rows_of_their_steps(spark):
    frame = spark.sql("SELECT timestampadd(SECOND, id * 77, timestamp_ntz'2024-01-01 00:00:10') ts FROM range(500)")
    from curbcount.functions.event_time import tick_floor

    ticks = frame.withColumn("tick", tick_floor("ts"))
    for part in (rollups.recent, rollups.current):
        assert rows(part(frame, ts="ts", raw_step=900)) == rows(part(ticks, ts="tick").select("ts"))


def test_location_totals_join_same_place(make, segments):
    got = rows(rollups.location_totals(rollups.current(make(CAPTURES)), segments))
    assert got == [(at(NOW), -73.9, 40.8, 40, 0.4), (at(NOW), -74.1, 40.6, 5, 0.05)]


def test_borough_means_ignore_nulls_and_unknown_segments(make, segments):
    got = [tuple(r) for r in rollups.for_display(rollups.borough_means(rollups.recent(make(CAPTURES)), segments)).collect()]
    assert got == [
        ("Bronx", at("2017-06-20 09:15"), 4.0), ("Bronx", at(NOW), 20.0), ("Staten Island", at(NOW), 5.0),
    ]


def test_both_ways_of_the_lookup_agree(make, segments):
    doubled = segments.unionByName(segments.filter("SegmentID = 1"))
    frame = make(CAPTURES * 3)
    for places in (segments, doubled):
        assert fits_broadcast(places) and not fits_broadcast(places, 10)
        for rollup in (rollups.borough_means, rollups.location_totals):
            assert rows(rollup(frame, places)) == rows(rollup(frame, places, limit=10))
        assert rows(lookup_join(frame, places, ["SegmentID"])) == rows(
            lookup_join(frame, places, ["SegmentID"], limit=10)
        )
    assert "BroadcastHashJoin" in plan(rollups.borough_means(frame, segments))
    assert table_bytes(segments.select("SegmentID")) < table_bytes(segments)


def test_latest_run(make):
    frame = make(PREDICTIONS, schemas.PREDICTION)
    got = rows(rollups.latest_run(frame, F.lit(at(NOW)).cast("timestamp_ntz")))
    assert got == [(1, at("2017-06-20 12:15"), "NB", 20.0), (2, at("2017-06-20 12:15"), "NB", 40.0)]
    # A newest run without a future tick leaves nothing, even if an older run has one.
    late = make(PREDICTIONS[:1] + PREDICTIONS[3:], schemas.PREDICTION)
    assert rollups.latest_run(late, F.lit(at(NOW)).cast("timestamp_ntz")).count() == 0


def test_latest_run_has_no_window(make):
    text = plan(rollups.latest_run(make(PREDICTIONS, schemas.PREDICTION), F.lit(at(NOW)).cast("timestamp_ntz")))
    assert "Window" not in text
    # The only single-partition exchange carries one partial aggregate row per task.
    assert "partial_max" in text


def test_bound_reaches_the_scan(spark, make, tmp_path):
    make(CAPTURES).write.parquet(str(tmp_path / "c"))
    text = plan(rollups.recent(spark.read.parquet(str(tmp_path / "c"))))
    assert "GreaterThan(Timestamp,ScalarSubquery" in text


def test_mean_from_partials_equals_mean(make, segments):
    frame = make(CAPTURES)
    parts = [
        rollups.borough_partials(frame.filter(cond), segments) for cond in ("Vol < 8", "Vol >= 8", "Vol IS NULL")
    ]
    merged = rollups.merge_partials(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows(merged) == rows(rollups.borough_means(frame, segments))


def test_stitched_lines_meet(make):
    layout = "Boro STRING, Timestamp TIMESTAMP_NTZ, Vol DOUBLE"
    history = make([("Bronx", at("2017-06-20 11:45"), 1.0), ("Bronx", at(NOW), 2.0)], layout)
    ahead = make([("Bronx", at(NOW), 9.0), ("Bronx", at("2017-06-20 12:15"), 3.0)], layout)
    got = rows(rollups.stitch(history, ahead))
    assert got == [
        ("Bronx", at(NOW), 2.0, "history"), ("Bronx", at("2017-06-20 12:15"), 3.0, "forecast"),
    ]
    assert rollups.borough_series(history, "Queens").count() == 0


@pytest.mark.parametrize("hot_rows", [3, 50, 10_000])
def test_heavy_keys_with_equal_rows_keep_every_row(spark, hot_rows):
    """Half of the rows are one key, all of them equal; another key is heavy with different rows."""
    from curbcount.operators.lookup import salted_join

    facts = spark.createDataFrame([(1, 7)] * 400 + [(2, n) for n in range(200)] + [(n, n) for n in range(3, 200)] + [(None, 1)], "k INT, v INT")
    places = spark.createDataFrame([(n, f"p{n}") for n in range(1, 150)] + [(1, "again")], "k INT, name STRING")
    assert rows(salted_join(facts, places, ["k"], hot_rows=hot_rows)) == rows(facts.join(places, "k"))

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.plans import cycles, rollups
from curbcount.sources import snapshots, topics
from curbcount.sources.topics import Topic
from curbcount.streaming import queries as sq
from curbcount.streaming import replay

from .conftest import at, rows

START = at("2017-06-20 00:15")
# Four segments in two boroughs, one day of quarter hours; segment 9 has no place.
DAY = [
    (seg, "NB", (seg * 13 + i * 7) % 60, START + timedelta(minutes=15 * i)) for i in range(96) for seg in (1, 2, 3, 9)
]


@pytest.fixture
def day(make):
    return make(DAY)


def log(root, frame, **options):
    replay.write_replay_log(frame, f"{root}/log", **options)
    return Topic("captures", schemas.CAPTURE, f"{root}/log")


def run_windows(spark, root, topic, segments, delay, files=None, limit=None):
    means = sq.borough_windows(topics.stream(spark, topic, files), segments, delay, limit=limit)
    writer = means.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    sq.await_or_stop(writer.option("checkpointLocation", f"{root}/check").start(f"{root}/out"))
    return spark.read.schema(schemas.SERVED_BOROUGHS).parquet(f"{root}/out")


def test_replay_slices_are_ordered_and_repeatable(spark, day, tmp_path):
    count = replay.write_replay_log(day, str(tmp_path), slice_seconds=6 * 3600)
    assert count == 5
    assert replay.write_replay_log(day, str(tmp_path), slice_seconds=6 * 3600) == 5
    back = topics.decode(spark.read.text(str(tmp_path)), schemas.CAPTURE)
    assert rows(back) == rows(day)
    stamps = [
        max(os.path.getmtime(f) for f in part.glob("*.txt")) for part in sorted(tmp_path.glob("slice=*"))
    ]
    assert stamps == sorted(stamps)
    assert replay.write_replay_log(day.limit(0), f"{tmp_path}/none") == 0


def test_replay_sets_rows_without_time_aside(spark, day, tmp_path):
    none = day.limit(3).withColumn("Timestamp", F.lit(None).cast("timestamp_ntz"))
    far = day.limit(1).withColumn("Timestamp", F.col("Timestamp") + F.expr("INTERVAL 9000 DAYS"))
    count = replay.write_replay_log(day.unionByName(none).unionByName(far), f"{tmp_path}/log")
    assert count == 9001  # no limit on slices, and no cost for empty ones
    assert len(list((tmp_path / "log").glob("slice=*"))) == 3
    assert spark.read.text(f"{tmp_path}/log").count() == day.count() + 1
    assert topics.decode(spark.read.text(f"{tmp_path}/log-untimed"), schemas.CAPTURE).count() == 3


@pytest.mark.parametrize("files,limit", [(None, None), (1, None), (2, 1)])
def test_closed_windows_equal_the_batch(spark, day, segments, tmp_path, files, limit):
    topic = log(tmp_path, day, slice_seconds=6 * 3600)
    got = run_windows(spark, tmp_path, topic, segments, "6 hours", files, limit)
    last = START + timedelta(minutes=15 * 95)
    closed = rollups.borough_means(day, segments).filter(
        F.col("Timestamp") + F.expr("INTERVAL 15 MINUTES") <= F.lit(last) - F.expr("INTERVAL 6 HOURS")
    )
    assert rows(got) == rows(closed) and got.count() > 100


def test_restart_continues(spark, day, segments, tmp_path):
    early, late = (day.filter(f"Timestamp {op} timestamp_ntz'2017-06-20 12:00:00'") for op in ("<", ">="))
    topic = log(tmp_path, early, slice_seconds=6 * 3600)
    first = rows(run_windows(spark, tmp_path, topic, segments, "6 hours"))
    topics.encode(late).write.text(f"{topic.location}/slice=000009")
    both = run_windows(spark, tmp_path, topic, segments, "6 hours")
    assert len(first) < both.count() == both.distinct().count()
    assert set(first) <= set(rows(both))


def test_partials_give_exact_means_when_a_tick_spans_batches(spark, day, segments, tmp_path):
    topic = Topic("captures", schemas.CAPTURE, f"{tmp_path}/log")
    # Split by segment: every tick is in every file.
    for seg in (1, 2, 3, 9):
        topics.append(day.filter(F.col("SegmentID") == seg).coalesce(1), topic)
    handle = sq.latest_captures_writer(f"{tmp_path}/served", segments)
    stream = topics.stream(spark, topic, files_per_trigger=1)
    sq.await_or_stop(sq.start_micro_batches(stream, handle, f"{tmp_path}/check", every_seconds=None))
    parts = sq.stored_partials(spark, f"{tmp_path}/served/partials").read()
    assert parts.count() > 192
    assert rows(rollups.merge_partials(parts)) == rows(rollups.borough_means(day, segments))
    assert snapshots.latest_version(spark, f"{tmp_path}/served/batch") == 3


def test_repeated_epochs_replace_and_new_checkpoints_add(spark, day, segments, tmp_path):
    handle = sq.partial_means_writer(str(tmp_path / "sums"), segments)
    handle(day.filter("SegmentID = 2"), 0)
    handle(day, 0)
    assert rows(sq.stored_means(spark, f"{tmp_path}/sums")) == rows(rollups.borough_means(day, segments))
    # the same log under two checkpoints is two runs, whose epochs both begin at 0
    topic = Topic("captures", schemas.CAPTURE, f"{tmp_path}/log")
    topics.append(day, topic)
    writer = sq.partial_means_writer(f"{tmp_path}/both", segments)
    for name in ("a", "b"):
        sq.await_or_stop(sq.start_micro_batches(topics.stream(spark, topic), writer, f"{tmp_path}/{name}", every_seconds=None))
    both = sq.stored_partials(spark, f"{tmp_path}/both").read()
    assert len(list((tmp_path / "both" / "batches").iterdir())) == 2
    assert both.agg(F.sum("n_vol")).first()[0] == 2 * rollups.borough_partials(day, segments).agg(F.sum("n_vol")).first()[0]


def test_open_windows_complete_a_finished_stream(spark, day, segments, tmp_path):
    topic = log(tmp_path, day, slice_seconds=6 * 3600)
    closed = run_windows(spark, tmp_path, topic, segments, "6 hours")
    rest = sq.open_windows(topics.snapshot(spark, topic), closed, segments, "6 hours")
    assert rest.count() > 0 and rows(closed.unionByName(rest)) == rows(rollups.borough_means(day, segments))


def test_watermark_needs_zoned_time(spark, day, segments, tmp_path):
    topic = log(tmp_path, day)
    with pytest.raises(Exception, match="(?i)event.?time|timestamp"):
        topics.stream(spark, topic).withWatermark("Timestamp", "1 hour").groupBy("Timestamp").count().writeStream.format(
            "memory").queryName("ntz").outputMode("append").start()


def test_latest_forecasts_replace_each_other(spark, make, segments, tmp_path):
    topic = Topic("predictions", schemas.PREDICTION, f"{tmp_path}/log")
    handle = sq.latest_forecasts_writer(f"{tmp_path}/served", segments)

    def send(segment, value, run):
        row = (segment, "NB", at("2017-06-20 12:15"), value, START, START, run)
        topics.append(make([row], schemas.PREDICTION), topic)
        query = sq.start_micro_batches(topics.stream(spark, topic), handle, f"{tmp_path}/check", every_seconds=None)
        sq.await_or_stop(query)
        return rows(snapshots.read_latest(spark, f"{tmp_path}/served", schemas.SERVED_BOROUGHS))

    assert send(1, 10.0, START) == [("Bronx", at("2017-06-20 12:15"), 10.0)]
    # the same run goes on in a second batch: served is the mean of both
    assert send(2, 30.0, START) == [("Bronx", at("2017-06-20 12:15"), 20.0)]
    assert send(1, 5.0, START + timedelta(hours=1)) == [("Bronx", at("2017-06-20 12:15"), 5.0)]
    # rows of an older run that come late change nothing
    assert send(2, 50.0, START) == [("Bronx", at("2017-06-20 12:15"), 5.0)]


def test_periodic_job_runs_and_stops(spark, tmp_path):
    epochs = []
    query = sq.start_periodic(spark, epochs.append, str(tmp_path), every_seconds=1)
    assert sq.await_or_stop(query, timeout=8) is False
    assert not query.isActive and len(epochs) >= 2 and epochs == sorted(set(epochs))


def test_cycles_over_logs(spark, make, day, segments, tmp_path):
    captures = Topic("captures", schemas.CAPTURE, f"{tmp_path}/captures")
    places = Topic("segments", schemas.SEGMENT, f"{tmp_path}/segments")
    guesses = Topic("predictions", schemas.PREDICTION, f"{tmp_path}/predictions")
    topics.append(day, captures)
    topics.append(segments, places)
    for minute in (1, 3):
        stamp = F.lit(f"2017-06-21 00:0{minute}:00").cast("timestamp_ntz")
        cycles.forecast_cycle(spark, captures, guesses, run_time=stamp)
    stored = topics.snapshot(spark, guesses)
    assert stored.count() == 2 * 4 * 4 * 3 and stored.select("prediction_ds").distinct().count() == 2
    root = f"{tmp_path}/served"
    for version in (1, 2):
        cycles.rollup_cycle(spark, captures, places, guesses, root, version)
    batch = snapshots.read_latest(spark, f"{root}/batch", schemas.SERVED_LOCATIONS)
    assert rows(batch) == rows(rollups.location_totals(rollups.current(day), segments).drop("weight"))
    cache = snapshots.read_latest(spark, f"{root}/cache", schemas.SERVED_BOROUGHS)
    assert rows(cache) == rows(rollups.borough_means(rollups.recent(day), segments))
    ahead = snapshots.read_latest(spark, f"{root}/prediction", schemas.SERVED_BOROUGHS)
    assert ahead.count() == 2 * 4
    topics.append(day.withColumn("Timestamp", F.col("Timestamp") + F.expr("INTERVAL 1 HOUR")), captures)
    result = cycles.accuracy_cycle(spark, captures, guesses)
    assert [tuple(r)[:2] for r in result.collect()] == [(1.0, m) for m in (15.0, 30.0, 45.0, 60.0)]
    assert all(r["MAE"] >= 0 for r in result.collect())

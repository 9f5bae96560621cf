"""Accuracy kept up to date, runs by their manifest, starts at the end of a log, stored quarantine."""

from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from curbcount import registry, schemas
from curbcount.plans import accuracy, cycles, rollups
from curbcount.plans.scores import Scores, _unseen
from curbcount.session import scratch
from curbcount.sources import snapshots, tables, topics
from curbcount.sources.topics import Topic
from curbcount.streaming import queries as sq
from curbcount.streaming import replay

from .conftest import at, plan, rows

START = at("2017-06-20 00:15")


def captures(make, ticks, segments=(1, 2), more=0):
    return make([(s, "NB", (s * 7 + t * 3 + more) % 5, START + timedelta(minutes=15 * t)) for t in ticks for s in segments])


def predictions(make, ticks, run=0, days=(1, 3, 7)):
    out = []
    for t in ticks:
        for s in (1, 2):
            for d in days:
                end = START + timedelta(minutes=15 * (t - 1))
                out.append((s, "NB", START + timedelta(minutes=15 * t), float((s + t + d) % 6), end - timedelta(days=d), end, START + timedelta(hours=run)))
    return make(out, schemas.PREDICTION)


def same(scores, seen, guessed):
    want = accuracy.accuracy(seen, guessed)
    rounded = [[F.round(c, 9).alias(c) if c in ("MAE", "MAPE") else F.col(c) for c in t.columns] for t in (want, scores.table())]
    return rows(scores.table().select(*rounded[1])) == rows(want.select(*rounded[0])) and want.count() > 0


def test_sums_of_batches_equal_the_full_recompute(spark, make, tmp_path):
    scores = Scores(spark, f"{tmp_path}/state")
    seen = [captures(make, range(0, 20)), captures(make, range(10, 30)), captures(make, range(0, 5), more=1), captures(make, [40]), captures(make, []), captures(make, range(0, 30))]
    guessed = [predictions(make, range(15, 25)), predictions(make, range(0, 16)), predictions(make, []), predictions(make, range(0, 3), run=2), predictions(make, [40], days=(1, 2)), predictions(make, [9])]
    nulls = make([(None, "NB", 1, START), (1, None, 1, START), (1, "NB", None, START + timedelta(minutes=75)), (1, "NB", 2, None)])
    seen[1] = seen[1].unionByName(nulls)
    for epoch, (c, p) in enumerate(zip(seen, guessed)):
        scores.add(c, p, "a", epoch)
        whole = [part[0] for part in (seen, guessed)]
        for more in range(1, epoch + 1):
            whole = [whole[0].unionByName(seen[more]), whole[1].unionByName(guessed[more])]
        assert same(scores, *whole)
    # a batch that is handled again changes nothing
    scores.add(seen[-1], guessed[-1], "a", len(seen) - 1)
    scores.add(seen[0], guessed[0], "a", 0)
    assert same(scores, *whole)


def test_a_batch_that_stopped_on_its_way_is_taken_in_once(spark, make, tmp_path, monkeypatch):
    scores = Scores(spark, f"{tmp_path}/state")
    c, p = captures(make, range(0, 8)), predictions(make, range(0, 8))
    add = scores.sums.add
    monkeypatch.setattr(scores.sums, "add", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        scores.add(c, p, "a", 0)
    monkeypatch.setattr(scores.sums, "add", add)
    assert scores.sums.read().count() == 0
    scores.add(c, p, "a", 0)
    assert same(scores, c, p)


def test_the_newest_run_is_known_without_opening_sums(spark, make, segments, tmp_path):
    """200 epochs of older runs and of the newest: one more epoch opens a bounded number of files."""
    handle = sq.latest_forecasts_writer(f"{tmp_path}/served", segments)

    def batch(run, value):
        return make([(1, "NB", START, value, START, START, START + timedelta(hours=run))], schemas.PREDICTION)

    handle(batch(0, 4.0), 0)
    handle(batch(1, 6.0), 1)
    parts = tmp_path / "served-sums"
    assert sorted(p.name for p in parts.iterdir()) == ["2017-06-20T011500", "newest"]  # older sums are gone
    store = sq.stored_partials(spark, f"{parts}/2017-06-20T011500", sq.FORECAST_PARTIALS)
    first = Path(store.folder("", 1))
    for epoch in range(2, 202):
        folder = Path(store.folder("", epoch))
        folder.mkdir(parents=True)
        for file in first.iterdir():
            (folder / file.name).write_bytes(file.read_bytes())
    handle(batch(1, 6.0), 202)
    assert len(store.read().inputFiles()) <= 3 * store.fan
    assert rows(snapshots.read_latest(spark, f"{tmp_path}/served", schemas.SERVED_BOROUGHS)) == [("Bronx", START, 6.0)]
    assert store.read().agg(F.sum("n_vol")).first()[0] == 202
    handle(batch(0, 99.0), 203)
    handle(batch(0, 1.0).withColumn("prediction_ds", F.lit(None).cast("timestamp_ntz")), 204)
    assert rows(snapshots.read_latest(spark, f"{tmp_path}/served", schemas.SERVED_BOROUGHS)) == [("Bronx", START, 6.0)]


def test_partial_sums_of_many_epochs_open_few_folders(spark, make, segments, tmp_path):
    handle = sq.partial_means_writer(f"{tmp_path}/sums", segments)
    day = captures(make, range(4))
    store = sq.stored_partials(spark, f"{tmp_path}/sums")
    for epoch in range(20):
        handle(day, epoch)
    handle(day, 19)
    assert len(store.paths()) < 16
    assert rows(sq.stored_means(spark, f"{tmp_path}/sums")) == rows(rollups.borough_means(day, segments))
    assert store.read().agg(F.sum("n_vol")).first()[0] == 20 * day.count()


def test_a_stream_from_latest_sees_only_what_comes(spark, make, tmp_path):
    topic = Topic("captures", schemas.CAPTURE, f"{tmp_path}/log")
    got = []

    def start():
        sq.await_or_stop(sq.start_from_latest(spark, topic, lambda batch, epoch: got.extend(rows(batch)), f"{tmp_path}/check", every_seconds=None))

    for day in range(3):
        topics.append(captures(make, [day]), topic)
    start()
    assert got == []
    topics.append(captures(make, [7]), topic)
    start()
    assert sorted(got) == rows(captures(make, [7]))
    start()
    topics.append(captures(make, [8]), topic)
    start()
    assert sorted(got) == rows(captures(make, [7, 8]))


def test_leading_to_the_end_opens_no_file(spark, tmp_path):
    (tmp_path / "log").mkdir()
    # a file that fails when it is opened: it says it is packed and is not
    (tmp_path / "log" / "part-0.txt.gz").write_bytes(b"not packed")
    topic = Topic("captures", schemas.CAPTURE, f"{tmp_path}/log")
    query = sq.start_from_latest(spark, topic, lambda batch, epoch: None, f"{tmp_path}/check", every_seconds=None)
    sq.await_or_stop(query)
    assert query.exception() is None and (tmp_path / "check" / "commits" / "0").exists()


def test_the_number_of_replay_jobs_does_not_grow_with_slices(spark, make, tmp_path):
    tracker = spark.sparkContext.statusTracker()

    def jobs(count):
        name = f"replay-{count}"
        spark.sparkContext.setJobGroup(name, name)
        try:
            assert replay.write_replay_log(captures(make, range(0, 4 * count, 4)), f"{tmp_path}/{count}", slice_seconds=3600) == count
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(name))

    assert jobs(40) <= jobs(5) + 1
    times = [max(f.stat().st_mtime_ns for f in p.glob("*.txt")) for p in sorted((tmp_path / "40").glob("slice=*"))]
    assert len(times) == 40 and times == sorted(set(times))


def test_a_cycle_stores_what_it_rejects(spark, make, segments, tmp_path):
    log = Topic("captures", schemas.CAPTURE, f"{tmp_path}/log")
    topics.append(captures(make, range(12)), log)
    bad = [
        ("nonsense", "not JSON"), ("[1]", "not JSON"), ("", "not JSON"), ('{"SegmentID":1,"Direction":"NB","Vol":"many","Timestamp":"2017-06-20 00:15:00"}', "type Vol"),
        ('{"SegmentID":1,"Direction":"NB","Vol":1,"Timestamp":"yesterday"}', "type Timestamp"), ('{"Direction":"NB","Vol":1,"Timestamp":"2017-06-20 00:15:00"}', "missing SegmentID"),
        ('{"SegmentID":1,"Direction":"NB","Vol":1,"Timestamp":" "}', "missing Timestamp"), ("{}", "missing SegmentID"),
    ]
    spark.createDataFrame([(b[0],) for b in bad], "value string").coalesce(1).write.mode("append").text(log.location)
    guesses, places = Topic("predictions", schemas.PREDICTION, f"{tmp_path}/predictions"), Topic("segments", schemas.SEGMENT, f"{tmp_path}/segments")
    topics.append(segments, places)
    for _ in range(2):  # every cycle replaces what the last one has stored
        cycles.forecast_cycle(spark, log, guesses, quarantine=f"{tmp_path}/rejected")
        cycles.rollup_cycle(spark, log, places, guesses, f"{tmp_path}/served", 1, quarantine=f"{tmp_path}/also")
    for root in ("rejected", "also"):
        stored = snapshots.read_latest(spark, f"{tmp_path}/{root}", cycles.REJECTED)
        assert sorted((r["rejected"] or "", r["reason"]) for r in stored.collect()) == sorted(bad)
    assert topics.snapshot(spark, log).count() == 24 + len(bad)
    cache = snapshots.read_latest(spark, f"{tmp_path}/served/cache", schemas.SERVED_BOROUGHS)
    assert rows(cache) == rows(rollups.borough_means(captures(make, range(12)), segments))
    bound = START + timedelta(minutes=150)
    cut = topics.checked_snapshot(spark, log, schemas.CAPTURE_KEYS, bound)
    assert cut.filter("reason IS NULL").count() == 4 and cut.filter("reason IS NOT NULL").count() == 6


def test_only_files_of_the_newest_runs_are_opened(spark, make, tmp_path):
    guesses = Topic("predictions", schemas.PREDICTION, f"{tmp_path}/predictions")
    for run in (0, 2, 1):
        topics.append(predictions(make, range(4), run).coalesce(1), guesses)
    read = topics.newest_run(spark, guesses)
    assert len(read.inputFiles()) == 1 and read.select("prediction_ds").distinct().count() == 1
    now = F.lit(START).cast("timestamp_ntz")
    assert rows(rollups.latest_run(read, now)) == rows(rollups.latest_run(topics.snapshot(spark, guesses), now))
    # a file without a note is opened, too
    topics.encode(predictions(make, [9], 5).coalesce(1)).write.mode("append").text(guesses.location)
    assert rows(rollups.latest_run(topics.newest_run(spark, guesses), now)) == rows(rollups.latest_run(topics.snapshot(spark, guesses), now))


def test_bucketed_copies_meet_without_a_shuffle(spark, make, tmp_path):
    seen = captures(make, range(40)).unionByName(captures(make, range(10)))
    guessed = predictions(make, range(5, 60)).unionByName(predictions(make, range(8), run=1))
    copies = [tables.write_bucketed(f, f"{name}_buckets", f"{tmp_path}/{name}", 4) for f, name in ((seen, "seen"), (guessed, "guessed"))]
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        met, plain = accuracy.errors(*copies), accuracy.errors(seen, guessed)
        assert "SortMergeJoin" in plan(met)
        assert "Exchange hashpartitioning" not in plan(met) and "Exchange hashpartitioning" in plan(plain)
        assert rows(met) == rows(plain) and met.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
        for name in ("seen", "guessed"):
            spark.sql(f"DROP TABLE {name}_buckets")


def test_buckets_grow_with_the_tables(spark, make, monkeypatch):
    seen, guessed = captures(make, range(40)), predictions(make, range(60))
    assert tables.bucket_count(seen, guessed) == 1 and tables.bucket_count(seen, guessed, least=8) == 8
    assert tables.bucket_count(seen.limit(0), least=8) == 8
    monkeypatch.setattr(tables, "BUCKET_BYTES", 1000)
    assert tables.bucket_count(seen, guessed) == tables.bucket_count(guessed) > tables.bucket_count(seen) >= 4


def test_bucketed_query_takes_buckets_of_bounded_size(spark, monkeypatch):
    folder, made = "/root/testdata/sf0.001", []
    known = rows(registry.bucketed_accuracy(spark, folder))
    write = tables.write_bucketed
    monkeypatch.setattr(tables, "write_bucketed", lambda df, name, path, buckets: made.append(buckets) or write(df, name, path, buckets))
    monkeypatch.setattr(tables, "BUCKET_BYTES", 4000)
    assert rows(registry.bucketed_accuracy(spark, folder)) == known
    assert made[0] == made[1] > 8


def test_new_rows_are_found_by_one_grouping(spark, make, tmp_path):
    given = captures(make, range(4)).unionByName(captures(make, range(2))).unionByName(make([(1, "NB", None, START)] * 2 + [(2, "NB", None, START)]))
    seen = captures(make, [0, 3]).unionByName(make([(2, "NB", None, START)]))
    new = _unseen(given, seen, given.columns)
    assert rows(new) == rows(given.distinct().exceptAll(seen)) and new.count() == 5
    assert "Join" not in plan(new)


def test_a_batch_is_written_once(spark, make, tmp_path):
    """Its new rows go to the store alone, without an intermediate copy, and meet what is distinct already."""
    scores = Scores(spark, f"{tmp_path}/state")
    with scratch(spark) as root:
        for epoch in range(3):
            scores.add(captures(make, range(epoch, 20)), predictions(make, range(5, 15 + epoch)), "a", epoch)
        assert not Path(root).exists()
    assert same(scores, captures(make, range(20)), predictions(make, range(5, 17)))

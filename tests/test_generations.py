"""Levelled batch tables and the zone maps of logs."""

import json
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.sources import files, topics, zones
from curbcount.sources.generations import Generations
from curbcount.sources.topics import Topic

from .conftest import at, rows

START = at("2017-06-20 00:00")


def summed(table):
    return table.groupBy("k").agg(F.sum("n").alias("n"))


@pytest.fixture
def store(spark, tmp_path):
    return Generations(spark, f"{tmp_path}/table", "k BIGINT, n BIGINT", summed, fan=4)


def batch(spark, n):
    return spark.range(3).select(F.col("id").alias("k"), F.lit(n).cast("bigint").alias("n")).coalesce(1)


def total(store):
    return {r["k"]: r["n"] for r in summed(store.read()).collect()}


def fake_batches(store, template, run, epochs):
    """Many finished batches without a Spark job each: copies of one."""
    source = Path(store.folder(*template))
    for epoch in epochs:
        folder = Path(store.folder(run, epoch))
        folder.mkdir(parents=True)
        for file in source.iterdir():
            (folder / file.name).write_bytes(file.read_bytes())


def test_after_a_thousand_batches_few_folders_are_opened(spark, store):
    store.add(batch(spark, 1), "a", 0)
    for first in range(1, 1001, 50):
        fake_batches(store, ("a", first - 1), "a", range(first, first + 50))
        while store.compact(before=("a", first + 49)):
            # the batch that may be repeated stays outside
            if len([s for s in store.manifest().sets if s["level"] == 1]) < store.fan:
                break
    assert total(store) == {0: 1001, 1: 1001, 2: 1001}
    assert len(store.paths()) <= 5 * store.fan
    assert len(store.read().inputFiles()) <= 5 * store.fan
    # replaced folders are gone but for those of the last merges
    assert len(files.listing(spark, f"{store.root}/batches/run=a")) <= 150


def test_a_repeated_batch_counts_once(spark, store):
    for epoch in range(4):
        store.add(batch(spark, 1), "a", epoch)
    store.add(batch(spark, 1), "a", 3)
    store.add(batch(spark, 5), "b", 0)
    assert total(store)[0] == 9
    assert store.compact() and total(store)[0] == 9
    store.add(batch(spark, 7), "a", 3)  # it is in a set already
    assert total(store)[0] == 9
    store.add(batch(spark, 2), "a", 4)
    assert total(store)[0] == 11 and store.has("a", 3) and store.has("a", 4) and not store.has("a", 5)
    assert store.read(but=("a", 4)).agg(F.sum("n")).first()[0] == 27


def test_a_writer_that_stops_between_data_and_manifest_changes_nothing(spark, store, monkeypatch):
    for epoch in range(4):
        store.add(batch(spark, 1), "a", epoch)
    with monkeypatch.context() as patch:
        patch.setattr(Generations, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            store.compact()
    assert len(files.listing(spark, f"{store.root}/sets")) == 1 and total(store)[0] == 4
    assert store.compact() and total(store)[0] == 4
    assert len(files.listing(spark, f"{store.root}/sets")) == 1  # what was left over is gone
    # a manifest that was not written to its end is no manifest
    last = files.listing(spark, f"{store.root}/manifest")[-1]
    files.create(spark, f"{store.root}/manifest/{int(last.name[:12]) + 1:012d}.json", '{"version": 9, "se')
    assert total(store)[0] == 4
    for epoch in range(4, 8):
        store.add(batch(spark, 1), "a", epoch)
    assert store.compact() and total(store)[0] == 8


def test_a_writer_that_stops_after_the_manifest_changes_nothing(spark, store, monkeypatch):
    for epoch in range(4):
        store.add(batch(spark, 1), "a", epoch)
    with monkeypatch.context() as patch:
        patch.setattr("curbcount.sources.generations.remove", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        patch.setattr(Generations, "_sweep", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            store.compact()
    assert total(store)[0] == 4 and len(store.paths()) == 1


def test_two_writers_do_not_lose_each_others_manifest(spark, store):
    mine, other = store.manifest(), store.manifest()
    other.facts["x"] = "1"
    assert store.commit(other)
    mine.facts["y"] = "2"
    assert not store.commit(mine)
    store.note(y="2")
    assert store.facts() == {"x": "1", "y": "2"}


def test_unfinished_and_empty_tables(spark, store):
    assert store.read().count() == 0 and not store.compact()
    store.add(batch(spark, 1), "a", 0)
    store.add(batch(spark, 1), "a", 1)
    (Path(store.folder("a", 1)) / "_SUCCESS").unlink()
    assert total(store)[0] == 1


def test_runs_of_one_batch_are_not_remembered(spark, store):
    for _ in range(24):
        store.add(batch(spark, 1))
        store.compact()
    assert total(store)[0] == 24 and len(store.manifest().upto) <= 12
    assert all(json.loads(files.read(spark, e.path)) for e in files.listing(spark, f"{store.root}/manifest"))


# ---------------------------------------------------------------- zone maps


def captures(make, day, count=8):
    return make([(1, "NB", i, START + timedelta(days=day, minutes=15 * i)) for i in range(count)]).coalesce(1)


@pytest.fixture
def log(make, tmp_path):
    topic = Topic("captures", schemas.CAPTURE, f"{tmp_path}/my log")
    for day in range(4):
        topics.append(captures(make, day), topic)
    return topic


def test_a_bounded_read_opens_only_files_that_reach_the_bound(spark, log):
    assert len(topics.snapshot(spark, log).inputFiles()) == 4
    for bound, opened in ((START, 4), (START + timedelta(days=2), 2), (START + timedelta(days=3, minutes=105), 1), (START + timedelta(days=9), 0)):
        cut = topics.snapshot(spark, log, bound)
        assert len(cut.inputFiles()) == opened
        assert rows(cut) == rows(topics.snapshot(spark, log).where(F.col("Timestamp") >= F.lit(bound)))
    column = F.lit("2017-06-22").cast("timestamp_ntz")
    assert len(topics.snapshot(spark, log, column).inputFiles()) == 2
    assert len(topics.snapshot(spark, log, "2017-06-22 00:00:00").inputFiles()) == 2


def test_files_without_a_note_are_always_read(spark, make, log):
    topics.encode(captures(make, 0)).write.mode("append").text(log.location)
    bound = START + timedelta(days=3)
    assert len(topics.snapshot(spark, log, bound).inputFiles()) == 2
    assert zones.index(spark, log.location, log.layout()) == 1 and zones.index(spark, log.location, log.layout()) == 0
    assert len(topics.snapshot(spark, log, bound).inputFiles()) == 1


def test_notes_of_records_without_time(spark, make, log):
    none = captures(make, 0).withColumn("Timestamp", F.lit(None).cast("timestamp_ntz"))
    topics.append(none, log)
    spark.createDataFrame([("broken",)], "value string").coalesce(1).write.mode("append").text(log.location)
    zones.index(spark, log.location, log.layout())
    assert topics.snapshot(spark, log).count() == 8 * 5 + 1
    cut = topics.snapshot(spark, log, START)
    assert len(cut.inputFiles()) == 4 and cut.count() == 32


def test_notes_stay_few_and_a_moved_log_keeps_them(spark, make, tmp_path):
    topic = Topic("captures", schemas.CAPTURE, f"{tmp_path}/log")
    for day in range(18):
        topics.append(captures(make, day, 1), topic)
    assert len(zones.store(spark, topic.location).paths()) < 16
    (tmp_path / "log").rename(tmp_path / "other")
    moved = Topic("captures", schemas.CAPTURE, f"{tmp_path}/other")
    assert len(topics.snapshot(spark, moved, START + timedelta(days=16)).inputFiles()) == 2


def test_logs_without_times_have_no_notes(spark, segments, tmp_path):
    topic = Topic("segments", schemas.SEGMENT, f"{tmp_path}/log")
    topics.append(segments, topic)
    assert not (tmp_path / "log" / "_zones").exists() and topics.snapshot(spark, topic).count() == 3

"""Dimensions that grow under a stream, and key counts that are never taken anew."""

from datetime import timedelta

from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.operators import lookup, quality
from curbcount.plans import rollups
from curbcount.sources import topics
from curbcount.sources.topics import Topic
from curbcount.streaming import queries as sq

from .conftest import at, rows

START = at("2017-06-20 00:15")


def test_a_dimension_that_crosses_the_limit_between_two_batches(spark, make, tmp_path, monkeypatch):
    places = Topic("segments", schemas.SEGMENT, f"{tmp_path}/segments")
    salted = []
    plain = lookup.salted_join
    monkeypatch.setattr(lookup, "salted_join", lambda facts, *a, **k: salted.append(1) or plain(facts, *a, **{**k, "hot_rows": 3}))
    handle = sq.latest_captures_writer(f"{tmp_path}/served", lambda session: topics.snapshot(session, places), limit=1000)

    def known(numbers):
        return make([(n, "Bronx" if n % 2 else "Queens", "A", "B", "C", 40.8, -73.9) for n in numbers], schemas.SEGMENT)

    def batch(first):
        # one segment with many rows
        return make([(n if n < 30 else 1, "NB", n, START + timedelta(minutes=15 * (first + n % 4))) for n in range(60)])

    topics.append(known(range(3)), places)
    handle(batch(0), 0)
    assert not salted
    topics.append(known(range(3, 40)), places)
    handle(batch(100), 1)
    assert salted
    want = rollups.borough_means(batch(0), known(range(3))).unionByName(rollups.borough_means(batch(100), known(range(40))))
    assert rows(sq.stored_means(spark, f"{tmp_path}/served/partials")) == rows(want)


def test_sketches_meet_the_stated_error_and_old_days_are_not_read(spark, tmp_path):
    keys = {"one": ["a"], "two": ["a", "b"]}
    sketches = quality.KeySketches(spark, f"{tmp_path}/sketches", keys)

    def day(n, first, count):
        time = F.lit(START + timedelta(days=n)).cast("timestamp_ntz")
        return spark.range(first, first + count).select((F.col("id") % 5000).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("b"), time.alias("Timestamp"))

    whole = None
    for n in range(20):
        part = day(n, n * 1500, 3000)
        whole = part if whole is None else whole.unionByName(part)
        sketches.add(part, run="a", epoch=n)
    sketches.add(day(19, 19 * 1500, 3000), run="a", epoch=19)  # again
    exact = quality.distinct_counts(whole, keys).first()
    found = {r["name"]: (r["distinct"], r["rows"]) for r in sketches.counts().collect()}
    for name in keys:
        assert abs(found[name][0] - exact[name]) <= 0.05 * exact[name] and found[name][1] == 60_000
    # only sketches are read: one row a day and set of keys, in few folders
    read = sketches.store.read()
    assert read.count() == 40 and len(sketches.store.paths()) < 16
    some = sketches.counts(F.lit("2017-06-21").cast("date"), F.lit("2017-06-22").cast("date"))
    part = quality.distinct_counts(day(1, 1500, 3000).unionByName(day(2, 3000, 3000)), keys).first()
    assert all(abs(r["distinct"] - part[r["name"]]) <= 0.05 * part[r["name"]] for r in some.collect())


def test_no_rows_and_rows_without_time(spark, make, tmp_path):
    sketches = quality.KeySketches(spark, f"{tmp_path}/sketches", {"one": ["SegmentID"]})
    assert sketches.counts().count() == 0
    sketches.add(make([(1, "NB", 1, None), (2, "NB", 1, START), (None, "NB", 1, START)]))
    assert [tuple(r) for r in sketches.counts().collect()] == [("one", 3, 3)]

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from curbcount.operators import lookup, series

from .conftest import at, plan, rows

END = at("2017-06-20 12:00")


def ticks(seg, count, end=END, direction="NB"):
    return [(seg, direction, i, end - timedelta(minutes=15 * i)) for i in range(count)]


def test_full_history_measures_whole_days(make):
    got = series.series_range(make(ticks(1, 96))).first()
    assert got["max_history_ds"] - got["min_history_ds"] == timedelta(days=1)


@pytest.mark.parametrize("limit", [None, 1])
def test_trim_is_per_series_and_strict(make, limit):
    old = END - timedelta(days=30)
    frame = make(ticks(1, 200) + ticks(2, 200, end=old) + [(None, "NB", 1, END), (3, "NB", 1, None)])
    got = series.trim_history(frame, 1, broadcast_limit=limit)
    assert got.columns == frame.columns
    assert rows(got) == sorted(
        ticks(1, 96) + ticks(2, 96, end=old), key=lambda r: tuple(map(str, r))
    )


def test_trim_never_gathers_a_series(make, spark, tmp_path, monkeypatch):
    make(ticks(1, 10)).write.parquet(str(tmp_path / "c"))
    frame = spark.read.parquet(str(tmp_path / "c"))
    small, large = (plan(series.trim_history(frame, 1, broadcast_limit=b)) for b in (None, 1))
    assert "Window" not in small + large
    assert "GreaterThan(Timestamp,ScalarSubquery" in small
    assert "BroadcastHashJoin" in small and "__salt" not in large
    monkeypatch.setattr(lookup.salted_join, "__defaults__", (lookup.SALTS, 3))
    assert "__salt" in plan(series.trim_history(frame, 1, broadcast_limit=1))  # only where a key is heavy


def test_observations_are_sufficient_and_bounded(make):
    frame = make([(1, "NB", v, END) for v in (1, 2, 2, None)] + [(1, "NB", 5, END + timedelta(milliseconds=300))])
    assert rows(series.observations(frame)) == [(1, "NB", END, 4, 10.0, 34.0, 1.0, 5.0)]


def test_future_grid(make):
    ends = series.series_range(make(ticks(1, 2)))
    got = [r["ds"] for r in series.future_grid(ends).orderBy("ds").collect()]
    assert got == [END + timedelta(minutes=15 * i) for i in (1, 2, 3, 4)]


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_running_ticks_take_late_rows_along(make, block_rows):
    minutes = [0, 0, 15, 5, 15, 30, 0, None, 45, 40, 60]
    frame = make(
        [(i, None if m is None else END + timedelta(minutes=m)) for i, m in enumerate(minutes)],
        "seq BIGINT, Timestamp TIMESTAMP_NTZ",
    )
    got = [r["tick"] for r in series.running_ticks(frame, "seq", block_rows=block_rows).orderBy("seq").collect()]
    assert got == [END + timedelta(minutes=m) for m in (0, 0, 15, 15, 15, 30, 30, 30, 45, 45, 60)]
    assert frame.agg(F.count("*")).first()[0] == len(minutes)


def test_running_ticks_keep_rows_without_order_and_sparse_orders(make):
    places = [None, 5, 2**40, -(2**50), 2**62, None, 7, 2**62 - 1]
    frame = make([(p, END + timedelta(minutes=n)) for n, p in enumerate(places)], "seq BIGINT, Timestamp TIMESTAMP_NTZ")
    for sizes in ((1_000_000, 1_000_000), (2**30, 2_000), (2**56, 3)):
        got = series.running_ticks(frame, "seq", "Timestamp", *sizes).collect()
        assert len(got) == len(places) and all(r["tick"] is None for r in got if r["seq"] is None)
        placed = sorted((r for r in got if r["seq"] is not None), key=lambda r: r["seq"])
        assert [r["tick"] for r in placed] == [max(x["Timestamp"] for x in placed[: n + 1]) for n in range(len(placed))]

from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.operators.additive import fit_predict
from curbcount.plans import forecast

from .conftest import at, plan, rows

END = at("2017-06-20 12:00")
STEP = timedelta(minutes=15)
DOUBLE_CAPTURE = schemas.CAPTURE.replace("Vol INT", "Vol DOUBLE")


def wave(day_part):
    return 50 + 20 * np.sin(2 * np.pi * day_part)


def history(values, seg=1, direction="NB", end=END):
    n = len(values)
    return [(seg, direction, None if v is None else float(v), end - STEP * (n - 1 - i)) for i, v in enumerate(values)]


def fitted(make, records, **options):
    return forecast.fit_series(make(records, DOUBLE_CAPTURE), **options)


@pytest.mark.parametrize("days", [1, 3, 7])
def test_line_is_recovered(make, days):
    values = 50 + 0.1 * np.arange(96 * days)
    got = forecast.future(fitted(make, history(values), ranges=(days,))).orderBy("ds").collect()
    assert [r["ds"] for r in got] == [END + STEP * i for i in (1, 2, 3, 4)]
    expected = 50 + 0.1 * (96 * days + np.arange(4))
    assert np.abs([r["yhat"] for r in got] - expected).max() < 1e-6


@pytest.mark.parametrize("days", [3, 7])
def test_daily_wave_is_recovered(make, days):
    values = wave(np.arange(96 * days) / 96)
    got = fitted(make, history(values), ranges=(days,)).orderBy("ds").collect()
    assert np.abs([r["yhat"] for r in got] - wave(np.arange(96 * days + 4) / 96)).max() < 0.01


def test_better_than_seasonal_naive():
    rng, model, naive = np.random.default_rng(7), [], []
    for _ in range(20):
        x = np.arange(676)
        y = 60 + 30 * np.sin(2 * np.pi * (x / 96 + rng.uniform())) + rng.normal(0, 8, x.size)
        seen, days = y[:672], x / 96 + 17000
        got = fit_predict(days[:672], np.ones(672), seen, seen**2, seen, seen, days[672:])
        model.append(np.abs(got - y[672:]).mean())
        naive.append(np.abs(y[576:580] - y[672:]).mean())
    assert np.mean(model) < 0.9 * np.mean(naive)


def test_posterior_mode_against_search():
    """No small step from the found parameters raises the posterior density."""
    from curbcount.operators import additive as a

    rng = np.random.default_rng(3)
    days = np.arange(300) / 96 + 17000
    y = (40 + 10 * np.sin(2 * np.pi * days) + 6 * np.maximum(days - 17001.5, 0) + rng.normal(0, 2, 300)) / 60
    t = (days - days[0]) / (days[-1] - days[0])
    knots, waves = a.times_at(a.knot_ranks(300), t, np.ones(300)), a.seasons(days[-1] - days[0], np.diff(days).min())
    x = a._design(t, days, knots, waves)
    theta = a._most_probable(x.T @ x, x.T @ y, y @ y, 300.0, knots.size)

    def loss(p):
        rss = ((y - x @ p) ** 2).sum()
        rest, changes = p[2 : -knots.size], p[-knots.size :]
        variance = 2 * rss / (300 + np.sqrt(300**2 + 4 * rss / a.NOISE_SCALE**2))
        return (
            150 * np.log(variance) + rss / (2 * variance) + variance / (2 * a.NOISE_SCALE**2)
            + np.abs(changes).sum() / a.CHANGE_SCALE + (p[:2] ** 2).sum() / (2 * a.TREND_SCALE**2)
            + (rest**2).sum() / (2 * a.SEASON_SCALE**2)
        )

    best = loss(theta)
    for _ in range(300):
        assert loss(theta + rng.normal(0, 1, theta.size) * 10.0 ** rng.uniform(-6, -1)) > best - 1e-6
    assert len(knots) == 25 and np.abs(theta[-25:]).max() > 0


def test_ranges_windows_and_bounds(make):
    full = history(np.arange(96 * 8) % 96)
    got = fitted(make, full)
    for days, n in ((7, 672), (3, 288), (1, 96)):
        part = got.filter(F.col("history_days") == days)
        assert forecast.in_sample(part).count() == n and forecast.future(part).count() == 4
        first = part.first()
        assert first["max_history_ds"] == END and first["min_history_ds"] == END - timedelta(days=days)
    assert rows(got.select("kind").distinct()) == [("future",), ("history",)]
    unlimited = fitted(make, full, ranges=(None,))
    assert forecast.in_sample(unlimited).count() == 768 and unlimited.first()["history_days"] is None


def test_future_rows_do_not_depend_on_history_rows(make):
    frame = make(history(np.arange(300) % 50), DOUBLE_CAPTURE)
    lean = forecast.fit_series(frame, include_history=False)
    assert rows(lean) == rows(forecast.future(forecast.fit_series(frame))) and lean.count() == 12


def test_own_function_per_series(make):
    frame = make(history([1, 2, 3]) + history([5], seg=2), DOUBLE_CAPTURE)

    def total(key, points):
        import pandas as pd

        return pd.DataFrame({"SegmentID": [key[0]], "total": [points["sum_y"].sum()]})

    got = forecast.apply_per_series(frame, total, "SegmentID INT, total DOUBLE")
    assert rows(got) == [(1, 6.0), (2, 5.0)]


def test_gap_at_the_start_shortens_the_measured_range(make):
    records = history(np.arange(96))[1:]
    predictions = forecast.forecast(make(records, DOUBLE_CAPTURE), ranges=(1,), keep_days=True)
    first = predictions.first()
    assert first["max_history_ds"] - first["min_history_ds"] == timedelta(days=1) - STEP
    assert first["history_days"] == 1


def test_short_empty_and_constant_series(make):
    records = (
        history([5], seg=1) + history([None, None], seg=2) + history([4, 4, 4], seg=3) + history([1, None, 3], seg=4)
        + [(None, "NB", 1.0, END), (5, None, 1.0, END), (6, "NB", 1.0, None)]
    )
    got = forecast.future(fitted(make, records, ranges=(7, 1)))
    by_segment = {r["SegmentID"]: r["v"] for r in got.groupBy("SegmentID").agg(F.collect_list("yhat").alias("v")).collect()}
    assert sorted(by_segment) == [1, 3, 4]
    assert by_segment[1] == [5.0] * 8 and by_segment[3] == [4.0] * 8 and all(np.isfinite(by_segment[4]))
    assert fitted(make, history([None], seg=2)).count() == 0


def test_null_volumes_still_count_as_times(make):
    """The end of history is the last time, also if its volume is missing."""
    got = forecast.future(fitted(make, history([1, 2, 3, None]), ranges=(1,)))
    assert got.agg(F.min("ds")).first()[0] == END + STEP


def test_repeated_observations_weigh_like_rows(make):
    values = np.where(np.arange(300) < 150, 20.0, 40.0) + np.arange(300) % 7
    once = history(values)
    split = [(s, d, v + e, t) for s, d, v, t in once for e in (-1.0, 1.0)]
    days = np.arange(300) / 96 + 17000
    rows_days, rows_y = np.repeat(days, 2), (values[:, None] + [-1.0, 1.0]).ravel()
    one = np.ones(600)
    by_row = fit_predict(rows_days, one, rows_y, rows_y**2, rows_y, rows_y, days)
    collapsed = fit_predict(days, one[:300] * 2, 2 * values, (values - 1) ** 2 + (values + 1) ** 2, values - 1, values + 1, days)
    assert np.abs(by_row - collapsed).max() < 1e-6
    assert fitted(make, split, ranges=(7,)).count() == 304


@pytest.mark.parametrize("partitions,limit", [(1, None), (7, None), (3, 1)])
def test_result_does_not_depend_on_partitions(make, partitions, limit):
    rng = np.random.default_rng(5)
    records = [r for s in range(4) for r in history(rng.integers(0, 50, 200), seg=s)]
    frame = make(records, DOUBLE_CAPTURE)
    wanted = rows(forecast.future(forecast.fit_series(frame)).withColumn("yhat", F.round("yhat", 9)))
    moved = forecast.fit_series(frame.repartition(5), partitions=partitions, broadcast_limit=limit)
    assert rows(forecast.future(moved).withColumn("yhat", F.round("yhat", 9))) == wanted


def test_series_that_span_batches(spark, make):
    """Arrow batches may end anywhere inside a series."""
    rng = np.random.default_rng(9)
    lengths = (1, 3, 40, 2, 150, 5)
    frame = make([r for s, n in enumerate(lengths) for r in history(rng.integers(0, 50, n), seg=s)], DOUBLE_CAPTURE)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, results = spark.conf.get(size), []
    try:
        for batch in (1, 2, 7, 1000):
            spark.conf.set(size, batch)
            fitted_rows = forecast.fit_series(frame, partitions=2).withColumn("yhat", F.round("yhat", 9))
            results.append(rows(fitted_rows))
    finally:
        spark.conf.set(size, before)
    assert all(r == results[0] for r in results)
    # one day holds 96 of the 150 rows; a series has four future rows per range
    assert len(results[0]) == sum(min(n, cap) + 4 for n in lengths for cap in (672, 288, 96))


def test_prediction_layout_and_stamp(make):
    stamp = F.lit("2017-06-20 12:01:00").cast("timestamp_ntz")
    got = forecast.forecast(make(history(range(100)), DOUBLE_CAPTURE), ranges=(1,), run_time=stamp)
    assert got.columns == schemas.resolve(schemas.PREDICTION).names
    assert rows(got.select("prediction_ds").distinct()) == [(at("2017-06-20 12:01"),)]
    now = forecast.forecast(make(history(range(100)), DOUBLE_CAPTURE), ranges=(1,))
    assert now.select("prediction_ds").distinct().count() == 1
    with pytest.raises(ValueError):
        forecast.fit_series(now)


def test_line_model_and_seasonal_naive(make):
    frame = make(history(10 + 0.5 * np.arange(20)) + history([3], seg=2), DOUBLE_CAPTURE)
    got = {(r["SegmentID"], r["ds"]): r["yhat"] for r in forecast.trend_forecast(frame).collect()}
    assert got[(1, END + STEP)] == pytest.approx(20.0, abs=1e-6) and got[(2, END + STEP)] == 3.0
    naive = forecast.seasonal_naive(frame, (1,)).filter("SegmentID = 2").first()
    assert naive["Timestamp"] == END + timedelta(days=1) and naive["prediction_vol"] == 3.0
    assert naive["max_history_ds"] - naive["min_history_ds"] == timedelta(days=1)


def test_noise_variance_reaches_its_fixed_point(monkeypatch):
    """Bracketing after a few plain rounds ends where very many plain rounds end."""
    from curbcount.operators import additive

    rng = np.random.default_rng(3)
    for _ in range(10):
        days = np.sort(rng.choice(700, 60, replace=False)) / 96.0
        y = np.abs(rng.normal(20, 15, 60)).round()
        stats = (np.ones(60), y, y * y, y, y)
        at = days[-1] + np.arange(1, 5) / 96.0
        monkeypatch.setattr(additive, "PLAIN_ROUNDS", 20_000)
        slow = additive.fit_predict(days, *stats, at)
        monkeypatch.setattr(additive, "PLAIN_ROUNDS", 2)
        assert np.allclose(additive.fit_predict(days, *stats, at), slow, atol=2e-2)


def test_own_function_gets_whole_series_in_order_of_time(make):
    """Many of them share a batch of Arrow, and adaptive execution merges no tasks; results may differ in type."""
    records = [r for s in range(40) for r in reversed(history([10 + s, None, 30 + s], seg=s))]

    def last(key, points):
        import pandas as pd

        assert points["ds"].is_monotonic_increasing and list(points.index) == [0, 1, 2]
        return pd.DataFrame({"last": [points["sum_y"].iloc[-1] if key[0] % 2 else None], "SegmentID": [key[0]]})

    got = forecast.apply_per_series(make(records, DOUBLE_CAPTURE), last, "SegmentID INT, last DOUBLE")
    assert sorted(tuple(r) for r in got.collect()) == [(s, 30.0 + s if s % 2 else None) for s in range(40)]
    assert "FlatMapGroupsInPandas" not in plan(got) and "REPARTITION_BY_NUM" in plan(got)


def test_own_function_may_return_nothing_but_no_other_columns(make):
    frame = make(history([1]) + history([2], seg=2), DOUBLE_CAPTURE)

    def second(key, points):
        import pandas as pd

        return pd.DataFrame({"SegmentID": [key[0]]}) if key[0] == 2 else pd.DataFrame()

    assert rows(forecast.apply_per_series(frame, second, "SegmentID INT")) == [(2,)]
    with pytest.raises(Exception, match="must return the columns"):
        forecast.apply_per_series(frame, lambda key, points: points[["n"]], "SegmentID INT").collect()

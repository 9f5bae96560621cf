"""Fits over all history in blocks of time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.operators import additive
from curbcount.plans import forecast, long_fit

from .conftest import rows


def values(frame):
    return {tuple(r[k] for k in (*schemas.SERIES_KEYS, "ds", "min_history_ds", "max_history_ds")): r["yhat"] for r in frame.collect()}


def same(spark, captures, **options):
    got = values(long_fit.forecast_all(captures, **options))
    want = values(forecast.future(forecast.fit_series(captures, (None,), include_history=False)))
    assert got.keys() == want.keys() and got
    return max(abs(got[k] - want[k]) / max(1.0, abs(want[k])) for k in want)


def long_series(spark, rows_of, step=1):
    """Waves, a bend and noise, a value every ``step`` seconds."""
    i = F.col("id")
    wave = 30 + 10 * F.sin(i * (step * 2 * np.pi / 86_400)) + F.greatest(F.lit(0), i - rows_of // 3) * (20.0 / rows_of) + F.pmod(F.xxhash64("id"), F.lit(7))
    time = F.timestamp_add("SECOND", (i * step).cast("int"), F.lit("2017-01-01").cast("timestamp_ntz"))
    return spark.range(rows_of).select(F.lit(1).alias("SegmentID"), F.lit("NB").alias("Direction"), wave.cast("int").alias("Vol"), time.alias("Timestamp"))


def test_a_long_series_in_blocks_equals_the_fit_in_one_task(spark):
    assert same(spark, long_series(spark, 400_000), block_seconds=20_000) < 1e-6


def test_years_of_quarter_hours_with_all_seasons(spark):
    assert same(spark, long_series(spark, 80_000, 900), block_seconds=30 * 86_400) < 1e-6


def test_blocks_are_bounded_however_long_the_series(spark, monkeypatch):
    seen = []
    plain = long_fit.materialise

    def watched(frame, label):
        out = plain(frame, label)
        if label == "blocks":
            seen.append(out.agg(F.max(F.size("points")), F.count(F.lit(1))).first())
        return out

    monkeypatch.setattr(long_fit, "materialise", watched)
    long_fit.forecast_all(long_series(spark, 300_000), block_seconds=10_000).count()
    assert seen[0][0] <= 10_000 and seen[0][1] >= 30


def test_gaps_nulls_constants_and_single_observations(spark, make):
    from datetime import timedelta

    from .conftest import at

    start = at("2017-06-01 00:00")
    data = [(1, "NB", (i * 7) % 13, start + timedelta(hours=i)) for i in range(300) if i % 50 < 40]
    data += [(1, "NB", 3, start + timedelta(hours=5)), (1, "NB", None, start + timedelta(hours=400)), (1, "NB", None, start - timedelta(hours=9))]
    data += [(2, "NB", 5, start + timedelta(hours=i)) for i in range(100)] + [(3, "NB", 8, start), (4, "NB", None, start), (None, "NB", 1, start), (5, "NB", 1, None)]
    data += [(6, "NB", i, start + timedelta(days=20 * i)) for i in range(4)]
    captures = make(data)
    assert same(spark, captures, block_seconds=86_400) < 1e-6
    assert same(spark, captures, block_seconds=10**9) < 1e-6
    assert long_fit.forecast_all(captures.limit(0)).count() == 0


def test_a_forecast_without_limit_goes_by_blocks(spark, make, monkeypatch):
    from datetime import timedelta

    from .conftest import at

    captures = make([(1, "NB", (i * 7) % 13, at("2017-06-01 00:00") + timedelta(minutes=15 * i)) for i in range(800)])
    run = F.lit("2017-07-01").cast("timestamp_ntz")
    both = forecast.forecast(captures, (7, None), run_time=run, keep_days=True)
    old = forecast.as_predictions(forecast.future(forecast.fit_series(captures, (7, None), include_history=False)), run, True)
    order = [c for c in both.columns if c != "prediction_vol"]
    assert rows(both.select(*order)) == rows(old.select(*order))
    assert [round(r[3], 5) for r in rows(both)] == [round(r[3], 5) for r in rows(old)]


@pytest.mark.parametrize("seed", range(6))
def test_values_reach_the_optimum_of_the_published_objective(seed):
    """The posterior itself, written out here on its own, cannot be bettered by moving any parameter a little, nor by
    an independent descent (coordinates one by one) from the result."""
    rng = np.random.default_rng(seed)
    days = 17_000 + np.sort(rng.choice(20 * 96, 500, replace=False)) / 96
    y = 40 + 0.5 * (days - 17_000) + 8 * np.sin(2 * np.pi * days) + rng.normal(0, 2, 500) + 15 * (days > 17_010)
    scale, start, length = np.abs(y).max(), days[0], days[-1] - days[0]
    t = (days - start) / length
    knots = t[np.round(np.linspace(0, 399, 26)).astype(int)[1:]]
    waves = [np.sin(2 * np.pi * days * k / p) if f else np.cos(2 * np.pi * days * k / p) for p, n in ((7.0, 3), (1.0, 4)) for f in (1, 0) for k in range(1, n + 1)]
    x = np.column_stack([t, np.ones(500), *waves, *(np.maximum(t - s, 0) for s in knots)])

    def least(theta):
        """Minus the log posterior, at the noise that suits best (a grid, refined)."""
        rest = ((y / scale - x @ theta) ** 2).sum()
        prior = theta[0] ** 2 / 50 + theta[1] ** 2 / 50 + (theta[2:16] ** 2).sum() / 200 + np.abs(theta[16:]).sum() / 0.05
        noise = np.geomspace(1e-4, 1, 4000)
        return (rest / (2 * noise**2) + 500 * np.log(noise) + noise**2 / 0.5).min() + prior

    one = np.ones(500)
    got = additive.fit_predict(days, one, y, y**2, y, y, days)
    theta = np.linalg.lstsq(x, got / scale, rcond=None)[0]
    assert np.allclose(x @ theta * scale, got, atol=1e-6)
    gram, moment = additive.sums(days, one, y / scale, start, length, knots, [(7.0, 3), (1.0, 4)])
    theta = additive.solve(gram, moment, (y**2).sum() / scale**2, 500.0, 25)
    best = least(theta)
    assert np.allclose(additive.fitted(theta, days, start, length, knots, [(7.0, 3), (1.0, 4)]) * scale, got, atol=1e-6)
    for k in range(len(theta)):
        for step in (1e-2, 1e-3, 1e-4):
            for sign in (-1, 1):
                moved = theta.copy()
                moved[k] += sign * step
                assert least(moved) >= best - 1e-4
    for _ in range(200):
        moved = theta + rng.normal(0, 1e-3, len(theta)) * (rng.random(len(theta)) < 0.3)
        assert least(moved) >= best - 1e-4

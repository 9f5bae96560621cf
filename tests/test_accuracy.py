from pyspark.sql import functions as F

from curbcount import schemas
from curbcount.plans import accuracy

from .conftest import at, rows

END = at("2017-06-20 12:00")


def pred(ts, vol, start="2017-06-13 12:00", run="2017-06-20 12:01", seg=1):
    return (seg, "NB", at(ts), vol, at(start), END, at(run))


CAPTURES = [
    (1, "NB", 10, at("2017-06-20 12:15")), (1, "NB", 0, at("2017-06-20 12:30")), (1, "SB", 10, at("2017-06-20 12:15")),
    (2, "NB", 10, at("2017-06-20 13:00")),
]


def table(make, predictions, captures=CAPTURES):
    return accuracy.accuracy(make(captures), make(predictions, schemas.PREDICTION))


def test_errors_zero_volume_and_horizon(make):
    got = [tuple(r) for r in table(make, [pred("2017-06-20 12:15", 8.0), pred("2017-06-20 12:30", 3.0)]).collect()]
    assert got == [(7.0, 15.0, 2.0, 0.2, 1, 0), (7.0, 30.0, 3.0, None, 1, 1)]
    mixed = CAPTURES + [(2, "NB", 4, at("2017-06-20 12:30"))]
    both = table(make, [pred("2017-06-20 12:30", 3.0), pred("2017-06-20 12:30", 3.0, seg=2)], mixed)
    # The zero volume counts for MAE, not for MAPE.
    assert [tuple(r) for r in both.collect()] == [(7.0, 30.0, 2.0, 0.25, 2, 1)]


def test_repeated_runs_and_captures_count_once(make):
    again = [pred("2017-06-20 12:15", 8.0), pred("2017-06-20 12:15", 8.0, run="2017-06-20 12:03")]
    got = [tuple(r) for r in table(make, again, CAPTURES * 2).collect()]
    assert got == [(7.0, 15.0, 2.0, 0.2, 1, 0)]
    changed = again + [pred("2017-06-20 12:15", 6.0, run="2017-06-20 12:05")]
    assert table(make, changed).first()["pairs"] == 2


def test_dropping_duplicates_first_equals_dropping_them_last(make):
    captures = make(CAPTURES * 2 + [(1, "NB", 11, at("2017-06-20 12:15"))])
    predictions = accuracy.forecast_axes(make(
        [pred("2017-06-20 12:15", v, run=r) for v in (8.0, 9.0) for r in ("2017-06-20 12:01", "2017-06-20 12:03")],
        schemas.PREDICTION,
    ))
    late = captures.join(predictions, schemas.CAPTURE_KEYS).withColumns(
        {"AE": F.abs(F.col("Vol") - F.col("prediction_vol"))}
    ).withColumn("APE", F.try_divide("AE", "Vol")).drop("prediction_ds").distinct()
    early = accuracy.errors(captures, predictions)
    assert rows(early.select(*late.columns)) == rows(late) and early.count() == 4


def test_only_complete_histories_count(make):
    whole = [pred("2017-06-20 12:15", 8.0, start=s) for s in ("2017-06-13 12:00", "2017-06-17 12:00", "2017-06-19 12:00")]
    gap = pred("2017-06-20 12:15", 8.0, start="2017-06-13 12:15")
    assert [r["range_days"] for r in table(make, whole + [gap]).collect()] == [1.0, 3.0, 7.0]


def test_integer_axes_and_display(make, capsys):
    result = table(make, [pred("2017-06-20 12:15", 8.0)])
    assert [tuple(r)[:2] for r in accuracy.integer_axes(result).collect()] == [(7, 15)]
    accuracy.show_accuracy(result)
    assert "range_days" in capsys.readouterr().out

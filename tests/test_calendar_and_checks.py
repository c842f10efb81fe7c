"""Day axes, dense views, and the checks on time and grid."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from conftest import day, grid_frame, to_spark, weather
from heatgrid.operators import calendar, checks
from heatgrid.operators.daily import daily_metrics


def days(spark, *texts):
    return spark.createDataFrame([(day(t),) for t in texts], "day date")


def test_axis_spans_whole_years_and_leap_days(spark):
    rows = calendar.day_axis(spark, 1999, 2000).orderBy("position").collect()
    assert len(rows) == 731
    assert (rows[0].day, rows[-1].day) == (dt.date(1999, 1, 1), dt.date(2000, 12, 31))
    assert [row.position for row in rows] == list(range(731))
    assert (rows[364].day, rows[365].day) == (dt.date(1999, 12, 31), dt.date(2000, 1, 1))


def test_reversed_years_are_an_error(spark):
    with pytest.raises(ValueError, match="2000.*2001"):
        calendar.day_axis(spark, 2001, 2000)


def test_days_of_years(spark):
    years = spark.createDataFrame([(1999,), (2000,), (1999,)], "year int")
    assert calendar.days_of_years(years).count() == 731


def test_position_of_days(spark):
    located = calendar.locate_days(days(spark, "1999-01-11", "2000-01-01", "1998-12-31"), 1999, 2000)
    assert {str(r.day): r.position for r in located.collect()} == {
        "1999-01-11": 10, "2000-01-01": 365, "1998-12-31": None,
    }


def test_contiguous_days(spark):
    assert calendar.check_contiguous_days(days(spark, "2000-07-01", "2000-07-02"), 2000, 2000) == (182, 184)
    with pytest.raises(ValueError, match="outside"):
        calendar.check_contiguous_days(days(spark, "1999-07-01"), 2000, 2000)
    with pytest.raises(ValueError, match="outside"):
        calendar.check_contiguous_days(days(spark, "2000-12-31", "2001-01-01"), 2000, 2000)
    with pytest.raises(ValueError, match="not contiguous"):
        calendar.check_contiguous_days(days(spark, "2000-07-01", "2000-07-03"), 2000, 2000)


def test_dense_view(spark):
    daily = daily_metrics(to_spark(spark, weather(days=2)), ["humidex"])
    cells = spark.createDataFrame(grid_frame(2, 3))
    dense = calendar.dense_daily(daily, cells, 2000, 2000).toPandas()
    assert len(dense) == 366 * 6
    present = dense.humidex_valid_hours == 24
    assert present.sum() == 8 and set(dense.humidex_valid_hours) == {0, 24}
    assert dense.humidex_mean.notna().equals(present)
    assert set(dense[present].day.astype(str)) == {"2000-07-01", "2000-07-02"}


def test_hourly_coverage(spark):
    frame = weather(days=2)
    facts = checks.hourly_coverage(to_spark(spark, frame)).first()
    assert facts.asDict() == {
        "first_ts": dt.datetime(2000, 7, 1), "starts_at_midnight": True, "hours": 48,
        "whole_days": True, "n_rows": 192, "off_hour_rows": 0, "repeated_rows": 0,
    }
    odd = pd.concat([frame[frame.ts >= "2000-07-01 01:00"], frame.iloc[5:7]], ignore_index=True)
    odd.loc[odd.index[-1], "ts"] += pd.Timedelta(minutes=7)
    facts = checks.hourly_coverage(to_spark(spark, odd)).first()
    assert not facts.starts_at_midnight and not facts.whole_days
    assert (facts.hours, facts.off_hour_rows, facts.repeated_rows) == (47, 1, 2)


def checked(spark, frame, year=2000):
    checks.check_year(daily_metrics(to_spark(spark, frame), ["temperature"], with_hours=True), year)


def test_a_year_must_be_sound(spark):
    frame = weather(days=3, start="2000-03-04")
    checked(spark, frame)
    checked(spark, frame[(frame.lat_idx > 0) | (frame.ts.dt.hour != 5)])  # one cell has the hour
    for wrong, message in (
        (frame[frame.ts < "2000-03-06 21:00"], "24-hour days"),
        (frame[(frame.ts >= "2000-03-04 03:00") & (frame.ts < "2000-03-06 03:00")], "00Z"),
        (frame[frame.ts.dt.day != 5], "not contiguous"),
        (pd.concat([frame, frame.iloc[7:9]]), "more than one row"),
        (weather(days=2, start="1999-12-31"), "1 of 2 days are outside 2000"),
    ):
        with pytest.raises(ValueError, match=message):
            checked(spark, wrong)
    nothing = daily_metrics(to_spark(spark, frame).limit(0), ["temperature"], with_hours=True)
    assert checks.check_year(nothing, 2000) is None
    counts = checks.check_year(daily_metrics(to_spark(spark, frame), ["temperature"], with_hours=True), 2000, ["temperature"])
    assert set(counts) == {"temperature"} and counts["temperature"][0] <= counts["temperature"][1]


def test_axis_differences(spark):
    got = checks.axis_differences(days(spark, "2000-01-01", "2000-01-02"), days(spark, "2000-01-02", "2000-01-03"), ["day"])
    assert {(str(r.day), r.problem) for r in got.collect()} == {
        ("2000-01-01", "missing"), ("2000-01-03", "unexpected"),
    }


def test_grids_are_compared_exactly(spark):
    grid = grid_frame(3, 4)
    checks.check_same_grid(spark.createDataFrame(grid), spark.createDataFrame(grid))
    moved = grid.assign(latitude=np.where(grid.lat_idx == 2, grid.latitude + 1e-9, grid.latitude))
    with pytest.raises(ValueError, match="latitude 2"):
        checks.check_same_grid(spark.createDataFrame(grid), spark.createDataFrame(moved))
    with pytest.raises(ValueError, match="longitude 3"):
        checks.check_same_grid(
            spark.createDataFrame(grid), spark.createDataFrame(grid[grid.lon_idx < 3])
        )

"""Further day reducers, metrics as array functions, and hours in several deliveries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import to_spark, weather
from heatgrid.functions.metrics import METRICS, MetricSpec, derive_hourly, required_variables
from heatgrid.operators import reducers
from heatgrid.operators.daily import daily_metrics, to_long
from heatgrid.operators.region import Extent
from heatgrid.sources.daily_store import read_daily, read_manifest
from heatgrid.sources.hourly import select_hourly
from heatgrid.sources.late_hours import deliver_hours

KEYS = ["lat_idx", "lon_idx", "day"]


def runs_plainly(values, threshold):
    best = now = 0
    for value in values:
        now = now + 1 if value > threshold else 0
        best = max(best, now)
    return best


def with_gaps(seed=3):
    frame = weather(days=3, rows=2, cols=3, seed=seed)
    rng = np.random.default_rng(seed)
    frame.loc[rng.random(len(frame)) < 0.08, "tmp_k"] = np.nan
    frame["tmp_k"] = frame.tmp_k.round(0)  # ties
    return frame.sample(frac=1.0, random_state=1)


def test_reducers_equal_a_plain_loop(spark):
    frame = with_gaps()
    more = {"temperature": {"peak": reducers.HOUR_OF_MAX, "hot": reducers.longest_run_above(90.0), "always": reducers.longest_run_above(-500.0)}}
    daily = daily_metrics(to_spark(spark, frame), ["temperature"], min_valid_hours=1, reducers=more)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan
    frame = frame.assign(f=(frame.tmp_k - 273.15) * 1.8 + 32.0, day=frame.ts.dt.date)
    got = {tuple(row[k] for k in KEYS): row for row in daily.collect()}
    for key, group in frame.sort_values("ts").groupby(KEYS):
        row = got[key]
        by_hour = group.set_index(group.ts.dt.hour).f
        assert row.temperature_peak == by_hour.idxmax()
        assert row.temperature_hot == runs_plainly(by_hour.reindex(range(24)), 90.0)
        assert row.temperature_always == runs_plainly(by_hour.reindex(range(24)), -500.0)


def test_reducers_follow_the_coverage_rule(spark):
    frame = weather(days=2, rows=1, cols=1)
    frame.loc[5, "tmp_k"] = np.nan
    more = {"temperature": {"peak": reducers.HOUR_OF_MAX, "hot": reducers.longest_run_above(500.0)}}
    first, second = daily_metrics(to_spark(spark, frame), ["temperature"], reducers=more).orderBy("day").collect()
    assert first.temperature_peak is None and first.temperature_hot is None and first.temperature_valid_hours == 23
    assert second.temperature_peak is not None and second.temperature_hot == 0


OWN = MetricSpec(("tc", "rh_pct"), None, array=lambda t, h: np.where(h > 99.0, np.inf, t * 2.0 + h))


def test_an_array_metric_equals_its_column(spark):
    column = MetricSpec(OWN.needs, lambda: F.when(F.col("rh_pct") <= 99.0, F.col("tc") * 2.0 + F.col("rh_pct")))
    registry = {**METRICS, "as_array": OWN, "as_column": column, "tc": MetricSpec(("tc",), None, array=lambda t: t + 1.0)}
    names = ["as_array", "temperature", "as_column", "tc"]
    hourly = to_spark(spark, with_gaps())
    assert required_variables(names, registry) == ["pres_pa", "spfh", "tmp_k"]
    derived = derive_hourly(hourly, names, registry)
    assert derived.columns[-4:] == names
    rows = derived.toPandas()
    np.testing.assert_allclose(rows.as_array, rows.as_column)
    np.testing.assert_allclose((rows.tc - 1.0) * 1.8 + 32.0, rows.temperature)
    assert rows.as_array.isna().any()
    daily = daily_metrics(hourly, names, min_valid_hours=1, registry=registry).toPandas()
    for statistic in ("min", "mean", "max", "valid_hours"):
        np.testing.assert_allclose(daily[f"as_array_{statistic}"].astype(float), daily[f"as_column_{statistic}"].astype(float))


def test_an_array_of_another_length_is_an_error(spark):
    registry = {"short": MetricSpec(("tmp_k",), None, array=lambda t: t[:-1])}
    with pytest.raises(Exception, match="short gave an array of shape"):
        derive_hourly(to_spark(spark, weather(days=1)), ["short"], registry).collect()


def test_filters_reach_the_scan_below_an_array_metric(spark, tmp_path):
    from heatgrid.sources.hourly import scan_hourly, write_hourly

    write_hourly(to_spark(spark, weather(days=1, rows=4, cols=4)), str(tmp_path / "h"), (2, 2))
    registry = {"own": OWN}
    chosen = select_hourly(scan_hourly(spark, str(tmp_path / "h")), [2000], ["own"], Extent(0, 2, 0, 2), registry=registry)
    plan = daily_metrics(chosen.drop("tile"), ["own"], registry=registry)._jdf.queryExecution().executedPlan().toString()
    assert "u10" not in plan and "LessThan(lat_idx,2)" in plan


# --- deliveries ------------------------------------------------------------------------

NAMES = ["humidex", "temperature"]


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


def rows(df):
    return sorted(map(tuple, df.select("metric", "day", "lat_idx", "lon_idx", F.round("min", 3), F.round("mean", 3), F.round("max", 3), "valid_hours").collect()), key=str)


def test_two_halves_of_a_day_equal_the_whole(spark, root):
    hourly = to_spark(spark, weather(days=3, start="1999-12-30", rows=2, cols=3))
    evening = F.hour("ts") >= 13
    assert deliver_hours(spark, root, hourly.where(evening), NAMES) == [1999, 2000]
    half = read_daily(spark, root)
    assert half.count() == 2 * 18 and half.where("min IS NOT NULL").isEmpty()
    assert deliver_hours(spark, root, hourly.where(~evening), NAMES) == [1999, 2000]
    assert rows(read_daily(spark, root)) == rows(to_long(daily_metrics(hourly, NAMES), NAMES))
    assert read_manifest(spark, root).count() == 4


def test_a_delivery_touches_its_own_years_only(spark, root):
    hourly = to_spark(spark, weather(days=2, start="1999-12-31", rows=2, cols=2))
    deliver_hours(spark, root, hourly.where("year = 1999"), NAMES)
    before = {row[0] for row in read_daily(spark, root).select(F.input_file_name()).distinct().collect()}
    deliver_hours(spark, root, hourly.where("year = 2000"), NAMES)
    after = {row[0] for row in read_daily(spark, root, years=[1999]).select(F.input_file_name()).distinct().collect()}
    assert before == after
    assert read_daily(spark, root).count() == 16


def test_an_hour_delivered_twice_changes_nothing(spark, root):
    hourly = to_spark(spark, weather(days=1, rows=2, cols=2))
    deliver_hours(spark, root, hourly.where("hour(ts) < 12"), NAMES)
    before = rows(read_daily(spark, root))
    again = hourly.where("hour(ts) = 11 AND lat_idx = 1 OR hour(ts) > 11")
    with pytest.raises(ValueError, match="more than one row for the same hour, 2 rows"):
        deliver_hours(spark, root, again, NAMES)
    assert rows(read_daily(spark, root)) == before
    twice = hourly.where("hour(ts) = 13").unionByName(hourly.where("hour(ts) = 13 AND lon_idx = 0"))
    with pytest.raises(ValueError, match="more than one row for the same hour"):
        deliver_hours(spark, root, twice, NAMES)
    assert deliver_hours(spark, root, hourly.where("hour(ts) >= 12"), NAMES) == [2000]
    assert rows(read_daily(spark, root)) == rows(to_long(daily_metrics(hourly, NAMES), NAMES))


def test_an_empty_delivery_does_nothing(spark, root):
    assert deliver_hours(spark, root, to_spark(spark, weather(days=1)).where("false"), NAMES) == []
    assert read_daily(spark, root).count() == 0

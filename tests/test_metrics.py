"""Indices against published values, the wet-bulb refinement, the registry."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import to_spark, weather
from heatgrid.functions import heat_stress as heat
from heatgrid.functions.metrics import (
    METRICS,
    MetricSpec,
    check_metrics,
    derive_hourly,
    required_variables,
    select_metrics,
)
from test_moist_air import evaluate


# Rows of the National Weather Service heat index chart, temperature in Fahrenheit by
# relative humidity in percent.
CHART = {
    45.0: {82: 82, 88: 89, 92: 96, 98: 109, 106: 130},
    60.0: {82: 84, 88: 95, 92: 105, 98: 123},
    75.0: {84: 92, 90: 109},
}


def test_heat_index_chart(spark):
    for rh, row in CHART.items():
        for t, expected in row.items():
            assert evaluate(spark, heat.heat_index, float(t), rh) == pytest.approx(expected, abs=1.3), (t, rh)


def published_heat_index(t: float, rh: float) -> float:
    """The index as the National Weather Service publishes it, step by step; coefficients are fixed values."""
    simple = 0.5 * (t + 61.0 + (t - 68.0) * 1.2 + rh * 0.094)
    if (simple + t) / 2 < 80:
        return simple
    full = (
        -42.379 + 2.04901523 * t + 10.14333127 * rh - 0.22475541 * t * rh - 0.00683783 * t * t
        - 0.05481717 * rh * rh + 0.00122874 * t * t * rh + 0.00085282 * t * rh * rh - 0.00000199 * t * t * rh * rh
    )
    if rh < 13 and 80 <= t <= 112:
        return full - (13 - rh) / 4 * math.sqrt((17 - abs(t - 95)) / 17)
    if rh > 85 and 80 <= t <= 87:
        return full + (rh - 85) / 10 * (87 - t) / 5
    return full


def test_heat_index_is_the_published_one_on_both_sides_of_every_threshold(spark):
    points = [(t, rh) for t in (61.3, 78.6, 79.6, 79.99, 80.01, 83.2, 86.9, 87.1, 101.7, 111.9, 112.1) for rh in (0.0, 4.4, 12.9, 13.1, 33.0, 84.9, 85.1, 98.6)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, a double, b double")
    got = [r[0] for r in df.orderBy("i").select(heat.heat_index(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([published_heat_index(*p) for p in points], abs=1e-8)


@pytest.mark.parametrize("t, rh", [(None, 71.0), (88.0, None), (None, None)])
def test_heat_index_null(spark, t, rh):
    assert evaluate(spark, heat.heat_index, t, rh) is None


def test_closed_forms(spark):
    """The formulas by hand: t + 0.33 e - 0.7 v - 4, t + 5/9 (e - 10) and 0.567 t + 0.393 e + 3.94."""
    for t, e, v in ((-4.0, 2.0, 11.0), (17.5, 14.2, 0.0), (33.0, 38.6, 3.3)):
        assert evaluate(spark, heat.apparent_temperature, t, e, v) == pytest.approx(t + 0.33 * e - 0.7 * v - 4)
        assert evaluate(spark, heat.humidex, t, e) == pytest.approx(t + (e - 10) * 5 / 9)
        assert evaluate(spark, heat.simplified_wbgt, t, e) == pytest.approx(0.567 * t + 0.393 * e + 3.94)


def humidity_at(fraction: float, t: float, p: float) -> float:
    e = fraction * 6.1078 * math.exp(17.27 * t / (t + 237.3))
    return 0.622 * e / (p - 0.378 * e)


def wet_bulb(spark, rows, **options):
    df = spark.createDataFrame(rows, "tc double, spfh double, p_hpa double")
    return [r.wet_bulb_c for r in heat.with_wet_bulb(df, **options).collect()]


def test_wet_bulb_published_and_saturated(spark):
    p = 1013.25
    rows = [(20.0, humidity_at(0.5, 20.0, p), p)]
    rows += [(t, humidity_at(1.0, t, p), p) for t in (-7.0, 3.5, 16.2, 38.0)]
    rows += [(31.0, humidity_at(1.001, 31.0, p), p), (31.0, 0.0, p)]
    half, *saturated, above, dry = wet_bulb(spark, rows)
    assert half == pytest.approx(13.7, abs=0.7)  # fixed value: Stull (2011)
    assert saturated == pytest.approx([-7.0, 3.5, 16.2, 38.0], abs=1e-6)
    assert above == 31.0
    assert -9.0 <= dry < 31.0


def test_wet_bulb_rises_with_humidity(spark):
    rows = [(36.5, 0.0013 * i, 870.0) for i in range(25)]
    values = wet_bulb(spark, rows)
    assert values == sorted(values) and max(values) <= 36.5


def test_wet_bulb_null_inputs(spark):
    rows = [(None, 0.01, 1013.25), (25.0, None, 1013.25), (25.0, 0.01, None), (None, None, None)]
    assert wet_bulb(spark, rows) == [None] * 4


def test_wet_bulb_can_be_filtered(spark):
    """The optimizer must not substitute the passes into each other."""
    df = heat.with_wet_bulb(
        spark.range(40).select(
            F.col("id").cast("double").alias("tc"), F.lit(0.005).alias("spfh"), F.lit(1000.0).alias("p_hpa")
        )
    )
    warm = df.where(F.col("wet_bulb_c") > 15)
    assert 0 < warm.count() < 40
    assert len(warm._jdf.queryExecution().optimizedPlan().toString()) < 30_000


def domain() -> pd.DataFrame:
    t, q, p = np.meshgrid(
        np.linspace(-60, 60, 81), np.linspace(0, 0.05, 41), np.linspace(500, 1100, 14), indexing="ij"
    )
    return pd.DataFrame({"tc": t.ravel(), "spfh": q.ravel(), "p_hpa": p.ravel()})


def bisected(frame: pd.DataFrame) -> np.ndarray:
    """The wet bulb by bisection of the energy balance between T - 40 and T."""
    t, q, p = (frame[name].to_numpy() for name in ("tc", "spfh", "p_hpa"))
    low, high = t - 40.0, t.copy()
    for _ in range(60):
        w = (low + high) / 2
        e = 6.1078 * np.exp(17.27 * w / (w + 237.3))
        balance = 0.622 * e / (p - 0.378 * e) - q - (1005.7 + 869.3 * q) / (2.501e6 - 2370 * w) * (t - w)
        low, high = np.where(balance < 0, w, low), np.where(balance < 0, high, w)
    return (low + high) / 2


def test_wet_bulb_solves_the_balance_over_the_whole_domain(spark):
    frame = domain()
    result = heat.with_wet_bulb(spark.createDataFrame(frame)).toPandas()
    assert np.abs(result.wet_bulb_c.to_numpy() - bisected(result)).max() < 1e-9


def test_finite_inputs_give_finite_metrics(spark):
    frame = domain().iloc[::3]
    frame = pd.DataFrame(
        {
            "tmp_k": frame.tc + 273.15, "spfh": frame.spfh, "pres_pa": frame.p_hpa * 100,
            "u10": 3.0, "v10": -4.0, "ts": pd.Timestamp("2000-07-01"),
        }
    )
    derived = derive_hourly(spark.createDataFrame(frame), sorted(METRICS))
    wrong = [F.count_if(F.col(m).isNull() | ~(F.abs(m) < float("inf"))).alias(m) for m in METRICS]
    assert set(derived.agg(*wrong).first()) == {0}


def test_required_variables():
    assert required_variables(["temperature"]) == ["tmp_k"]
    assert required_variables(["specific_humidity"]) == ["spfh"]
    for name in ("heat_index", "humidex", "simplified_wbgt", "wet_bulb_temperature", "relative_humidity"):
        assert required_variables([name]) == ["pres_pa", "spfh", "tmp_k"]
    assert required_variables(["apparent_temperature"]) == ["pres_pa", "spfh", "tmp_k", "u10", "v10"]
    assert required_variables(["temperature", "specific_humidity"]) == ["spfh", "tmp_k"]


def test_metric_names():
    assert select_metrics("all") == sorted(METRICS) and len(METRICS) == 8
    assert select_metrics(["humidex", "heat_index"]) == ["humidex", "heat_index"]
    with pytest.raises(ValueError, match="nonsense.*heat_index"):
        check_metrics(["humidex", "nonsense"])


@pytest.mark.parametrize("metric", sorted(METRICS))
def test_each_metric_needs_only_its_inputs(spark, metric):
    frame = weather(days=1)[["lat_idx", "lon_idx", "ts", *required_variables([metric])]]
    derived = derive_hourly(to_spark(spark, frame), [metric])
    assert derived.columns == ["lat_idx", "lon_idx", "ts", metric]
    assert derived.where(F.col(metric).isNull()).isEmpty()


def test_own_metric(spark):
    registry = {**METRICS, "kelvin_doubled": MetricSpec(("tmp_k",), lambda: F.col("tmp_k") * 2, "K")}
    frame = weather(days=1)
    row = (
        derive_hourly(to_spark(spark, frame), ["kelvin_doubled", "humidex"], registry)
        .agg(F.sum("kelvin_doubled"))
        .first()
    )
    assert row[0] == pytest.approx(2 * frame.tmp_k.sum())

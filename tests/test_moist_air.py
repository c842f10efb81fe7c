"""Unit changes and moist-air columns against published or definitional values."""

import pytest
from pyspark.sql import functions as F

from heatgrid.functions import moist_air as air


def evaluate(spark, column, *values):
    """The column over one row whose columns are a, b, ..."""
    names = "abc"[: len(values)]
    schema = ", ".join(f"{name} double" for name in names)
    return spark.createDataFrame([values], schema).select(column(*map(F.col, names))).first()[0]


def over(spark, column, values, low=None):
    """The column at every value, in order; ``low`` is a second input, the same throughout."""
    rows = [(i, float(v), low) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, a double, b double")
    inputs = [F.col("a")] if low is None else [F.col("a"), F.col("b")]
    return [row[0] for row in df.orderBy("i").select(column(*inputs)).collect()]


GRID = [-63.0 + 7.3 * i for i in range(17)]


def test_fahrenheit_is_the_line_through_two_fixed_points(spark):
    """Water freezes at 32 and boils at 212 degrees Fahrenheit."""
    assert over(spark, air.fahrenheit, GRID) == pytest.approx([32 + (212 - 32) * t / 100 for t in GRID])
    there = over(spark, air.fahrenheit, GRID)
    assert over(spark, air.celsius_from_fahrenheit, there) == pytest.approx(GRID)


def test_kelvin_differs_from_celsius_by_the_ice_point(spark):
    """Fixed value: the ice point in kelvin."""
    kelvin = [t + 273.15 for t in GRID]
    assert over(spark, air.celsius_from_kelvin, kelvin) == pytest.approx(GRID)


# Saturation vapour pressure over water in hPa, from the Goff-Gratch table of the
# Smithsonian Meteorological Tables.
SMITHSONIAN = {5.0: 8.7192, 12.0: 14.017, 17.0: 19.367, 26.0: 33.608, 35.0: 56.236}


def test_saturation_pressure_is_within_a_third_of_a_percent_of_the_table(spark):
    assert over(spark, air.saturation_pressure, SMITHSONIAN) == pytest.approx(list(SMITHSONIAN.values()), rel=3.5e-3)


def test_saturation_slope_is_the_derivative(spark):
    def slope(t):
        return air.saturation_slope(t, air.saturation_pressure(t))

    step = 2e-4
    above = over(spark, air.saturation_pressure, [t + step for t in GRID])
    below = over(spark, air.saturation_pressure, [t - step for t in GRID])
    expected = [(x - y) / (2 * step) for x, y in zip(above, below, strict=True)]
    assert over(spark, slope, GRID) == pytest.approx(expected, rel=1e-5)


@pytest.mark.parametrize("pressure", [540.0, 731.0, 1044.0])
def test_vapour_pressure_inverts_specific_humidity(spark, pressure):
    humidities = [0.0007 * i for i in range(40)]
    for q, vapour in zip(humidities, over(spark, air.vapour_pressure, humidities, pressure), strict=True):
        assert 0.622 * vapour / (pressure - 0.378 * vapour) == pytest.approx(q)


def test_vapour_pressure_is_proportional_to_air_pressure(spark):
    low, high = (over(spark, air.vapour_pressure, [0.003, 0.017], p) for p in (600.0, 1020.0))
    assert [b / a for a, b in zip(low, high, strict=True)] == pytest.approx([1.7, 1.7])


def test_relative_humidity_is_the_share_of_saturation_in_percent(spark):
    shares = [0.0, 0.13, 0.71, 1.0, 1.2]
    for saturation in (1.9, 12.27, 73.8):
        vapour = [share * saturation for share in shares]
        assert over(spark, air.relative_humidity, vapour, saturation) == pytest.approx([100 * s for s in shares])


@pytest.mark.parametrize("given, limited", [(100.5, 100.0), (-0.25, 0.0), (63.5, 63.5), (None, None)])
def test_clamp_keeps_null(spark, given, limited):
    assert evaluate(spark, air.percent_clamped, given) == limited


def test_null_inputs_give_null(spark):
    assert evaluate(spark, air.vapour_pressure, None, 1000.0) is None
    assert evaluate(spark, air.wind_speed, 3.0, None) is None
    assert evaluate(spark, air.wind_speed, 3.0, 4.0) == 5.0


def test_corrupt_values_do_not_fail_the_job(spark):
    assert evaluate(spark, air.saturation_pressure, -air.TETENS_OFFSET) is None
    assert evaluate(spark, air.relative_humidity, 1.0, 0.0) is None

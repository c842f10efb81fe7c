"""Column expressions for unit changes and moist-air quantities.

Every expression is NULL as soon as one of its inputs is NULL. Denominators
that depend on the data go through ``try_divide``: one corrupt cell yields a
NULL instead of failing a job in ANSI mode.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Physical constants and published coefficients.
KELVIN_AT_ZERO_CELSIUS = 273.15
FAHRENHEIT_PER_CELSIUS = 1.8
FAHRENHEIT_AT_ZERO_CELSIUS = 32.0
PASCAL_PER_HECTOPASCAL = 100.0
VAPOUR_TO_DRY_AIR = 0.622
TETENS_HPA = 6.1078
TETENS_FACTOR = 17.27
TETENS_OFFSET = 237.3


def celsius_from_kelvin(kelvin: Column) -> Column:
    return kelvin - KELVIN_AT_ZERO_CELSIUS


def fahrenheit(celsius: Column) -> Column:
    return celsius * FAHRENHEIT_PER_CELSIUS + FAHRENHEIT_AT_ZERO_CELSIUS


def celsius_from_fahrenheit(degrees: Column) -> Column:
    return (degrees - FAHRENHEIT_AT_ZERO_CELSIUS) / FAHRENHEIT_PER_CELSIUS


def hectopascal(pascal: Column) -> Column:
    return pascal / PASCAL_PER_HECTOPASCAL


def saturation_pressure(celsius: Column) -> Column:
    """Saturation vapour pressure over water in hPa (Tetens), at any temperature."""
    exponent = F.try_divide(celsius * TETENS_FACTOR, celsius + TETENS_OFFSET)
    return F.exp(exponent) * TETENS_HPA


def saturation_slope(celsius: Column, saturation: Column) -> Column:
    """Derivative of ``saturation_pressure`` in hPa per degree, given its value."""
    shifted = celsius + TETENS_OFFSET
    return F.try_divide(saturation * (TETENS_FACTOR * TETENS_OFFSET), shifted * shifted)


def vapour_pressure(specific_humidity: Column, pressure_hpa: Column) -> Column:
    """Vapour pressure in hPa from specific humidity (kg/kg) and air pressure."""
    return F.try_divide(
        specific_humidity * pressure_hpa,
        specific_humidity * (1.0 - VAPOUR_TO_DRY_AIR) + VAPOUR_TO_DRY_AIR,
    )


def relative_humidity(vapour: Column, saturation: Column) -> Column:
    return F.try_divide(vapour, saturation) * 100.0


def percent_clamped(percent: Column) -> Column:
    """Limit to 0..100. ``least`` and ``greatest`` skip NULL, hence the guard."""
    return F.when(percent.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), percent)))


def wind_speed(eastward: Column, northward: Column) -> Column:
    return F.sqrt(eastward * eastward + northward * northward)

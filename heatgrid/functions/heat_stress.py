"""Heat-stress indices as column expressions, and the wet-bulb refinement.

The indices take and return the units of the publications that define them.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.functions.moist_air import (
    TETENS_FACTOR,
    TETENS_HPA,
    TETENS_OFFSET,
    VAPOUR_TO_DRY_AIR,
)

# Rothfusz regression. Row: power of temperature (degrees F),
# column: power of relative humidity (percent).
ROTHFUSZ = (
    (-42.379, 10.14333127, -0.05481717),
    (2.04901523, -0.22475541, 0.00085282),
    (-0.00683783, 0.00122874, -0.00000199),
)

# Heats in J/kg/K and J/kg, the largest accepted depression of
# the wet bulb below the air temperature in degrees C.
HEAT_DRY_AIR = 1005.7
HEAT_VAPOUR = 1875.0
LATENT_HEAT_AT_ZERO = 2.501e6
LATENT_HEAT_PER_DEGREE = -2370.0
LARGEST_DEPRESSION = 40.0

# Refinement passes. Four come within 1e-9 degrees of the root everywhere on
# -60..60 degrees C, 0..0.05 kg/kg, 500..1100 hPa (tests/test_metrics.py).
WET_BULB_PASSES = 4


def _quadratic(coefficients: Sequence[Column | float], x: Column) -> Column:
    constant, linear, square = coefficients
    return (x * square + linear) * x + constant


def heat_index(degrees_f: Column, humidity_percent: Column) -> Column:
    """Heat index in degrees F: the simple form, or the regression where the mean of
    simple form and temperature reaches 80, with its two humidity corrections."""
    # 0.5 * (t + 61 + (t - 68) * 1.2 + rh * 0.094), multiplied out.
    simple = degrees_f * 1.1 + humidity_percent * 0.047 - 10.3
    regression = _quadratic(
        [_quadratic(row, humidity_percent) for row in ROTHFUSZ], degrees_f
    )
    dry = (humidity_percent < 13.0) & degrees_f.between(80.0, 112.0)
    humid = (humidity_percent > 85.0) & degrees_f.between(80.0, 87.0)
    distance = F.abs(F.lit(17.0) - F.abs(degrees_f - 95.0))
    correction = (
        F.when(dry, (humidity_percent - 13.0) * 0.25 * F.sqrt(distance * (1 / 17.0)))
        .when(humid, (humidity_percent - 85.0) * (F.lit(87.0) - degrees_f) * 0.02)
        .otherwise(0.0)
    )
    # The mean of both reaches 80 where their sum reaches 160. A NULL condition falls through to the simple form, which is NULL then too.
    return F.when(simple + degrees_f >= 160.0, regression + correction).otherwise(simple)


def with_heat_index(
    df: DataFrame,
    degrees_f: str = "tf",
    humidity_percent: str = "rh_pct",
    output: str = "heat_index_f",
) -> DataFrame:
    """Add the heat index. The branches run on non-NULL columns, as in ``with_wet_bulb``."""
    kept = [F.col(name) for name in df.columns]
    t, rh = F.col(degrees_f), F.col(humidity_percent)
    filled = df.select(
        *kept, F.coalesce(t, F.lit(0.0)).alias("_tf"), F.coalesce(rh, F.lit(0.0)).alias("_rh")
    )
    index = F.when(t.isNotNull() & rh.isNotNull(), heat_index(F.col("_tf"), F.col("_rh")))
    return filled.select(*kept, index.alias(output))


def apparent_temperature(celsius: Column, vapour_hpa: Column, wind_ms: Column) -> Column:
    return celsius + vapour_hpa * 0.33 - wind_ms * 0.7 - 4.0


def humidex(celsius: Column, vapour_hpa: Column) -> Column:
    return celsius + (vapour_hpa - 10.0) * (5.0 / 9.0)


def simplified_wbgt(celsius: Column, vapour_hpa: Column) -> Column:
    return celsius * 0.567 + vapour_hpa * 0.393 + 3.94


def _quotient(numerator: Column, denominator: Column) -> Column:
    """A division that is never NULL, so that generated code needs no NULL checks."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def _refinement() -> list[dict[str, Column]]:
    """One Halley step on ``g(d) = L(w)/cp (qs(w) - q) - d = 0``, ``d = t - w`` within 0..40.

    The step comes as columns in the order they build on each other. Second
    derivatives cost a few products, but save three of seven Newton steps.
    """
    t, q, p, d, w, per_heat, inverse, ratio, value, first = map(
        F.col,
        ("_t", "_q", "_p", "_d", "_w", "_per_heat", "_inverse", "_ratio", "_value", "_first"),
    )
    steepness = TETENS_FACTOR * TETENS_OFFSET
    dry_share = 1.0 - VAPOUR_TO_DRY_AIR
    level = F.lit(math.log(TETENS_HPA) + TETENS_FACTOR)
    # Vapour pressure over pressure of the dry air at saturation, and the
    # logarithmic derivative of the vapour pressure.
    saturated = _quotient(F.lit(1.0), p * F.exp(inverse * steepness - level) - dry_share)
    relative = inverse * inverse * steepness
    latent = (w * LATENT_HEAT_PER_DEGREE + LATENT_HEAT_AT_ZERO) * per_heat
    excess = ratio * VAPOUR_TO_DRY_AIR - q

    slope = first + 1.0 + excess * per_heat * LATENT_HEAT_PER_DEGREE
    second = first * (relative * (ratio * (2.0 * dry_share) + 1.0) - inverse * 2.0)
    stepped = d + _quotient(value * slope * 2.0, slope * slope * 2.0 - value * second)
    limited = F.least(F.greatest(stepped, F.lit(0.0)), F.lit(LARGEST_DEPRESSION))
    return [
        {"_inverse": _quotient(F.lit(1.0), w + TETENS_OFFSET)},
        {"_ratio": saturated},
        {
            "_value": latent * excess - d,
            "_first": latent * VAPOUR_TO_DRY_AIR * ratio * (ratio * dry_share + 1.0) * relative,
        },
        {"_d": limited, "_w": t - limited},
    ]


def with_wet_bulb(
    df: DataFrame,
    celsius: str = "tc",
    specific_humidity: str = "spfh",
    pressure_hpa: str = "p_hpa",
    output: str = "wet_bulb_c",
    passes: int = WET_BULB_PASSES,
) -> DataFrame:
    """Add the isobaric wet-bulb temperature in degrees C.

    Solves ``cp (T - Tw) = L(Tw) (qs(Tw) - q)`` from Tw = T. A fixed number of
    passes replaces a convergence loop, each pass a few projections on the one
    before.

    The JVM does not compile a method beyond 8000 bytes of bytecode, and the
    same plan then runs many times slower. To stay below that, the passes run on
    non-NULL columns, NULL inputs being put back at the end. Whatever a pass uses
    repeatedly is a column of its own instead of a repeated expression, except
    for the final step, which as a common subexpression gets its own method.

    A filter on the result is kept from moving down through the passes, where
    substituting each into the next would multiply the expression at every pass.
    Filters on other columns therefore belong before this call.
    """
    kept = [F.col(name) for name in df.columns]
    raw = [F.col(name) for name in (celsius, specific_humidity, pressure_hpa)]
    known = raw[0].isNotNull() & raw[1].isNotNull() & raw[2].isNotNull()
    heat = F.col("_q") * (HEAT_VAPOUR - HEAT_DRY_AIR) + HEAT_DRY_AIR

    inputs = ("_t", "_q", "_p")
    current = df.select(
        *kept, *(F.coalesce(c, F.lit(x)).alias(n) for c, x, n in zip(raw, (0.0, 0.0, 1000.0), inputs))
    ).select(
        *kept, *inputs, _quotient(F.lit(1.0), heat).alias("_per_heat"),
        F.lit(0.0).alias("_d"), F.col("_t").alias("_w"),
    )
    # The first step of a pass keeps only what is carried from pass to pass.
    steps, carried = [], ["_t", "_q", "_p", "_per_heat", "_d", "_w"]
    for columns in _refinement():
        steps.append(
            [*kept, *(F.col(n) for n in carried if n not in columns)]
            + [column.alias(name) for name, column in columns.items()]
        )
        carried = [name for name in carried if name not in columns] + list(columns)
    for _ in range(passes):
        for step in steps:
            current = current.select(*step)
    # Always true, but not deterministic to the optimizer: no filter passes it.
    barrier = F.spark_partition_id() >= 0
    return current.select(*kept, F.when(known & barrier, F.col("_w")).alias(output))

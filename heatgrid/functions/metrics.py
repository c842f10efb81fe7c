"""The metric registry and the hourly derivation of the requested metrics.

A metric names the quantities it needs; a quantity names the raw variables or
other quantities it is built from. Only what the requested metrics reach is
added, each quantity once, so the scan reads just the raw variables behind them.
"""

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatgrid.functions import heat_stress as heat
from heatgrid.functions import moist_air as air
from heatgrid.schema import VARIABLES


@dataclass(frozen=True)
class Quantity:
    """An hourly column derived from ``needs``; ``add`` returns the frame with it."""

    needs: tuple[str, ...]
    add: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class MetricSpec:
    """A metric: what it needs (raw variables or quantities), its column, its units.

    A formula that is no column is given as ``array`` instead: a function of as many numpy arrays of doubles
    as there are needs, in that order, with NaN where a value is missing, to an array as long. Its NaN and
    infinities become NULL.
    """

    needs: tuple[str, ...]
    column: Callable[[], Column] | None
    units: str = "deg_F"
    array: Callable[..., np.ndarray] | None = None


def _column(name: str, needs: tuple[str, ...], build: Callable[..., Column]) -> tuple[str, Quantity]:
    def add(df: DataFrame) -> DataFrame:
        return df.withColumn(name, build(*map(F.col, needs)))

    return name, Quantity(needs, add)


# In dependency order.
QUANTITIES: dict[str, Quantity] = dict(
    (
        _column("tc", ("tmp_k",), air.celsius_from_kelvin),
        _column("tf", ("tc",), air.fahrenheit),
        _column("p_hpa", ("pres_pa",), air.hectopascal),
        _column("wind_ms", ("u10", "v10"), air.wind_speed),
        _column("vp_hpa", ("spfh", "p_hpa"), air.vapour_pressure),
        _column("es_hpa", ("tc",), air.saturation_pressure),
        _column("es_slope", ("tc", "es_hpa"), air.saturation_slope),
        _column("rh_unlimited", ("vp_hpa", "es_hpa"), air.relative_humidity),
        # Limited here, once, so that heat index and exported humidity agree.
        _column("rh_pct", ("rh_unlimited",), air.percent_clamped),
        ("heat_index_f", Quantity(("tf", "rh_pct"), heat.with_heat_index)),
        ("wet_bulb_c", Quantity(("tc", "spfh", "p_hpa"), heat.with_wet_bulb)),
    )
)


def _metric(
    *needs: str, build: Callable[..., Column], units: str = "deg_F"
) -> MetricSpec:
    return MetricSpec(needs, lambda: build(*map(F.col, needs)), units)


METRICS: dict[str, MetricSpec] = {
    "apparent_temperature": _metric(
        "tc", "vp_hpa", "wind_ms",
        build=lambda t, e, wind: air.fahrenheit(heat.apparent_temperature(t, e, wind)),
    ),
    "heat_index": _metric("heat_index_f", build=lambda index: index),
    "humidex": _metric(
        "tc", "vp_hpa", build=lambda t, e: air.fahrenheit(heat.humidex(t, e))
    ),
    "relative_humidity": _metric("rh_pct", build=lambda rh: rh, units="percent"),
    "simplified_wbgt": _metric(
        "tc", "vp_hpa", build=lambda t, e: air.fahrenheit(heat.simplified_wbgt(t, e))
    ),
    "specific_humidity": _metric("spfh", build=lambda q: q, units="kg/kg"),
    "temperature": _metric("tf", build=lambda t: t),
    "wet_bulb_temperature": _metric("wet_bulb_c", build=air.fahrenheit),
}


def check_metrics(names: Iterable[str], registry: Mapping[str, MetricSpec] = METRICS) -> list[str]:
    """The names as a list, or ValueError naming the unknown and the available ones."""
    wanted = list(names)
    unknown = sorted(set(wanted) - set(registry))
    if unknown:
        raise ValueError(
            f"no such metric: {', '.join(unknown)}; choose from {', '.join(sorted(registry))}"
        )
    return wanted


def select_metrics(
    metrics: str | Iterable[str], registry: Mapping[str, MetricSpec] = METRICS
) -> list[str]:
    """``"all"`` gives every metric in alphabetical order, a list is kept as asked."""
    if isinstance(metrics, str):
        if metrics == "all":
            return sorted(registry)
        metrics = [metrics]
    return check_metrics(metrics, registry)


def _reachable(names: Iterable[str], registry: Mapping[str, MetricSpec]) -> set[str]:
    found: set[str] = set()
    todo = [need for name in names for need in registry[name].needs]
    while todo:
        need = todo.pop()
        if need not in found:
            found.add(need)
            todo.extend(QUANTITIES[need].needs if need in QUANTITIES else ())
    return found


def required_variables(
    metrics: Iterable[str], registry: Mapping[str, MetricSpec] = METRICS
) -> list[str]:
    """Sorted raw variables that the metrics read."""
    return sorted(_reachable(check_metrics(metrics, registry), registry) & set(VARIABLES))


def with_quantities(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add the named quantities and whatever they are built from."""
    wanted = set(names)
    for name in reversed(QUANTITIES):
        if name in wanted:
            wanted.update(QUANTITIES[name].needs)
    for name, quantity in QUANTITIES.items():
        if name in wanted:
            df = quantity.add(df)
    return df


def derive_hourly(
    hourly: DataFrame,
    metrics: Iterable[str],
    registry: Mapping[str, MetricSpec] = METRICS,
) -> DataFrame:
    """Replace the raw variables by one hourly column per requested metric."""
    names = check_metrics(metrics, registry)
    keys = [name for name in hourly.columns if name not in VARIABLES]
    inputs = required_variables(names, registry)
    derived = with_quantities(hourly.select(*keys, *inputs), _reachable(names, registry))
    arrays = {name: registry[name] for name in names if registry[name].array}
    if not arrays:
        return derived.select(*keys, *(registry[name].column().alias(name) for name in names))
    columns = [registry[name].column().alias(name) for name in names if name not in arrays]
    # Inputs under names of their own, since a metric may be called like one.
    needs = sorted({need for spec in arrays.values() for need in spec.needs})
    given = derived.select(*keys, *columns, *(F.col(need).cast("double").alias(f"_in_{need}") for need in needs))
    return with_arrays(given, arrays).select(*keys, *names)


def with_arrays(df: DataFrame, specs: Mapping[str, MetricSpec]) -> DataFrame:
    """``df`` with a column for each metric that is a function of arrays, in one pass over batches of rows."""
    kept = [name for name in df.columns if not name.startswith("_in_")]
    schema = T.StructType([df.schema[name] for name in kept] + [T.StructField(name, T.DoubleType()) for name in specs])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name) for name in kept]
            for name, spec in specs.items():
                given = [batch.column(f"_in_{need}").to_numpy(zero_copy_only=False) for need in spec.needs]
                found = np.asarray(spec.array(*(np.asarray(values, np.float64) for values in given)), np.float64)
                if found.shape != (batch.num_rows,):
                    raise ValueError(f"{name} gave an array of shape {found.shape} for {batch.num_rows} rows")
                columns.append(pa.array(found, pa.float64(), mask=~np.isfinite(found)))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *specs])

    return df.mapInArrow(added, schema)

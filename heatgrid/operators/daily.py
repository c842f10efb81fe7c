"""From hourly metric columns to one row per cell and UTC day."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatgrid.functions.metrics import METRICS, MetricSpec, derive_hourly
from heatgrid.operators.calendar import hour_bit, in_utc
from heatgrid.operators.reducers import Reducer
from heatgrid.operators.tiles import with_tile_id
from heatgrid.schema import CELL, HOURS_PER_DAY, STATISTICS, TILE_ID, TILE_SHAPE

#: Reducers by metric and label.
Reducers = Mapping[str, Mapping[str, Reducer]]
NO_REDUCERS: Reducers = {}


def daily_state(
    hourly: DataFrame,
    metrics: Iterable[str],
    keys: Sequence[str] = CELL,
    reducers: Reducers = NO_REDUCERS,
    with_hours: bool = True,
) -> DataFrame:
    """What is known of each key and UTC day, in a form that can be merged: extremes, sums and counts by metric.

    ``hours`` is the set of hours as bits, ``repeated_rows`` the rows beyond that set. The 24 hours of a
    cell-day collapse in the partial aggregate of the task that scans them, so the shuffle carries days, not
    hours.
    """
    aggregates = []
    for name in metrics:
        value = F.col(name)
        aggregates += [
            F.min(value).alias(f"{name}_min"),
            F.sum(value).alias(f"{name}_sum"),
            F.max(value).alias(f"{name}_max"),
            F.count(value).alias(f"{name}_valid_hours"),
        ]
        for label, reducer in reducers.get(name, {}).items():
            aggregates += [state.alias(f"{name}_{label}_{part}") for part, state in reducer.states(value).items()]
    if with_hours:
        aggregates += [F.count(F.lit(1)).alias("_rows"), F.bit_or(hour_bit("ts")).alias("hours")]
    state = in_utc(hourly).groupBy(*keys, F.to_date("ts").alias("day")).agg(*aggregates)
    if not with_hours:
        return state
    repeated = (F.col("_rows") - F.bit_count("hours")).cast("bigint")
    return state.withColumn("repeated_rows", repeated).drop("_rows")


def merge_states(states: DataFrame, metrics: Iterable[str], keys: Sequence[str] = CELL) -> DataFrame:
    """One state per key and day from several of disjoint hours.

    An hour that more than one of them has counts as a repeated row: their sets then have more bits than
    all of them together.
    """
    aggregates = []
    for name in metrics:
        aggregates += [
            function(f"{name}_{part}").alias(f"{name}_{part}")
            for part, function in (("min", F.min), ("sum", F.sum), ("max", F.max), ("valid_hours", F.sum))
        ]
    hours = F.bit_or("hours")
    twice = F.sum(F.bit_count("hours")) - F.bit_count(hours)
    return states.groupBy(*keys, "day").agg(
        *aggregates, hours.alias("hours"), (F.sum("repeated_rows") + twice).cast("bigint").alias("repeated_rows")
    )


def statistics_of(
    state: DataFrame,
    metrics: Iterable[str],
    keys: Sequence[str] = CELL,
    min_valid_hours: int = HOURS_PER_DAY,
    reducers: Reducers = NO_REDUCERS,
    with_hours: bool = False,
) -> DataFrame:
    """Minimum, mean, maximum, count and further statistics per key and day; NULL but for the count on days
    with fewer valid hours than ``min_valid_hours``."""
    columns = []
    for name in metrics:
        count = F.col(f"{name}_valid_hours")
        statistics = {
            "min": F.col(f"{name}_min"),
            "mean": F.try_divide(F.col(f"{name}_sum"), count),
            "max": F.col(f"{name}_max"),
        }
        more = {}
        for label, reducer in reducers.get(name, {}).items():
            prefix = f"{name}_{label}_"
            parts = {column.removeprefix(prefix): F.col(column) for column in state.columns if column.startswith(prefix)}
            more[label] = reducer.result(parts)
        columns += [
            F.when(count >= min_valid_hours, value).alias(f"{name}_{label}")
            for label, value in (*((s, statistics[s]) for s in STATISTICS), *more.items())
        ]
        columns.append(count.cast("int").alias(f"{name}_valid_hours"))
    if with_hours:
        columns += [F.col("hours"), F.col("repeated_rows")]
    return state.select(*keys, "day", *columns)


def reduce_daily(
    hourly: DataFrame,
    metrics: Iterable[str],
    keys: Sequence[str] = CELL,
    min_valid_hours: int = HOURS_PER_DAY,
    reject_repeated_hours: bool = False,
    with_hours: bool = False,
    reducers: Reducers = NO_REDUCERS,
) -> DataFrame:
    """Minimum, mean, maximum and valid-hour count per key and UTC day.

    ``hourly`` holds ``ts`` and one column per metric. Statistics of a day with
    fewer valid hours than ``min_valid_hours`` are NULL, its count is kept.

    ``reject_repeated_hours`` fails the job when a cell has two rows for an
    hour, which would inflate the counts; it costs no extra pass. ``with_hours`` adds the set of hours of
    each cell-day as bits (``hours``) and its rows beyond that set (``repeated_rows``). ``reducers`` adds
    a column ``<metric>_<label>`` for each reducer, by metric and label.
    """
    names = list(metrics)
    state = daily_state(hourly, names, keys, reducers, with_hours=reject_repeated_hours or with_hours)
    if reject_repeated_hours:
        # A filter stays whatever columns are taken from the result.
        error = F.raise_error(F.lit("a cell has more than one row for the same hour")).cast("boolean")
        state = state.where(F.when(F.col("repeated_rows") > 0, error).otherwise(True))
    return statistics_of(state, names, keys, min_valid_hours, reducers, with_hours)


def daily_metrics(
    hourly: DataFrame,
    metrics: Iterable[str],
    keys: Sequence[str] = CELL,
    min_valid_hours: int = HOURS_PER_DAY,
    registry: Mapping[str, MetricSpec] = METRICS,
    reject_repeated_hours: bool = False,
    with_hours: bool = False,
    reducers: Reducers = NO_REDUCERS,
) -> DataFrame:
    """Daily statistics straight from hourly raw variables, in one aggregation."""
    names = list(metrics)
    return reduce_daily(
        derive_hourly(hourly, names, registry),
        names,
        keys,
        min_valid_hours,
        reject_repeated_hours,
        with_hours,
        reducers,
    )


def to_long(
    daily: DataFrame, metrics: Iterable[str], tile_shape: tuple[int, int] = TILE_SHAPE
) -> DataFrame:
    """One row per metric and cell-day in the stored column types, without a shuffle."""
    entries = [
        F.struct(
            F.lit(name).alias("metric"),
            *(F.col(f"{name}_{statistic}").cast("float").alias(statistic) for statistic in STATISTICS),
            F.col(f"{name}_valid_hours").cast("tinyint").alias("valid_hours"),
        )
        for name in metrics
    ]
    return with_tile_id(daily, tile_shape).select(
        F.year("day").alias("year"), TILE_ID, "day", *CELL, F.inline(F.array(*entries))
    ).select("metric", "year", TILE_ID, "day", *CELL, *STATISTICS, "valid_hours")


def to_wide(long: DataFrame, metrics: Iterable[str]) -> DataFrame:
    """Back to one row per cell-day; a metric without a row there is NULL throughout."""
    aggregates = [
        F.max(F.when(F.col("metric") == name, F.col(column))).alias(f"{name}_{column}")
        for name in metrics
        for column in (*STATISTICS, "valid_hours")
    ]
    return long.groupBy(*CELL, "day").agg(*aggregates)

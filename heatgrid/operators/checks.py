"""Checks on inputs and on stored tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatgrid.operators.calendar import hour_bit, in_utc
from heatgrid.operators.polygons import grid_axes
from heatgrid.schema import CELL, HOURS_PER_DAY


def hourly_coverage(hourly: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    """One row of facts about the time axis of an hourly table.

    Hours of a cell-day are kept as a 24-bit set, so repeated rows show up as
    rows beyond the set's size: no grouping by hour, no distinct over hours.
    """
    past_hour = F.minute("ts") * 60 + F.expr("extract(second FROM ts)")
    per_cell_day = in_utc(hourly).groupBy(*keys, F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("first_ts"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(past_hour != 0).alias("off_hour"),
        F.bit_or(hour_bit("ts")).alias("hours"),
    )
    per_day = per_cell_day.groupBy("day").agg(
        F.min("first_ts").alias("first_ts"),
        F.sum("n").alias("n"),
        F.sum("off_hour").alias("off_hour"),
        F.sum(F.col("n") - F.bit_count("hours")).alias("repeated"),
        F.bit_count(F.bit_or("hours")).alias("hours"),
    )
    first = F.min("first_ts")
    return per_day.agg(
        first.alias("first_ts"),
        (first == F.to_date(first).cast("timestamp_ntz")).alias("starts_at_midnight"),
        F.sum("hours").alias("hours"),
        (F.sum("hours") % HOURS_PER_DAY == 0).alias("whole_days"),
        F.sum("n").alias("n_rows"),
        F.sum("off_hour").alias("off_hour_rows"),
        F.sum("repeated").alias("repeated_rows"),
    )


def check_year(daily: DataFrame, year: int, metrics: Sequence[str] = ()) -> dict[str, tuple[int, int]] | None:
    """Complete and covered cell-days by metric; None without rows; ValueError unless the rows are sound.

    Daily rows (day, hours, repeated_rows) are sound if they lie in that year, their hours start at 00Z and
    make whole days that follow each other, and no cell has two rows for one hour. What comes to the
    driver is a row per day.
    """
    counts = [
        F.count_if(F.col(f"{name}_valid_hours") >= least).alias(f"{name}_{kind}")
        for name in metrics
        for kind, least in (("complete", HOURS_PER_DAY), ("covered", 1))
    ]
    days = daily.groupBy("day").agg(
        F.bit_or("hours").alias("hours"), F.sum("repeated_rows").alias("repeated"), *counts
    ).collect()
    if not days:
        return None
    days.sort(key=lambda row: row.day)
    outside = sum(row.day.year != year for row in days)
    if outside:
        raise ValueError(f"{outside} of {len(days)} days are outside {year}")
    repeated = sum(row.repeated for row in days)
    if repeated:
        raise ValueError(f"a cell has more than one row for the same hour, {repeated} rows in {year}")
    if not days[0].hours & 1:
        raise ValueError(f"the first hour must be 00Z, which {days[0].day} lacks")
    hours = sum(row.hours.bit_count() for row in days)
    if hours % HOURS_PER_DAY:
        raise ValueError(f"{hours} hours are not a whole number of 24-hour days")
    if (days[-1].day - days[0].day).days + 1 != len(days):
        raise ValueError(f"the days of {year} are not contiguous")
    return {
        name: tuple(sum(row[f"{name}_{kind}"] for row in days) for kind in ("complete", "covered")) for name in metrics
    }


def axis_differences(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Keys on one side only, as (keys, problem): 'missing' or 'unexpected'."""
    left = expected.select(*keys).distinct().withColumn("_expected", F.lit(True))
    right = actual.select(*keys).distinct().withColumn("_actual", F.lit(True))
    problem = F.when(F.col("_actual").isNull(), "missing").otherwise("unexpected")
    return (
        left.join(right, list(keys), "full_outer")
        .where(F.col("_actual").isNull() | F.col("_expected").isNull())
        .select(*keys, problem.alias("problem"))
    )


def grid_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Axis points where two grids disagree, by exact comparison of coordinates."""
    left = grid_axes(expected).withColumnRenamed("coordinate", "expected")
    right = grid_axes(actual).withColumnRenamed("coordinate", "actual")
    return left.join(right, ["axis", "idx"], "full_outer").where(
        ~F.col("expected").eqNullSafe(F.col("actual"))
    )


def check_same_grid(expected: DataFrame, actual: DataFrame) -> None:
    """ValueError unless both have the same cells and the same coordinates."""
    wrong = grid_differences(expected, actual)
    first = wrong.orderBy("axis", "idx").first()
    if first is not None:
        raise ValueError(
            f"the grids differ, first at {first.axis} {first.idx}: "
            f"expected {first.expected}, found {first.actual}"
        )
    cell = axis_differences(expected, actual, CELL).orderBy(*CELL).first()
    if cell is not None:
        raise ValueError(f"the grids differ, cell ({cell.lat_idx}, {cell.lon_idx}) is {cell.problem}")

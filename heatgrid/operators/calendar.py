"""Day axes, positions on them, and the dense day-by-cell view."""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatgrid.schema import CELL


def in_utc(df: DataFrame, ts: str = "ts") -> DataFrame:
    """The instants of the time column as UTC clock time without a zone.

    Days and hours of such a column do not depend on the zone of the session or the driver. Clock times
    are taken to be UTC already. Counting from the epoch, no hour is lost where a zone sets its clocks.
    """
    if not isinstance(df.schema[ts].dataType, T.TimestampType):
        return df
    return df.withColumn(ts, F.expr(f"timestampadd(MICROSECOND, unix_micros(`{ts}`), timestamp_ntz'1970-01-01')"))


def hour_bit(ts: str) -> Column:
    """The hour of the day as one bit of 24, so that hours can be collected by OR."""
    return F.call_function("shiftleft", F.lit(1), F.hour(ts))


def check_years(start_year: int, end_year: int) -> None:
    if end_year < start_year:
        raise ValueError(f"the last year {end_year} lies before the first year {start_year}")


def _first_day(start_year: int) -> Column:
    return F.lit(date(start_year, 1, 1))


def _last_day(end_year: int) -> Column:
    return F.lit(date(end_year, 12, 31))


def axis_position(day: Column, start_year: int) -> Column:
    """0-based position of a day on the axis that starts on 1 January of ``start_year``."""
    return F.date_diff(day, _first_day(start_year))


def day_axis(spark: SparkSession, start_year: int, end_year: int) -> DataFrame:
    """Every day from 1 January of the first to 31 December of the last year."""
    check_years(start_year, end_year)
    length = (date(end_year + 1, 1, 1) - date(start_year, 1, 1)).days
    position = F.col("id").cast("int")
    return spark.range(length).select(
        F.date_add(_first_day(start_year), position).alias("day"), position.alias("position")
    )


def days_of_years(years: DataFrame, year: str = "year") -> DataFrame:
    """Every day of the calendar years in a table, each day once."""
    january = F.make_date(F.col(year), F.lit(1), F.lit(1))
    december = F.make_date(F.col(year), F.lit(12), F.lit(31))
    return (
        years.select(year)
        .distinct()
        .select(year, F.explode(F.sequence(january, december)).alias("day"))
    )


def locate_days(df: DataFrame, start_year: int, end_year: int, day: str = "day") -> DataFrame:
    """Add the position of each row's day; NULL where the day is off the axis."""
    check_years(start_year, end_year)
    on_axis = F.col(day).between(_first_day(start_year), _last_day(end_year))
    return df.withColumn("position", F.when(on_axis, axis_position(F.col(day), start_year)))


def check_contiguous_days(df: DataFrame, start_year: int, end_year: int, day: str = "day") -> tuple[int, int]:
    """The half-open position range the days fill; ValueError if off the axis or gapped."""
    facts = (
        locate_days(df.select(day).distinct(), start_year, end_year, day)
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.count("position").alias("placed"),
            F.min("position").alias("first"),
            F.max("position").alias("last"),
        )
        .first()
    )
    if not facts.days or facts.placed < facts.days:
        raise ValueError(
            f"{facts.days - facts.placed} of {facts.days} days are outside {start_year}-{end_year}"
        )
    if facts.last - facts.first + 1 != facts.days:
        raise ValueError("the days are not contiguous on the axis")
    return facts.first, facts.last + 1


def dense_daily(
    daily: DataFrame, cells: DataFrame, start_year: int, end_year: int
) -> DataFrame:
    """The full (day, cell) view: absent statistics NULL, absent counts 0.

    Each cell generates its own days, so the spine needs no cross join and is
    spread like the cells; the one join is on (cell, day).
    """
    check_years(start_year, end_year)
    spine = cells.select(
        *CELL,
        F.explode(F.sequence(_first_day(start_year), _last_day(end_year))).alias("day"),
    )
    values = [name for name in daily.columns if name not in (*CELL, "day")]
    filled = [
        F.coalesce(F.col(name), F.lit(0)).alias(name) if name.endswith("valid_hours") else F.col(name)
        for name in values
    ]
    return spine.join(daily, [*CELL, "day"], "left").select(*CELL, "day", *filled)

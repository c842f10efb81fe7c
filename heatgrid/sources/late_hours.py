"""Hours that arrive in several deliveries, taken up without reading the earlier hours again.

A store keeps, beside its statistics, the mergeable state of every delivery: ``states`` (partitioned by
delivery and year) and ``deliveries`` (those that count). A delivery reduces its own hours, merges them
with the states of the same years, which are a row per cell-day, and publishes the statistics of these years
as a new attempt. Hours that were delivered before show in the sets of hours and are an error, which leaves
the store as it was.
"""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatgrid.functions.metrics import METRICS, MetricSpec, check_metrics, derive_hourly
from heatgrid.operators.daily import daily_state, merge_states, statistics_of, to_long
from heatgrid.schema import CELL, HOURS_PER_DAY, TILE_SHAPE, conform
from heatgrid.session import few_rows, remove
from heatgrid.sources.boundary import stored_or_none
from heatgrid.sources.daily_store import new_attempt, record_completed, record_units, write_daily

DELIVERIES = "delivery string"


def states_schema(metrics: Iterable[str]) -> T.StructType:
    columns = [f"{name} int" for name in CELL] + ["day date"]
    for name in metrics:
        columns += [f"{name}_{part} double" for part in ("min", "sum", "max")] + [f"{name}_valid_hours bigint"]
    return T.StructType.fromDDL(", ".join([*columns, "hours int", "repeated_rows bigint", "delivery string", "year int"]))


def read_states(spark: SparkSession, root: str, metrics: Iterable[str], deliveries: Iterable[str], years: Iterable[int]) -> DataFrame:
    """The states of some deliveries and years, which prune partitions."""
    states = spark.read.schema(states_schema(metrics)).parquet(f"{root}/states")
    return states.where(F.col("delivery").isin(list(deliveries)) & F.col("year").isin(list(years)))


def deliver_hours(
    spark: SparkSession,
    root: str,
    hourly: DataFrame,
    metrics: Iterable[str],
    tile_shape: tuple[int, int] = TILE_SHAPE,
    min_valid_hours: int = HOURS_PER_DAY,
    registry: Mapping[str, MetricSpec] = METRICS,
) -> list[int]:
    """Take up hours of any cells and days; the years whose statistics are new.

    All deliveries to a store have the same metrics. ValueError if a cell gets an hour twice, within the
    delivery or with an earlier one; then nothing has changed.
    """
    names = check_metrics(metrics, registry)
    delivery = new_attempt()
    state = daily_state(derive_hourly(hourly, names, registry), names).withColumn("year", F.year("day"))
    path = f"{root}/states/delivery={delivery}"
    stored = T.StructType([field for field in states_schema(names) if field.name != "delivery"])
    conform(state, stored).hint("rebalance", "year").write.partitionBy("year").parquet(path)
    known = stored_or_none(spark, f"{root}/deliveries", DELIVERIES)
    earlier = [row.delivery for row in known.collect()] if known else []
    # A delivery has few years.
    fresh = spark.read.schema(states_schema(names)).option("basePath", f"{root}/states").parquet(path)
    years = sorted(row.year for row in fresh.select("year").distinct().collect())
    if not years:
        remove(spark, path)
        return []
    merged = merge_states(read_states(spark, root, names, [*earlier, delivery], years), names)
    staged = f"{root}/merged-{delivery}"
    try:
        merged.write.parquet(staged)
        merged = spark.read.schema(merged.schema).parquet(staged)
        repeated = merged.agg(F.sum("repeated_rows")).first()[0]
        if repeated:
            remove(spark, path)
            raise ValueError(f"a cell has more than one row for the same hour, {repeated} rows in {years}")
        statistics = statistics_of(merged, names, min_valid_hours=min_valid_hours)
        attempt = write_daily(to_long(statistics, names, tile_shape), root)
    finally:
        remove(spark, staged)
    record_units(spark, root, names, registry)
    few_rows(spark, [(delivery,)], DELIVERIES).coalesce(1).write.mode("append").parquet(f"{root}/deliveries")
    record_completed(spark, root, names, years, attempt)
    return years

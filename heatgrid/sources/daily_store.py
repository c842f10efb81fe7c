"""The daily result table: partitioned storage, records of what counts, gap report.

Layout below one root: ``daily`` (partitioned by attempt, metric, year, block and tile), ``manifest`` (which
attempt counts for a metric, year and block), ``metrics`` (their units) and ``setup`` (what the store was set
up for: years, coverage rule, tiles, blocks, grid and region).

Every write goes to an attempt of its own and is seen by nobody until the manifest names it, which happens
after the last file is there. A write that breaks off, or one of another region, therefore leaves nothing
behind that is ever read. Where several attempts are recorded, the last one counts. One run at a time
writes to a store.
"""

import time
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from heatgrid.functions.metrics import METRICS, MetricSpec, check_metrics
from heatgrid.operators.calendar import check_years
from heatgrid.operators.daily import to_wide
from heatgrid.operators.region import keep_inside
from heatgrid.operators.tiles import tile_number, tile_row_of
from heatgrid.schema import CELL, DAILY, HOURS_PER_DAY, MANIFEST, RECORDS, STATISTICS, STORED_DAILY, TILE_ID, conform
from heatgrid.session import few_rows, folders, remove
from heatgrid.sources.boundary import stored_or_none

SETUP = (
    "start_year int, end_year int, min_valid_hours int, tile_rows int, tile_cols int, "
    "block_rows int, blocks int, grid string, region string"
)
UNITS = "metric string, units string"
PARTITIONS = ("attempt", "metric", "year", "block")
# Rows of a page in a daily file: a cell's year takes a fraction of a page, so one cell reads few of them.
PAGE_ROWS = 2_000


@dataclass(frozen=True)
class StoreSetup:
    """What a store is set up for; ``block_rows`` of 0 makes the whole region one block."""

    start_year: int
    end_year: int
    min_valid_hours: int
    tile_rows: int
    tile_cols: int
    block_rows: int = 0
    blocks: int = 1
    grid: str = ""
    region: str = ""


def new_attempt() -> str:
    """A name that sorts after those given before."""
    return f"{time.time_ns():020d}-{uuid4().hex[:8]}"


def write_daily(long: DataFrame, root: str, attempt: str | None = None, block_rows: int = 0) -> str:
    """Write daily rows as an attempt and return its name; ``record_completed`` makes it count.

    Rebalancing gives files of even size whatever the metric, year or tile, and the rows of a cell lie
    together in the files of its tile.
    """
    attempt = attempt or new_attempt()
    block = F.call_function("div", tile_row_of(), F.lit(block_rows)).cast("int") if block_rows else F.lit(0)
    (
        conform(long, DAILY).withColumn("block", block)
        .hint("rebalance", "metric", "year", TILE_ID)
        .sortWithinPartitions("metric", "year", "block", TILE_ID, *CELL, "day")
        .write.partitionBy("metric", "year", "block", TILE_ID)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .parquet(f"{root}/daily/attempt={attempt}")
    )
    return attempt


def publish_daily(long: DataFrame, root: str, metrics: Iterable[str], years: Iterable[int]) -> str:
    """Write daily rows and make them count for these metrics and years."""
    attempt = write_daily(long, root)
    record_completed(long.sparkSession, root, metrics, years, attempt)
    return attempt


def read_daily(
    spark: SparkSession,
    root: str,
    metrics: Iterable[str] | None = None,
    years: Iterable[int] | None = None,
    cell: tuple[int, int] | None = None,
) -> DataFrame:
    """The rows that count; metrics, years and the tile of a cell prune partitions.

    The records are at most a row per metric, year and block.
    """
    wanted = None if metrics is None else set(metrics)
    of_years = None if years is None else set(years)
    counting = [
        tuple(record[name] for name in PARTITIONS)
        for record in current_records(spark, root)
        if record.attempt and (wanted is None or record.metric in wanted) and (of_years is None or record.year in of_years)
    ]
    if not counting:
        return spark.createDataFrame([], DAILY)
    daily = spark.read.schema(STORED_DAILY).option("basePath", f"{root}/daily").parquet(f"{root}/daily")
    for i, name in enumerate(PARTITIONS):
        daily = daily.where(F.col(name).isin(sorted({record[i] for record in counting})))
    named = few_rows(spark, counting, "attempt string, metric string, year int, block int")
    daily = daily.join(F.broadcast(named), list(PARTITIONS), "left_semi")
    if cell is not None:
        setup = read_setup(spark, root)
        if setup is not None:
            daily = daily.where(F.col(TILE_ID) == tile_number(cell, (setup.tile_rows, setup.tile_cols)))
        daily = daily.where((F.col("lat_idx") == cell[0]) & (F.col("lon_idx") == cell[1]))
    return daily.select(*DAILY.names)


def read_wide(
    spark: SparkSession,
    root: str,
    metrics: Iterable[str],
    years: Iterable[int] | None = None,
) -> DataFrame:
    """One row per cell-day with the columns of each metric, described by the stored units."""
    names = list(metrics)
    units = {row.metric: row.units for row in read_units(spark, root).where(F.col("metric").isin(names)).collect()}
    return describe(to_wide(read_daily(spark, root, names, years), names), names, units)


def read_units(spark: SparkSession, root: str) -> DataFrame:
    stored = stored_or_none(spark, f"{root}/metrics", UNITS)
    return (spark.createDataFrame([], UNITS) if stored is None else stored).distinct()


def record_units(
    spark: SparkSession, root: str, metrics: Iterable[str], registry: Mapping[str, MetricSpec] = METRICS
) -> None:
    """Keep the units with the data, since one column holds metrics of different units."""
    stored = stored_or_none(spark, f"{root}/metrics", UNITS)
    known = {row.metric for row in stored.collect()} if stored else set()
    new = [(name, registry[name].units) for name in metrics if name not in known]
    if new:
        few_rows(spark, new, UNITS).coalesce(1).write.mode("append").parquet(f"{root}/metrics")


def union_manifest(manifest: DataFrame, finished: DataFrame) -> DataFrame:
    """Recording a metric-year twice changes nothing."""
    return manifest.unionByName(finished).distinct()


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """All that was ever recorded: (metric, year, block, attempt, complete, covered)."""
    stored = stored_or_none(spark, f"{root}/manifest", RECORDS)
    return spark.createDataFrame([], RECORDS) if stored is None else stored


def current_records(spark: SparkSession, root: str) -> list[Row]:
    """The record that counts of each metric, year and block, which are few."""
    latest: dict[tuple, Row] = {}
    for record in read_records(spark, root).collect():
        key = (record.metric, record.year, record.block)
        if key not in latest or latest[key].attempt < record.attempt:
            latest[key] = record
    return [latest[key] for key in sorted(latest)]


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(metric, year) of which every block is recorded."""
    setup = read_setup(spark, root)
    blocks = F.count_distinct("block")
    finished = read_records(spark, root).groupBy("metric", "year").agg(blocks.alias("blocks"))
    return finished.where(F.col("blocks") >= (setup.blocks if setup else 1)).select(*MANIFEST.names)


def record_completed(
    spark: SparkSession,
    root: str,
    metrics: Iterable[str],
    years: Iterable[int],
    attempt: str = "",
    block: int = 0,
    counts: Mapping[str, tuple[int, int]] | None = None,
) -> None:
    """Append finished metric-years of a block; called only after all their data has been written.

    ``counts`` by metric are its complete and its covered cell-days.
    """
    years = list(years)
    rows = [
        (metric, year, block, attempt, *(counts or {}).get(metric, (None, None))) for metric in metrics for year in years
    ]
    few_rows(spark, rows, RECORDS).coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def remove_superseded(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of attempts that do not count, and return their paths below ``daily``.

    Those are what a broken run has left and what a later attempt replaces. No other run may be writing.
    """
    counting = {tuple(str(record[name]) for name in PARTITIONS) for record in current_records(spark, root)}
    removed = []
    attempts = {values[0] for values in counting}
    for path in folders(spark, f"{root}/daily", "attempt=*"):
        if path.split("=")[-1] not in attempts:
            removed.append(path)
    for path in folders(spark, f"{root}/daily", "/".join(f"{name}=*" for name in PARTITIONS)):
        values = tuple(part.split("=", 1)[1] for part in path.split("/"))
        if values[0] in attempts and values not in counting:
            removed.append(path)
    for path in removed:
        remove(spark, f"{root}/daily/{path}")
    return removed


def completed_years(manifest: DataFrame) -> DataFrame:
    """Sorted finished years per metric."""
    return manifest.groupBy("metric").agg(F.array_sort(F.collect_set("year")).alias("years"))


def missing_pairs(
    spark: SparkSession,
    manifest: DataFrame,
    metrics: Sequence[str],
    start_year: int,
    end_year: int,
) -> DataFrame:
    """Requested (metric, year) pairs that the manifest lacks, with the request order."""
    check_years(start_year, end_year)
    requested = (
        spark.range(1)
        .select(F.posexplode(F.array(*map(F.lit, metrics))).alias("request_order", "metric"))
        .withColumn("year", F.explode(F.sequence(F.lit(start_year), F.lit(end_year))))
    )
    return requested.join(manifest, ["metric", "year"], "left_anti")


def pending_metrics(
    spark: SparkSession,
    manifest: DataFrame,
    metrics: Sequence[str],
    start_year: int,
    end_year: int,
) -> DataFrame:
    """Metrics with at least one unfinished year: (metric, request_order, missing_years)."""
    missing = missing_pairs(spark, manifest, check_metrics(metrics), start_year, end_year)
    return missing.groupBy("metric", "request_order").agg(
        F.count(F.lit(1)).cast("int").alias("missing_years")
    )


def read_setup(spark: SparkSession, root: str) -> StoreSetup | None:
    stored = stored_or_none(spark, f"{root}/setup", SETUP)
    return None if stored is None else StoreSetup(**stored.first().asDict())


def check_store(spark: SparkSession, root: str, asked: StoreSetup) -> None:
    """A store keeps what it was set up for first; anything else is an error."""
    known = read_setup(spark, root)
    if known is None:
        row = few_rows(spark, [tuple(asdict(asked).values())], SETUP)
        row.coalesce(1).write.mode("overwrite").parquet(f"{root}/setup")
        return
    if (known.start_year, known.end_year) != (asked.start_year, asked.end_year):
        raise ValueError(
            f"the store at {root} covers {known.start_year}-{known.end_year}, "
            f"which does not match {asked.start_year}-{asked.end_year}"
        )
    rules = ("min_valid_hours", "tile_rows", "tile_cols", "block_rows")
    for name in rules:
        if getattr(known, name) != getattr(asked, name):
            raise ValueError(
                f"the store at {root} has {name} {getattr(known, name)}, which does not match {getattr(asked, name)}"
            )
    if known.grid != asked.grid:
        raise ValueError(f"the store at {root} has another grid")
    if known.region != asked.region:
        raise ValueError(f"the store at {root} belongs to another region")


def gap_report(
    daily: DataFrame,
    region_cells: DataFrame,
    metrics: Sequence[str],
    start_year: int,
    end_year: int,
) -> DataFrame:
    """Incomplete and fully missing cell-days per year, summed over the metrics.

    A cell-day without any row counts as fully missing. Their number follows
    from cells x days x metrics minus what is there, so the dense cube is never
    built. 24 is meant literally, whatever coverage the statistics asked for.
    """
    check_years(start_year, end_year)
    metrics = list(metrics)
    present = (
        keep_inside(daily.where(F.col("metric").isin(metrics)), region_cells)
        .groupBy("year")
        .agg(
            F.count_if(F.col("valid_hours") >= HOURS_PER_DAY).alias("complete"),
            F.count_if(F.col("valid_hours") > 0).alias("covered"),
        )
    )
    n_cells = region_cells.where("inside").agg(F.count(F.lit(1))).scalar()
    days = F.date_diff(
        F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)),
        F.make_date(F.col("year"), F.lit(1), F.lit(1)),
    )
    years = daily.sparkSession.range(start_year, end_year + 1).select(
        F.col("id").cast("int").alias("year")
    )
    expected = days.cast("bigint") * n_cells * len(metrics)
    return years.join(present, "year", "left").select(
        "year",
        (expected - F.coalesce("complete", F.lit(0))).alias("incomplete_cell_days"),
        (expected - F.coalesce("covered", F.lit(0))).alias("fully_missing_cell_days"),
    )


def describe(
    daily: DataFrame,
    metrics: Iterable[str],
    units: Mapping[str, str] | None = None,
) -> DataFrame:
    """Attach units and a description to the columns of a wide daily table.

    ``units`` by metric are those of the registered metrics unless given.
    """
    if units is None:
        units = {name: METRICS[name].units for name in check_metrics(metrics)}
    for name in metrics:
        readable = name.replace("_", " ")
        for statistic in STATISTICS:
            daily = daily.withMetadata(
                f"{name}_{statistic}",
                {
                    "units": units[name],
                    "source_timestep": "hourly",
                    "description": f"{statistic} of the hourly {readable} of one UTC day",
                },
            )
        daily = daily.withMetadata(
            f"{name}_valid_hours",
            {
                "units": "hours",
                "source_timestep": "hourly",
                "description": f"hours of the UTC day with a value of {readable}",
            },
        )
    return daily

"""The incremental run: hourly table to stored daily statistics."""

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.functions.metrics import METRICS, MetricSpec, select_metrics
from heatgrid.operators.calendar import check_years
from heatgrid.operators.checks import check_year
from heatgrid.operators.daily import daily_metrics, to_long
from heatgrid.operators.region import Extent, keep_in_runs, region_runs
from heatgrid.operators.tiles import keep_occupied, keep_tiles
from heatgrid.schema import HOURS_PER_DAY, TILE_ID, TILE_SHAPE
from heatgrid.session import in_parallel, remove
from heatgrid.sources.daily_store import (
    StoreSetup,
    check_store,
    current_records,
    new_attempt,
    record_completed,
    record_units,
    remove_superseded,
    write_daily,
)
from heatgrid.sources.hourly import select_hourly
from heatgrid.sources.region_index import RegionIndex, index_region

PARALLEL_YEARS = 4


@dataclass(frozen=True)
class YearReport:
    """What one finished year wrote, where it has gaps, and how many tiles were read of how many."""

    year: int
    metrics: tuple[str, ...]
    incomplete_cell_days: int
    fully_missing_cell_days: int
    tiles_read: int
    tiles_skipped: int


@dataclass(frozen=True)
class Run:
    """What all years of a run share."""

    spark: SparkSession
    hourly: DataFrame
    index: RegionIndex
    root: str
    tile_shape: tuple[int, int]
    min_valid_hours: int
    registry: Mapping[str, MetricSpec]
    block_rows: int
    recording: Lock


def daily_in_region(
    hourly: DataFrame,
    region_cells: DataFrame,
    metrics: Iterable[str],
    tile_shape: tuple[int, int] = TILE_SHAPE,
    min_valid_hours: int = HOURS_PER_DAY,
    registry: Mapping[str, MetricSpec] = METRICS,
    with_hours: bool = False,
) -> DataFrame:
    """Daily statistics of the cells inside the region.

    Empty tiles go first, by a join that prunes partitions where the table is
    partitioned by tile. The region as runs of cells then drops the rows outside
    before anything is derived. ``with_hours`` leaves repeated hours to the caller.
    """
    inside = keep_in_runs(keep_occupied(hourly, region_cells, tile_shape), region_runs(region_cells))
    return _reduced(inside, metrics, min_valid_hours, registry, with_hours)


def _reduced(
    inside: DataFrame,
    metrics: Iterable[str],
    min_valid_hours: int,
    registry: Mapping[str, MetricSpec],
    with_hours: bool,
) -> DataFrame:
    return daily_metrics(
        inside.drop(TILE_ID),
        list(metrics),
        min_valid_hours=min_valid_hours,
        registry=registry,
        reject_repeated_hours=not with_hours,
        with_hours=with_hours,
    )


def daily_of_block(run: Run, year: int, metrics: Iterable[str], block: int) -> DataFrame:
    """Daily statistics of a year for one block of tile rows, from the stored index of the region."""
    extent, tiles = run.index.extent, run.index.tiles
    if run.block_rows:
        rows = run.block_rows * run.tile_shape[0]
        start, stop = max(extent.lat_start, block * rows), min(extent.lat_stop, (block + 1) * rows)
        extent = Extent(start, stop, extent.lon_start, extent.lon_stop)
        tiles = tiles.where(F.call_function("div", F.col("tile_row"), F.lit(run.block_rows)) == block)
    chosen = select_hourly(run.hourly, [year], metrics, extent, registry=run.registry)
    inside = keep_in_runs(keep_tiles(chosen, tiles, run.tile_shape), run.index.runs)
    return _reduced(inside, metrics, run.min_valid_hours, run.registry, with_hours=True)


def finish_block(run: Run, year: int, metrics: tuple[str, ...], block: int) -> dict[str, tuple[int, int]]:
    """Compute, check, write and record one block of a year; its complete and covered cell-days by metric."""
    attempt = new_attempt()
    staged = f"{run.root}/staged-{attempt}"
    daily = daily_of_block(run, year, metrics, block)
    try:
        daily.write.parquet(staged)
        daily = run.spark.read.schema(daily.schema).parquet(staged)
        counts = check_year(daily, year, metrics)
        if counts is None:
            if not run.block_rows or run.hourly.where(F.col("year") == year).isEmpty():
                raise ValueError(f"there are no hours for {year}")
            # Hours there are, only none of this block.
            counts, attempt = dict.fromkeys(metrics, (0, 0)), ""
        else:
            write_daily(to_long(daily, metrics, run.tile_shape), run.root, attempt, run.block_rows)
    finally:
        remove(run.spark, staged)
    with run.recording:  # two writes to one folder at a time would disturb each other
        record_completed(run.spark, run.root, metrics, [year], attempt, block, counts)
    return counts


def run_daily(
    spark: SparkSession,
    hourly: DataFrame,
    region_cells: DataFrame,
    root: str,
    metrics: str | Iterable[str],
    start_year: int,
    end_year: int,
    tile_shape: tuple[int, int] = TILE_SHAPE,
    min_valid_hours: int = HOURS_PER_DAY,
    registry: Mapping[str, MetricSpec] = METRICS,
    block_rows: int = 0,
    parallel_years: int = PARALLEL_YEARS,
) -> list[YearReport]:
    """Compute and store what the store at ``root`` still lacks; report per year.

    ``hourly`` is a scan of the hourly table, ``region_cells`` the stored region. A store belongs to one
    region; another one is an error. One job per year reduces the hours for all metrics pending for it, to
    a table beside the store. That is checked first: a year without hours, with days of another year,
    repeated hours or incomplete days is an error and changes nothing. Then it is written as an attempt,
    which counts once it is recorded.

    With ``block_rows`` a year is done in blocks of so many rows of tiles, each recorded by itself, so that
    a lost run repeats at most the blocks under way; without it, at most the years under way. Up to
    ``parallel_years`` years share the executors.
    """
    names = select_metrics(metrics, registry)
    check_years(start_year, end_year)
    index = index_region(spark, f"{root}/region", region_cells, tile_shape)
    blocks = [0]
    if block_rows:
        row = F.call_function("div", F.col("tile_row"), F.lit(block_rows)).cast("int")
        blocks = sorted(row.block for row in index.tiles.select(row.alias("block")).distinct().collect())
    asked = StoreSetup(
        start_year, end_year, min_valid_hours, *tile_shape, block_rows, len(blocks), index.grid_print, index.region_print
    )
    check_store(spark, root, asked)
    remove_superseded(spark, root)

    # At most metrics x years x blocks.
    done = {(r.year, r.metric, r.block): (r.complete, r.covered) for r in current_records(spark, root)}
    pending: dict[int, list[str]] = {}
    for year in range(start_year, end_year + 1):
        missing = [name for name in names if any((year, name, block) not in done for block in blocks)]
        if missing:
            pending[year] = missing
    if not pending:
        return []
    record_units(spark, root, {name for missing in pending.values() for name in missing}, registry)
    run = Run(spark, hourly, index, root, tile_shape, min_valid_hours, registry, block_rows, Lock())

    def finish_year(year: int, wanted: list[str]) -> YearReport:
        complete = covered = 0
        for block in blocks:
            known = {name: done[year, name, block] for name in wanted if (year, name, block) in done}
            lacking = tuple(name for name in wanted if name not in known)
            if lacking:
                known |= finish_block(run, year, lacking, block)
            complete += sum(counts[0] for counts in known.values())
            covered += sum(counts[1] for counts in known.values())
        cell_days = (date(year + 1, 1, 1) - date(year, 1, 1)).days * index.cells * len(wanted)
        return YearReport(
            year, tuple(wanted), cell_days - complete, cell_days - covered, index.tiles_read, index.tiles_skipped
        )

    return in_parallel(
        spark, [lambda y=year, w=wanted: finish_year(y, w) for year, wanted in pending.items()], parallel_years
    )

"""Hourly observations: cleaning, scanning and laying them out."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.functions.metrics import METRICS, required_variables
from heatgrid.operators.calendar import in_utc
from heatgrid.operators.region import Extent, crop
from heatgrid.operators.tiles import with_tile_id
from heatgrid.schema import (
    CELL,
    HOURLY,
    SOURCE_VARIABLES,
    TILE_ID,
    TILE_SHAPE,
    TILED_HOURLY,
    VARIABLES,
    conform,
)
from heatgrid.session import exists

# Cells of a tile whose hours go to one file together: four rows of the default tile.
BAND_CELLS = 1024


def finite_or_null(value: Column) -> Column:
    """NULL for NaN and for both infinities.

    Spark orders NaN above every number, counts it as a value and lets it win
    every maximum, so it must not get past the reader.
    """
    return F.when(F.abs(value) < float("inf"), value)


def clean(raw: DataFrame) -> DataFrame:
    """Source names to ours, variables as finite doubles or NULL, ``ts`` as UTC time; other columns stay."""
    named = raw.withColumnsRenamed(SOURCE_VARIABLES)
    if "ts" in named.columns:
        named = in_utc(named)
    present = [name for name in named.columns if name in VARIABLES]
    return named.withColumns(
        {name: finite_or_null(F.col(name).cast("double")) for name in present}
    )


def widen(
    long: DataFrame,
    variables: Sequence[str] = VARIABLES,
    keys: Sequence[str] = ("lat_idx", "lon_idx", "ts"),
) -> DataFrame:
    """Rows of (keys, variable, value) to one column per variable."""
    return (
        long.where(F.col("variable").isin(list(variables)))
        .groupBy(*keys)
        .agg(*(F.max(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in variables))
    )


def select_hourly(
    hourly: DataFrame,
    years: Iterable[int],
    metrics: Iterable[str],
    extent: Extent | None = None,
    keys: Sequence[str] = ("lat_idx", "lon_idx", "ts"),
    registry=METRICS,
) -> DataFrame:
    """Only the years, cells and variables that the metrics need.

    All three are plain filters and projections: years prune partitions, index
    ranges prune row groups, variables prune columns.
    """
    chosen = hourly.where(F.col("year").isin(list(years)))
    if extent is not None:
        chosen = crop(chosen, extent)
    tile = [TILE_ID] if TILE_ID in hourly.columns else []
    return chosen.select(*keys, *tile, *required_variables(metrics, registry))


def scan_hourly(spark: SparkSession, path: str) -> DataFrame:
    """A stored hourly table with its declared schema, cleaned."""
    return clean(spark.read.schema(TILED_HOURLY).parquet(path))


def write_hourly(
    hourly: DataFrame,
    path: str,
    shape: tuple[int, int] = TILE_SHAPE,
    partitions: int | None = None,
    replace: bool = False,
) -> None:
    """Partition by year and tile, sort by cell and hour. The year is that of ``ts``, in UTC.

    Rows are spread by (year, tile, band of the tile), which Spark joins into partitions of even size
    without sampling, so that a year or tile far larger than the others becomes more files. A band has some
    BAND_CELLS cells, so that small tiles are one file and not as many as they have rows. All hours of a
    cell share a file: the daily aggregation then combines the hours of a cell-day before its shuffle.
    ``partitions`` fixes the number of ranges of (year, tile, cell) instead.

    A delivery replaces whole years: for a year that is there already, ``replace`` has to say so, since
    half a year would take the place of the other half.
    """
    spark = hourly.sparkSession
    named = in_utc(hourly).withColumn("year", F.year("ts"))
    if not replace and exists(spark, path):
        there = spark.read.schema(TILED_HOURLY).parquet(path).select("year").distinct()
        twice = named.select("year").distinct().join(there, "year").orderBy("year").first()
        if twice is not None:
            raise ValueError(f"{path} already has hours of {twice.year}; replace=True replaces them")
    tiled = with_tile_id(conform(named, HOURLY), shape)
    if partitions:
        spread = tiled.repartitionByRange(partitions, "year", TILE_ID, *CELL)
    else:
        rows, cols = shape
        height = -(-rows // max(1, round(rows * cols / BAND_CELLS)))
        band = F.call_function("div", F.col("lat_idx") % rows, F.lit(height))
        spread = tiled.withColumn("_band", band).hint("rebalance", "year", TILE_ID, "_band").drop("_band")
    (
        spread.sortWithinPartitions("year", TILE_ID, *CELL, "ts")
        .write.partitionBy("year", TILE_ID)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def save_bucketed(hourly: DataFrame, table: str, buckets: int) -> None:
    """A catalog table bucketed by cell: daily aggregation and cell joins need no shuffle.

    For repeated work on a table with one row per cell and hour, where buckets
    are even by construction.
    """
    (
        conform(in_utc(hourly), HOURLY).repartition(buckets, *CELL)
        .sortWithinPartitions(*CELL, "ts")
        .write.partitionBy("year")
        .bucketBy(buckets, *CELL)
        .sortBy(*CELL)
        .mode("overwrite")
        .saveAsTable(table)
    )

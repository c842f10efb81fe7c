"""Restricting rows to a region: extents, masks and bounding boxes."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heatgrid.schema import CELL, VARIABLES

# Runs of cells are cut at multiples of this many columns, so that they can be joined on equal keys.
RUN_COLUMNS = 256


@dataclass(frozen=True)
class Extent:
    """Half-open index ranges on both axes."""

    lat_start: int
    lat_stop: int
    lon_start: int
    lon_stop: int


def crop(df: DataFrame, extent: Extent) -> DataFrame:
    """Rows within the extent; plain comparisons, so they reach the scan."""
    lat, lon = F.col("lat_idx"), F.col("lon_idx")
    return df.where(
        (lat >= extent.lat_start)
        & (lat < extent.lat_stop)
        & (lon >= extent.lon_start)
        & (lon < extent.lon_stop)
    )


def inside_cells(region_cells: DataFrame) -> DataFrame:
    return region_cells.where("inside").select(*CELL)


def _block(lon: Column | str) -> Column:
    return F.call_function("div", lon, F.lit(RUN_COLUMNS))


def region_runs(region_cells: DataFrame) -> DataFrame:
    """The region as runs of neighbouring cells: (run_lat, run_block, lon_first, lon_last).

    A region is far fewer runs than cells, and a row is inside at most one of them. The window sees one
    row of the grid.
    """
    along = W.partitionBy("lat_idx", "run_block").orderBy("lon_idx")
    return (
        inside_cells(region_cells)
        .withColumn("run_block", _block(F.col("lon_idx")))
        .withColumn("island", F.col("lon_idx") - F.dense_rank().over(along))
        .groupBy("lat_idx", "run_block", "island")
        .agg(F.min("lon_idx").alias("lon_first"), F.max("lon_idx").alias("lon_last"))
        .select(F.col("lat_idx").alias("run_lat"), "run_block", "lon_first", "lon_last")
    )


def _in_run() -> Column:
    return (
        (F.col("lat_idx") == F.col("run_lat"))
        & (_block(F.col("lon_idx")) == F.col("run_block"))
        & (F.col("lon_idx") >= F.col("lon_first"))
        & (F.col("lon_idx") <= F.col("lon_last"))
    )


def mask_outside(hourly: DataFrame, region_cells: DataFrame) -> DataFrame:
    """Keep every row, with the variables NULL outside the region."""
    inside = F.col("run_lat").isNotNull()
    variables = [name for name in hourly.columns if name in VARIABLES]
    masked = [F.when(inside, F.col(name)).alias(name) for name in variables]
    others = [name for name in hourly.columns if name not in VARIABLES]
    return hourly.join(region_runs(region_cells), _in_run(), "left").select(*others, *masked)


def keep_inside(df: DataFrame, region_cells: DataFrame) -> DataFrame:
    """Drop the rows outside the region. Spark picks the join by the size of the runs."""
    return keep_in_runs(df, region_runs(region_cells))


def keep_in_runs(df: DataFrame, runs: DataFrame) -> DataFrame:
    """Drop the rows outside a region given as ``region_runs``, which may be stored."""
    return df.join(runs, _in_run(), "left_semi")


def _snap_down(start: Column, size: int) -> Column:
    return F.call_function("div", start, F.lit(size)) * size


def _snap_up(stop: Column, size: int, axis_size: Column) -> Column:
    return F.least(F.call_function("div", stop + (size - 1), F.lit(size)) * size, axis_size)


def bounding_box(region_cells: DataFrame, tile_shape: tuple[int, int] | None = None) -> DataFrame:
    """One row with the extent of the selected cells, NULL if there are none.

    With ``tile_shape`` the box grows to whole tiles, but never past the grid
    that ``region_cells`` lists.
    """
    return snapped_box(region_cells, tile_shape)


def snapped_box(region_cells: DataFrame, tile_shape: tuple[int, int] | None, *more: Column) -> DataFrame:
    """``bounding_box`` and further aggregates over all cells, in one pass."""
    inside = F.col("inside")
    facts = region_cells.agg(
        *more,
        *(
            column
            for axis in ("lat", "lon")
            for column in (
                F.min(F.when(inside, F.col(f"{axis}_idx"))).alias(f"{axis}_start"),
                (F.max(F.when(inside, F.col(f"{axis}_idx"))) + 1).alias(f"{axis}_stop"),
                (F.max(f"{axis}_idx") + 1).alias(f"{axis}_size"),
            )
        ),
    )
    columns = [name for name in facts.columns if not name.startswith(("lat_", "lon_"))]
    for axis, size in zip(("lat", "lon"), tile_shape or (1, 1)):
        start, stop = F.col(f"{axis}_start"), F.col(f"{axis}_stop")
        if tile_shape:
            # least() skips NULL: without the guard an empty region would get an extent.
            grown = F.when(stop.isNotNull(), _snap_up(stop, size, F.col(f"{axis}_size")))
            start, stop = _snap_down(start, size), grown
        columns += [
            start.cast("int").alias(f"{axis}_start"),
            stop.cast("int").alias(f"{axis}_stop"),
        ]
    return facts.select(*columns)


def region_extent(region_cells: DataFrame, tile_shape: tuple[int, int] | None = None) -> Extent:
    """The bounding box as plain numbers; ValueError for a region without cells."""
    box = bounding_box(region_cells, tile_shape).first()
    if box.lat_start is None:
        raise ValueError("the region has no selected cells")
    return Extent(*box)

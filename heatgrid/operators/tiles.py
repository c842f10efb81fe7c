"""Tiles of the grid: which hold selected cells, and the rectangles they form."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heatgrid.schema import TILE, TILE_ID, TILE_SHAPE

# Readable numbers: tile 3000005 is row 3, column 5.
ROW_STRIDE = 1_000_000


def tile_of(index: str, size: int) -> Column:
    return F.call_function("div", F.col(index), F.lit(size)).cast("int")


def with_tile(df: DataFrame, shape: tuple[int, int] = TILE_SHAPE) -> DataFrame:
    rows, cols = shape
    return df.withColumns(
        {"tile_row": tile_of("lat_idx", rows), "tile_col": tile_of("lon_idx", cols)}
    )


def with_tile_id(df: DataFrame, shape: tuple[int, int] = TILE_SHAPE) -> DataFrame:
    """Row and column of the tile as one number.

    A table partitioned by one column loses exactly the empty tiles to run-time
    pruning; by two, only rows and columns of tiles that are empty throughout.
    """
    rows, cols = shape
    return df.withColumn(TILE_ID, tile_id(tile_of("lat_idx", rows), tile_of("lon_idx", cols)))


def tile_id(row: Column | str, col: Column | str) -> Column:
    row, col = (F.col(c) if isinstance(c, str) else c for c in (row, col))
    return row.cast("bigint") * ROW_STRIDE + col


def tile_row_of(tile: str = TILE_ID) -> Column:
    return F.call_function("div", F.col(tile), F.lit(ROW_STRIDE)).cast("int")


def tile_number(cell: tuple[int, int], shape: tuple[int, int] = TILE_SHAPE) -> int:
    """The tile of one cell, as in ``with_tile_id``."""
    return cell[0] // shape[0] * ROW_STRIDE + cell[1] // shape[1]


def occupied_tiles(region_cells: DataFrame, shape: tuple[int, int] = TILE_SHAPE) -> DataFrame:
    """Tiles with at least one selected cell."""
    return with_tile(region_cells.where("inside"), shape).select(*TILE).distinct()


def _runs(tiles: DataFrame) -> DataFrame:
    """Merge horizontally adjacent occupied tiles; a gap starts a new run.

    The window sees tiles, not cells: a partition holds at most as many rows as
    the grid has tile columns.
    """
    along_row = W.partitionBy("tile_row").orderBy("tile_col")
    return (
        tiles.withColumn("island", F.col("tile_col") - F.row_number().over(along_row))
        .groupBy("tile_row", "island")
        .agg(
            F.min("tile_col").alias("first_col"),
            F.max("tile_col").alias("last_col"),
            F.count(F.lit(1)).alias("tiles"),
        )
    )


def occupied_blocks(region_cells: DataFrame, shape: tuple[int, int] = TILE_SHAPE) -> DataFrame:
    """Rectangles of occupied tiles as half-open index ranges.

    ``region_cells`` lists the whole grid; the last tile is cut at its edge. ValueError for a region
    without cells.
    """
    if region_cells.where("inside").isEmpty():
        raise ValueError("the region has no selected cells")
    rows, cols = shape
    lat_size = region_cells.agg(F.max("lat_idx") + 1).scalar()
    lon_size = region_cells.agg(F.max("lon_idx") + 1).scalar()
    return _runs(occupied_tiles(region_cells, shape)).select(
        "tile_row",
        (F.col("tile_row") * rows).alias("lat_start"),
        F.least((F.col("tile_row") + 1) * rows, lat_size).alias("lat_stop"),
        (F.col("first_col") * cols).alias("lon_start"),
        F.least((F.col("last_col") + 1) * cols, lon_size).alias("lon_stop"),
    )


def tile_coverage(region_cells: DataFrame, shape: tuple[int, int] = TILE_SHAPE) -> DataFrame:
    """One row: blocks, tiles they cover, tiles of the bounding box, tiles skipped.

    ValueError for a region without cells.
    """
    if region_cells.where("inside").isEmpty():
        raise ValueError("the region has no selected cells")
    return tile_runs_coverage(occupied_tiles(region_cells, shape))


def tile_runs_coverage(tiles: DataFrame) -> DataFrame:
    """``tile_coverage`` from the occupied tiles."""
    summary = _runs(tiles).agg(
        F.count(F.lit(1)).alias("blocks"),
        F.coalesce(F.sum("tiles"), F.lit(0)).alias("covered"),
        (
            (F.max("tile_row") - F.min("tile_row") + 1)
            * (F.max("last_col") - F.min("first_col") + 1)
        )
        .cast("bigint")
        .alias("total"),
    )
    return summary.withColumn("skipped", F.col("total") - F.col("covered"))


def keep_occupied(
    df: DataFrame,
    region_cells: DataFrame,
    shape: tuple[int, int] = TILE_SHAPE,
) -> DataFrame:
    """Rows in tiles with a selected cell.

    On a table partitioned by tile the join prunes partitions. Spark tries that
    only if the other side has a comparison among its filters, which a boolean
    column alone is not; indices are never negative.
    """
    stored = TILE_ID in df.columns
    tiled = df if stored else with_tile_id(df, shape)
    selected = region_cells.where(F.col("inside") & (F.col("lat_idx") >= 0))
    occupied = with_tile_id(selected, shape).select(TILE_ID).distinct()
    return tiled.join(occupied, TILE_ID, "left_semi").select(*df.columns)


def keep_tiles(df: DataFrame, tiles: DataFrame, shape: tuple[int, int] = TILE_SHAPE) -> DataFrame:
    """``keep_occupied`` for the occupied tiles themselves, which may be stored: rows with their ``TILE_ID``."""
    tiled = df if TILE_ID in df.columns else with_tile_id(df, shape)
    # As above: the comparison makes Spark try to prune partitions.
    wanted = tiles.where(F.col(TILE_ID) >= 0).select(TILE_ID)
    return tiled.join(wanted, TILE_ID, "left_semi").select(*df.columns)

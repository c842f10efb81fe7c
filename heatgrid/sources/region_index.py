"""What a run needs of its region, worked out once and stored beside it.

A folder per region and tile shape, named by the region's fingerprint, holds the region as runs of cells,
its occupied tiles, and one row of facts, written last. Runs and reports of every year read these tables;
the cells themselves are read once per run, to see which region they are.
"""

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.operators.identity import print_of
from heatgrid.operators.region import Extent, region_runs, snapped_box
from heatgrid.operators.tiles import occupied_tiles, tile_id, tile_runs_coverage
from heatgrid.schema import REGION_CELLS, TILE_ID, TILE_SHAPE, conform
from heatgrid.session import in_parallel
from heatgrid.sources.boundary import stored_or_none

RUNS = "run_lat int, run_block bigint, lon_first int, lon_last int"
TILES = f"tile_row int, tile_col int, {TILE_ID} bigint"
FACTS = "tiles_read bigint, tiles_skipped bigint"


@dataclass(frozen=True)
class RegionIndex:
    """A region as stored tables and numbers."""

    grid_print: str
    region_print: str
    cells: int
    extent: Extent
    tiles_read: int
    tiles_skipped: int
    runs: DataFrame
    tiles: DataFrame


def index_region(
    spark: SparkSession, root: str, region_cells: DataFrame, tile_shape: tuple[int, int] = TILE_SHAPE
) -> RegionIndex:
    """The index of a region below ``root``, built if it is not there; ValueError for a region without cells."""
    cells = conform(region_cells, REGION_CELLS)
    columns = REGION_CELLS.names
    facts = snapped_box(
        cells,
        tile_shape,
        print_of(columns[:-1]).alias("grid_print"),
        print_of(columns).alias("region_print"),
        F.count_if("inside").alias("cells"),
    ).first()
    if not facts.cells:
        raise ValueError("the region has no selected cells")
    name = hashlib.sha256(facts.region_print.encode()).hexdigest()[:24]
    path = f"{root}/{name}-{tile_shape[0]}x{tile_shape[1]}"
    stored = stored_or_none(spark, f"{path}/facts", FACTS)
    if stored is None:
        tiles = occupied_tiles(cells, tile_shape).withColumn(TILE_ID, tile_id("tile_row", "tile_col"))
        tables = {"runs": region_runs(cells), "tiles": tiles.coalesce(1)}
        writes = [lambda n=name, t=table: t.write.mode("overwrite").parquet(f"{path}/{n}") for name, table in tables.items()]
        in_parallel(spark, writes, len(writes))
        counted = tile_runs_coverage(spark.read.schema(TILES).parquet(f"{path}/tiles"))
        counted.select(F.col("covered").alias("tiles_read"), F.col("skipped").alias("tiles_skipped")).coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/facts")
        stored = spark.read.schema(FACTS).parquet(f"{path}/facts")
    tiles_read, tiles_skipped = stored.first()
    return RegionIndex(
        facts.grid_print,
        facts.region_print,
        facts.cells,
        Extent(facts.lat_start, facts.lat_stop, facts.lon_start, facts.lon_stop),
        tiles_read,
        tiles_skipped,
        spark.read.schema(RUNS).parquet(f"{path}/runs"),
        spark.read.schema(TILES).parquet(f"{path}/tiles"),
    )

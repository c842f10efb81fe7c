"""Region boundaries: polygon tables, and the stored region they lead to."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from heatgrid.operators.checks import check_same_grid
from heatgrid.operators.polygons import (
    cells_in_polygons,
    edges_of,
    reproject,
    vertices_of,
)
from heatgrid.schema import POLYGONS, REGION_CELLS, conform
from heatgrid.session import exists


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """Polygons of every feature, a missing table being an error at once."""
    return spark.read.schema(POLYGONS).parquet(path)


def stored_or_none(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at the path; None if there is none, or only what a write that broke off has left."""
    if not exists(spark, f"{path}/_SUCCESS"):
        return None
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def region_from_vertices(vertices: DataFrame, grid: DataFrame, in_metres: bool = False) -> DataFrame:
    """The grid with ``inside``, from boundary vertices in degrees or Web Mercator metres."""
    return cells_in_polygons(edges_of(reproject(vertices) if in_metres else vertices), grid)


def build_region(
    spark: SparkSession,
    path: str,
    grid: DataFrame,
    polygons: DataFrame | None = None,
    in_metres: bool = False,
) -> DataFrame:
    """The region stored at ``path``, built from the polygons and stored if absent.

    A stored region is used only for exactly the grid it was built on, cell by cell. One whose write
    broke off counts as absent.
    """
    stored = stored_or_none(spark, path, REGION_CELLS)
    if stored is not None:
        check_same_grid(grid, stored)
        return stored
    if polygons is None:
        raise ValueError(f"no region at {path} and no polygons to build it from")
    region = region_from_vertices(vertices_of(polygons), grid, in_metres)
    conform(region, REGION_CELLS).write.mode("overwrite").parquet(path)
    return spark.read.schema(REGION_CELLS).parquet(path)

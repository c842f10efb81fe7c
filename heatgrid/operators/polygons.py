"""Boundary polygons to grid cells.

A cell lies in a polygon when a ray towards increasing longitude crosses the
polygon's rings an odd number of times, all rings counted together, so that a
hole cancels its exterior. A cell lies in the region when any polygon holds it.
An edge is crossed at latitude ``lat`` iff ``min(y) < lat <= max(y)``, and by a
cell at ``lon`` iff ``lon`` is not beyond the crossing.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heatgrid.operators.joins import size_checked
from heatgrid.schema import CELL

# Fixed value: sphere radius of Web Mercator in metres.
MERCATOR_RADIUS_M = 6378137.0

RING = ("poly_id", "ring_id")


def vertices_of(polygons: DataFrame) -> DataFrame:
    """Flatten nested rings to one row per vertex; no part and no hole is lost."""
    rings = polygons.select("poly_id", F.posexplode("rings").alias("ring_id", "ring"))
    return rings.select(*RING, F.posexplode("ring").alias("pos", "v")).select(
        *RING, "pos", F.col("v.x").alias("x"), F.col("v.y").alias("y")
    )


def lonlat_from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    lon = F.degrees(x / MERCATOR_RADIUS_M)
    lat = F.degrees(F.atan(F.exp(y / MERCATOR_RADIUS_M)) * 2.0 - F.pi() / 2.0)
    return lon, lat


def reproject(vertices: DataFrame) -> DataFrame:
    """Vertices from Web Mercator metres to degrees."""
    lon, lat = lonlat_from_mercator(F.col("x"), F.col("y"))
    return vertices.withColumns({"x": lon, "y": lat})


def edges_of(vertices: DataFrame) -> DataFrame:
    """Each vertex with its successor on the ring, and the last with the first.

    Positions on a ring are consecutive. Successors come from an equi join on
    the position, not from a window over the ring: one coastline may hold most
    of all vertices and must not end up in one task.
    """
    successor = vertices.select(
        *RING, (F.col("pos") - 1).alias("pos"), F.col("x").alias("x2"), F.col("y").alias("y2")
    )
    along = vertices.withColumnsRenamed({"x": "x1", "y": "y1"}).join(
        successor.hint("merge"), [*RING, "pos"]
    )
    closing = vertices.groupBy(*RING).agg(
        F.max("pos").alias("pos"),
        F.max_by("x", "pos").alias("x1"),
        F.max_by("y", "pos").alias("y1"),
        F.min_by("x", "pos").alias("x2"),
        F.min_by("y", "pos").alias("y2"),
    )
    return along.unionByName(closing)


def polygon_extent(vertices: DataFrame) -> DataFrame:
    return vertices.groupBy("poly_id").agg(
        F.min("x").alias("min_x"),
        F.max("x").alias("max_x"),
        F.min("y").alias("min_y"),
        F.max("y").alias("max_y"),
    )


def grid_axes(cells: DataFrame) -> DataFrame:
    """Both coordinate axes of a grid as (axis, idx, coordinate), each point once."""
    axes = F.array(
        F.struct(F.lit("latitude").alias("axis"), F.col("lat_idx").alias("idx"),
                 F.col("latitude").alias("coordinate")),
        F.struct(F.lit("longitude").alias("axis"), F.col("lon_idx").alias("idx"),
                 F.col("longitude").alias("coordinate")),
    )
    return cells.select(F.inline(axes)).distinct()


def _falling(axis: Column) -> Column:
    """How often the next point of an axis has no larger coordinate."""
    following = F.slice(axis, F.lit(2), F.size(axis))
    pairs = F.zip_with(axis, following, lambda a, b: b["coordinate"] <= a["coordinate"])
    return F.size(F.filter(pairs, lambda falls: falls))


def _band(value: Column, width: float) -> Column:
    return F.floor(value / width)


def inside_runs(edges: DataFrame, grid: DataFrame) -> DataFrame:
    """Runs of cells (poly_id, lat_idx, lon_first, lon_last) inside each polygon.

    Scan-line conversion instead of cells against edges: an edge meets only the
    grid rows it spans, a crossing becomes the last column not beyond it, and
    the columns between two crossings follow from their order. The work is
    edges x rows spanned plus the runs themselves.

    Both look-ups are equi joins on bands of about one grid step, against one
    axis of the grid, which is thousands of rows where the grid is millions.
    Longitudes must increase with ``lon_idx``, which is checked.
    """
    axes = grid_axes(grid)
    facts = {
        row.axis: row
        for row in axes.groupBy("axis")
        .agg(
            _falling(F.sort_array(F.collect_list(F.struct("idx", "coordinate")))).alias("falling"),
            F.count(F.lit(1)).alias("points"),
            F.min("coordinate").alias("low"),
            F.max("coordinate").alias("high"),
            F.min("idx").alias("first_idx"),
        )
        .collect()
    }
    lat, lon = facts["latitude"], facts["longitude"]
    if lon.falling:
        raise ValueError("longitudes must increase with lon_idx")
    lat_step = (lat.high - lat.low) / max(lat.points - 1, 1) or 1.0
    lon_step = (lon.high - lon.low) / max(lon.points - 1, 1) or 1.0

    rows = axes.where("axis = 'latitude'").select(
        F.col("idx").alias("lat_idx"),
        F.col("coordinate").alias("latitude"),
        _band(F.col("coordinate"), lat_step).alias("band"),
    )
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded_edges = (
        edges.where((low < lat.high) & (high >= lat.low) & (F.col("y1") != F.col("y2")))
        .withColumns(
            {
                "first_band": _band(F.greatest(low, F.lit(lat.low)), lat_step),
                "last_band": _band(F.least(high, F.lit(lat.high)), lat_step),
            }
        )
        .select(
            "poly_id", "x1", "y1", "x2", "y2",
            F.explode(F.sequence("first_band", "last_band")).alias("band"),
        )
    )
    slanted = F.try_divide(
        (F.col("latitude") - F.col("y1")) * (F.col("x2") - F.col("x1")),
        F.col("y2") - F.col("y1"),
    ) + F.col("x1")
    crossing = F.when(F.col("x1") == F.col("x2"), F.col("x1")).otherwise(
        F.least(F.greatest("x1", "x2"), slanted)
    )
    crossings = (
        banded_edges.join(size_checked(rows, lat.points), "band")
        .where((F.col("latitude") > low) & (F.col("latitude") <= high))
        .select("poly_id", "lat_idx", crossing.alias("crossing"))
    )

    columns = axes.where("axis = 'longitude'").select("idx", "coordinate")
    following = columns.select(
        (F.col("idx") - 1).alias("idx"), F.col("coordinate").alias("next_coordinate")
    )
    last_band = _band(F.lit(lon.high), lon_step)
    column_bands = columns.join(following, "idx", "left").select(
        F.col("idx").alias("stop"),
        "coordinate",
        "next_coordinate",
        F.explode(
            F.sequence(
                _band(F.col("coordinate"), lon_step),
                _band(F.coalesce("next_coordinate", "coordinate"), lon_step),
            )
        ).alias("band"),
    )
    x = F.col("crossing")
    toggles = (
        crossings.where(x >= lon.low)
        .withColumn("band", F.least(_band(x, lon_step), last_band))
        .join(size_checked(column_bands, 2 * lon.points), "band")
        .where(
            (x >= F.col("coordinate"))
            & (F.col("next_coordinate").isNull() | (x < F.col("next_coordinate")))
        )
        # Counting before ordering bounds the window below by the columns of the grid.
        .groupBy("poly_id", "lat_idx", "stop")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n % 2 = 1")
    )
    from_east = W.partitionBy("poly_id", "lat_idx").orderBy(F.desc("stop"))
    return (
        toggles.withColumns(
            {"rank": F.row_number().over(from_east), "west": F.lead("stop").over(from_east)}
        )
        .where("rank % 2 = 1")
        .select(
            "poly_id",
            "lat_idx",
            F.coalesce(F.col("west") + 1, F.lit(lon.first_idx)).alias("lon_first"),
            F.col("stop").alias("lon_last"),
        )
    )


def cells_in_polygons(edges: DataFrame, grid: DataFrame) -> DataFrame:
    """Every grid cell with ``inside``: true in at least one polygon."""
    inside = (
        inside_runs(edges, grid)
        .select("lat_idx", F.explode(F.sequence("lon_first", "lon_last")).alias("lon_idx"))
        .distinct()
        .withColumn("inside", F.lit(True))
    )
    return grid.join(inside, list(CELL), "left").select(
        *CELL, "latitude", "longitude", F.coalesce("inside", F.lit(False)).alias("inside")
    )

"""Polygons, masks, bounding boxes and tiles."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import grid_frame, to_spark, weather
from heatgrid.operators import polygons, region, tiles
from heatgrid.schema import POLYGONS, REGION_CELLS, VERTICES, conform
from heatgrid.sources.boundary import build_region, read_polygons, region_from_vertices

SQUARE = [(-3.0, 2.0), (-3.0, 6.0), (1.0, 6.0), (1.0, 2.0)]


def grid_at(spark, latitudes, longitudes):
    lat, lon = (a.ravel() for a in np.meshgrid(np.arange(len(latitudes)), np.arange(len(longitudes)), indexing="ij"))
    return spark.createDataFrame(
        pd.DataFrame(
            {
                "lat_idx": lat.astype("int32"),
                "lon_idx": lon.astype("int32"),
                "latitude": np.asarray(latitudes, float)[lat],
                "longitude": np.asarray(longitudes, float)[lon],
            }
        )
    )


def vertex_table(spark, shapes):
    """``shapes``: per polygon a list of rings, a ring being a list of (x, y)."""
    rows = [
        (p, r, i, float(x), float(y))
        for p, rings in enumerate(shapes)
        for r, ring in enumerate(rings)
        for i, (x, y) in enumerate(ring)
    ]
    return spark.createDataFrame(rows, VERTICES)


def crossings(lon, lat, ring) -> int:
    count = 0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if min(y1, y2) < lat <= max(y1, y2) and lon <= max(x1, x2):
            count += x1 == x2 or lon <= (lat - y1) * (x2 - x1) / (y2 - y1) + x1
    return count


def brute_force(shapes, latitudes, longitudes) -> np.ndarray:
    return np.array(
        [
            [
                any(sum(crossings(lon, lat, ring) for ring in rings) % 2 for rings in shapes)
                for lon in longitudes
            ]
            for lat in latitudes
        ]
    )


def computed(spark, shapes, latitudes, longitudes) -> np.ndarray:
    cells = region_from_vertices(vertex_table(spark, shapes), grid_at(spark, latitudes, longitudes))
    frame = cells.toPandas().sort_values(["lat_idx", "lon_idx"])
    return frame.inside.to_numpy().reshape(len(latitudes), len(longitudes))


def test_edges_of_the_square_follow_the_half_open_rule(spark):
    """On grids that meet the edges of the square and on one that does not."""
    for step in (0.5, 1.0, 0.8):
        latitudes, longitudes = np.arange(0.0, 8.0, step), np.arange(-5.0, 3.0, step)
        got = computed(spark, [[SQUARE]], latitudes, longitudes)
        lat, lon = np.meshgrid(latitudes, longitudes, indexing="ij")
        # The low edges do not belong to the square, the high ones do.
        assert (got == ((lat > 2) & (lat <= 6) & (lon > -3) & (lon <= 1))).all()


def test_axes_are_not_swapped(spark):
    """A sliver that is long in longitude, on a grid whose two axes cannot be mistaken."""
    latitudes, longitudes = np.arange(-48.0, -40.0, 1.0), np.arange(150.0, 178.0, 0.5)
    sliver = [(152.2, -44.6), (152.2, -43.4), (175.8, -43.4), (175.8, -44.6)]
    got = computed(spark, [[sliver]], latitudes, longitudes)
    rows, columns = np.nonzero(got)
    assert set(latitudes[rows]) == {-44.0}
    assert (longitudes[columns].min(), longitudes[columns].max()) == (152.5, 175.5)


def test_hole_and_overlapping_polygons(spark):
    hole = [(-2.0, 3.0), (0.0, 3.0), (0.0, 5.0), (-2.0, 5.0)]
    other = [(-1.0, 4.0), (5.0, 4.0), (2.0, 9.0)]
    latitudes, longitudes = np.linspace(1.0, 9.5, 35), np.linspace(-4.0, 6.0, 41)
    for shapes in ([[SQUARE, hole]], [[SQUARE, hole], [other]], [[other], [SQUARE], [other]]):
        assert (computed(spark, shapes, latitudes, longitudes) == brute_force(shapes, latitudes, longitudes)).all()
    assert not computed(spark, [[SQUARE, hole]], [4.1], [-1.2]).any()
    assert computed(spark, [[SQUARE, hole]], [2.5], [-2.5]).all()


@pytest.mark.parametrize("seed", range(4))
def test_random_polygons_match_brute_force(spark, seed):
    """Self-crossing rings, one of them far larger, on grids they overhang on all sides."""
    rng = np.random.default_rng(seed)
    latitudes = np.sort(rng.uniform(0, 10, 23))
    longitudes = np.sort(rng.uniform(-5, 5, 17))

    def ring(n):
        return list(zip(rng.uniform(-8, 8, n).tolist(), rng.uniform(-3, 13, n).tolist()))

    shapes = [[ring(120)], [ring(5), ring(4)], [ring(3)], [[(1.0, 1.0)]]]
    # Vertices on grid lines, and vertical and horizontal edges.
    on_lines = [(longitudes[2], latitudes[3]), (longitudes[9], latitudes[3]), (longitudes[9], latitudes[12])]
    shapes.append([[(float(x), float(y)) for x, y in on_lines]])
    expected = brute_force(shapes, latitudes, longitudes)
    assert (computed(spark, shapes, latitudes, longitudes) == expected).all()
    assert 0 < expected.sum() < expected.size


def test_grid_outside_the_polygon(spark):
    assert not computed(spark, [[SQUARE]], [15.0, 16.0], [5.0, 6.0]).any()


def test_longitudes_must_increase(spark):
    with pytest.raises(ValueError, match="increase"):
        computed(spark, [[SQUARE]], [0.5], [0.6, 0.4])


def test_edges_close_each_ring(spark):
    shapes = [[[(0, 0), (0, 1), (1, 1)], [(5, 5), (6, 6)]]]
    edges = polygons.edges_of(vertex_table(spark, shapes)).orderBy("ring_id", "pos").collect()
    assert [tuple(e)[2:] for e in edges] == [
        (0, 0, 0, 0, 1), (1, 0, 1, 1, 1), (2, 1, 1, 0, 0), (0, 5, 5, 6, 6), (1, 6, 6, 5, 5),
    ]


def test_nested_polygons_flatten(spark):
    point = lambda x, y: {"x": x, "y": y}
    rows = [(7, [[point(0.0, 0.0), point(1.0, 0.0)], [point(2.0, 2.0)]])]
    got = polygons.vertices_of(spark.createDataFrame(rows, POLYGONS)).collect()
    assert sorted(map(tuple, got)) == [(7, 0, 0, 0.0, 0.0), (7, 0, 1, 1.0, 0.0), (7, 1, 0, 2.0, 2.0)]


def test_mercator(spark):
    rows = [(0, 0, 0, 0.0, 0.0), (0, 0, 1, -11131949.079327357, 3503549.843504374)]
    origin, west = polygons.reproject(spark.createDataFrame(rows, VERTICES)).orderBy("pos").collect()
    assert (origin.x, origin.y) == pytest.approx((0.0, 0.0))
    assert (west.x, west.y) == pytest.approx((-100.0, 30.0))


def test_region_is_stored_and_only_reused_on_its_grid(spark, tmp_path):
    latitudes, longitudes = np.linspace(1, 8, 8), np.linspace(-6, 3, 10)
    grid = grid_at(spark, latitudes, longitudes)
    nested = [(0, [[{"x": x, "y": y} for x, y in SQUARE]])]
    path = str(tmp_path / "polygons")
    spark.createDataFrame(nested, POLYGONS).write.parquet(path)
    target = str(tmp_path / "region")
    with pytest.raises(ValueError, match="no region"):
        build_region(spark, target, grid)
    built = build_region(spark, target, grid, read_polygons(spark, path))
    assert built.where("inside").count() == brute_force([[SQUARE]], latitudes, longitudes).sum()
    assert build_region(spark, target, grid).count() == 80  # from the stored table
    with pytest.raises(ValueError, match="differ"):
        build_region(spark, target, grid_at(spark, latitudes, longitudes + 0.5))


def test_a_stored_region_without_some_cells_is_refused(spark, tmp_path):
    """All coordinates are there, but not all cells."""
    grid = grid_at(spark, [1.0, 2.0], [5.0, 6.0])
    target = str(tmp_path / "partial")
    corners = grid.where("lat_idx = lon_idx").withColumn("inside", F.lit(True))
    conform(corners, REGION_CELLS).write.parquet(target)
    with pytest.raises(ValueError, match=r"cell \(0, 1\) is missing"):
        build_region(spark, target, grid)


def test_a_region_whose_write_broke_off_is_built_again(spark, tmp_path):
    grid = grid_at(spark, np.linspace(1, 8, 8), np.linspace(-6, 3, 10))
    nested = spark.createDataFrame([(0, [[{"x": x, "y": y} for x, y in SQUARE]])], POLYGONS)
    target = tmp_path / "region"
    build_region(spark, str(target), grid, nested)
    (target / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="no region"):
        build_region(spark, str(target), grid)
    assert build_region(spark, str(target), grid, nested).count() == 80


def test_missing_polygons_are_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_polygons(spark, str(tmp_path / "nowhere"))


# --- boxes --------------------------------------------------------------------------


def cells(spark, inside):
    inside = np.asarray(inside, bool)
    return spark.createDataFrame(grid_frame(*inside.shape, inside))


def block(shape, rows, cols):
    inside = np.zeros(shape, bool)
    inside[rows, cols] = True
    return inside


@pytest.mark.parametrize("seed", range(6))
def test_bounding_box(spark, seed):
    """Scattered cells: the box is their range, grown outwards to tiles but not past the grid."""
    rng = np.random.default_rng(seed)
    shape, tile = rng.integers(5, 40, 2), tuple(map(int, rng.integers(2, 9, 2)))
    inside = rng.random(shape) < 0.02
    inside[tuple(rng.integers(0, shape))] = True
    box, grown = [], []
    for axis, size in enumerate(tile):
        hit = np.flatnonzero(inside.any(1 - axis))
        box += [hit[0], hit[-1] + 1]
        edges = [i for i in range(0, shape[axis] + size, size)]
        grown += [max(e for e in edges if e <= hit[0]), min(min(e for e in edges if e > hit[-1]), shape[axis])]
    assert region.region_extent(cells(spark, inside)) == region.Extent(*map(int, box))
    assert region.region_extent(cells(spark, inside), tile) == region.Extent(*map(int, grown))


@pytest.mark.parametrize("snap", [None, (2, 2)])
def test_empty_region_is_an_error(spark, snap):
    with pytest.raises(ValueError, match="no selected cells"):
        region.region_extent(cells(spark, np.zeros((4, 4))), snap)


# --- tiles --------------------------------------------------------------------------


def blocks(spark, inside, shape=(4, 4)):
    rows = tiles.occupied_blocks(cells(spark, inside), shape).orderBy("lat_start", "lon_start")
    return [tuple(row)[1:] for row in rows.collect()]


def test_blocks_skip_merge_and_split(spark):
    """Tiles of 3 x 5: in the upper row the first two touch and the last stands alone, the lower has one."""
    inside = block((6, 20), slice(1, 2), slice(4, 6)) | block((6, 20), slice(0, 1), slice(19, 20))
    inside |= block((6, 20), slice(5, 6), slice(10, 11))
    assert blocks(spark, inside, (3, 5)) == [(0, 3, 0, 10), (0, 3, 15, 20), (3, 6, 10, 15)]
    summary = tiles.tile_coverage(cells(spark, inside), (3, 5)).first()
    assert tuple(summary) == (3, 4, 8, 4)


@pytest.mark.parametrize("seed", range(4))
def test_blocks_are_the_occupied_tiles_in_runs(spark, seed):
    rng = np.random.default_rng(seed)
    shape, (rows, cols) = (int(rng.integers(7, 25)), int(rng.integers(7, 25))), map(int, rng.integers(2, 6, 2))
    inside = rng.random(shape) < 0.08
    inside[0, 0] = True
    expected = np.zeros(shape, int)
    for lat, lon in zip(*np.nonzero(inside), strict=True):
        lat, lon = lat // rows * rows, lon // cols * cols
        expected[lat : lat + rows, lon : lon + cols] = 1
    covered = np.zeros(shape, int)
    found = blocks(spark, inside, (rows, cols))
    for lat_start, lat_stop, lon_start, lon_stop in found:
        covered[lat_start:lat_stop, lon_start:lon_stop] += 1
    assert (covered == expected).all()
    ends = {(lat_start, lon_stop) for lat_start, _, _, lon_stop in found}
    assert not ends & {(lat_start, lon_start) for lat_start, _, lon_start, _ in found}  # runs do not touch


def test_an_empty_region_has_no_blocks_but_an_error(spark):
    empty = cells(spark, np.zeros((4, 4)))
    for made in (tiles.occupied_blocks, tiles.tile_coverage):
        with pytest.raises(ValueError, match="no selected cells"):
            made(empty, (2, 2))


# --- masks --------------------------------------------------------------------------


@pytest.fixture(params=["10MB", "-1"])
def broadcast_limit(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_masks_agree_whatever_the_join(spark, broadcast_limit, tmp_path):
    hourly = to_spark(spark, weather(days=1))
    path = str(tmp_path / "cells")
    cells(spark, [[True, False], [True, True]]).write.parquet(path)
    inside = spark.read.parquet(path)
    kept = region.keep_inside(hourly, inside)
    assert kept.count() == 72
    masked = region.mask_outside(hourly, inside)
    assert masked.count() == 96
    outside = masked.where("lat_idx = 0 AND lon_idx = 1")
    assert outside.count() == 24 and outside.where(
        "coalesce(tmp_k, spfh, pres_pa, u10, v10) IS NOT NULL"
    ).isEmpty()
    assert masked.where("tmp_k IS NOT NULL").select(kept.columns).exceptAll(kept).isEmpty()
    joined = kept._jdf.queryExecution().executedPlan().toString()
    assert ("Broadcast" in joined) == (broadcast_limit != "-1")


def test_runs_hold_exactly_the_inside_cells(spark):
    """Random masks, wider than a block of columns."""
    mask = np.random.default_rng(5).random((3, 2 * region.RUN_COLUMNS + 9)) < 0.6
    runs = region.region_runs(cells(spark, mask)).collect()
    found = [(r.run_lat, lon) for r in runs for lon in range(r.lon_first, r.lon_last + 1)]
    assert len(found) == len(set(found)) and set(found) == set(zip(*map(list, np.nonzero(mask)), strict=True))
    assert all(r.lon_first // region.RUN_COLUMNS == r.lon_last // region.RUN_COLUMNS == r.run_block for r in runs)


def test_crop_and_mask_commute(spark):
    hourly = to_spark(spark, weather(days=1, rows=4, cols=4))
    inside = cells(spark, np.tril(np.ones((4, 4))))
    box = region.Extent(1, 3, 0, 3)
    one = region.crop(region.mask_outside(hourly, inside), box)
    two = region.mask_outside(region.crop(hourly, box), inside)
    assert one.count() == 2 * 3 * 24
    assert one.exceptAll(two.select(one.columns)).isEmpty()


def test_occupied_tiles_keep_every_inside_row(spark):
    hourly = to_spark(spark, weather(days=1, rows=6, cols=6))
    inside = cells(spark, np.eye(6))
    kept = tiles.keep_occupied(hourly, inside, (2, 3))
    assert kept.columns == hourly.columns
    assert kept.count() < hourly.count()
    all_inside = region.keep_inside(hourly, inside)
    assert all_inside.exceptAll(region.keep_inside(kept, inside)).isEmpty()

"""Scattered points in polygons against testing every point with every edge."""

import random

import pytest
from pyspark.sql import functions as F

from heatgrid.operators import covering, polygons

EDGES = "poly_id int, ring_id int, pos int, x double, y double"


def holds(point, rings):
    x, y = point
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if min(y1, y2) < y <= max(y1, y2):
                crossing = x1 if x1 == x2 else min(max(x1, x2), (y - y1) * (x2 - x1) / (y2 - y1) + x1)
                odd ^= x <= crossing
    return odd


def table(spark, shapes):
    rows = [
        (poly, ring, pos, float(x), float(y))
        for poly, rings in enumerate(shapes)
        for ring, vertices in enumerate(rings)
        for pos, (x, y) in enumerate(vertices)
    ]
    return polygons.edges_of(spark.createDataFrame(rows, EDGES))


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "cover")


def check(spark, path, shapes, points, level=None):
    places = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    found = sorted(map(tuple, covering.points_in_polygons(places, covering.cover_polygons(table(spark, shapes), path, level), "id").collect()))
    assert found == sorted((i, p) for i, point in enumerate(points) for p, rings in enumerate(shapes) if holds(point, rings))


def scattered(rng, n, lattice=False):
    draw = (lambda: rng.randint(-2, 22)) if lattice else (lambda: rng.uniform(-2, 22))
    return [(draw(), draw()) for _ in range(n)]


@pytest.mark.parametrize("level", [None, 0, 2, 6])
def test_random_polygons_with_holes(spark, path, level):
    rng = random.Random(level)
    shapes = []
    for _ in range(6):
        rings = []
        for _ in range(rng.randint(1, 3)):
            rings.append([(rng.uniform(0, 20), rng.uniform(0, 20)) for _ in range(rng.randint(3, 12))])
        shapes.append(rings)
    check(spark, path, shapes, scattered(rng, 400), level)


@pytest.mark.parametrize("level", [None, 5])
def test_points_and_corners_on_one_lattice(spark, path, level):
    """Points on corners, on level and upright edges, and at their heights."""
    rng = random.Random(3)
    shapes = [[[(0, 0), (0, 20), (20, 20), (20, 0)], [(5, 5), (15, 5), (15, 15), (5, 15)]]]
    shapes += [[[(rng.randint(0, 20), rng.randint(0, 20)) for _ in range(9)]] for _ in range(4)]
    check(spark, path, shapes, [(x, y) for x in range(-1, 22) for y in range(-1, 22)], level)


def test_a_border_of_many_corners(spark, path):
    """One ring with most of all edges beside small ones; its edges lie in many leaves."""
    rng = random.Random(9)
    zigzag = [(i / 50, 10 + (i % 2) * rng.uniform(0, 8)) for i in range(1000)] + [(20, 0), (0, 0)]
    shapes = [[zigzag], [[(2, 2), (3, 2), (3, 3)]]]
    check(spark, path, shapes, scattered(rng, 800))
    edges = table(spark, shapes)
    square = covering.square_of(edges)
    per_leaf = covering.border_edges(edges, square).groupBy(*covering.LEAF).count().agg(F.max("count")).first()[0]
    assert per_leaf <= 40


def test_inner_cells_are_merged(spark):
    edges = table(spark, [[[(0, 0), (0, 16), (16, 16), (16, 0)]]])
    square = covering.square_of(edges, 6)
    leaves = covering.border_leaves(covering.border_edges(edges, square), square)
    cells = covering.inner_cells(leaves, 6).groupBy("level").count().collect()
    assert min(row.level for row in cells) <= 3
    assert sum(row["count"] * 4 ** (6 - row.level) for row in cells) >= 0.85 * 60 * 60
    assert sum(row["count"] for row in cells) < 500


def test_no_edges_no_points_and_nulls(spark, path):
    square = [[[(0, 0), (0, 4), (4, 4), (4, 0)]]]
    places = spark.createDataFrame([(1, None, 1.0), (2, 1.0, None), (3, 1.0, 1.0), (3, 1.0, 1.0)], "id int, x double, y double")
    cover = covering.cover_polygons(table(spark, square), path)
    assert [tuple(r) for r in covering.points_in_polygons(places, cover, "id").collect()] == [(3, 0)]
    nothing = covering.cover_polygons(table(spark, square).where("poly_id > 5"), path)
    assert nothing is None and covering.points_in_polygons(places, nothing, "id").collect() == []
    assert covering.points_in_polygons(places.limit(0), cover, "id").collect() == []


def test_every_join_is_on_equal_keys(spark, path):
    edges = table(spark, [[[(0, 0), (0, 4), (4, 4), (4, 0)]]])
    places = spark.createDataFrame([(1, 1.0, 1.0)], "id int, x double, y double")
    cover = covering.cover_polygons(edges, path)
    plan = covering.points_in_polygons(places, cover, "id")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan

"""Points anywhere in polygons, by a covering of the polygons with quad-tree cells.

Each polygon is covered by cells that lie wholly inside and by leaves that its border passes. A point is
looked up by the cell it lies in, by equal keys: inside an inner cell nothing is left to test, in a border
leaf only the edges that pass that leaf are met. The rule for a point is that of ``polygons``: a ray
towards increasing x crosses the rings an odd number of times, an edge being met iff ``min(y) < y <=
max(y)`` and ``x`` is not beyond the crossing.

Within a leaf the ray stops at the leaf's east side. From there the crossings along that side, between
the height of the point and that of a reference, lead to a place whose parity is known from a scan-line
through the reference heights. Leaves begin at an odd place, so that no side runs along coordinates
that occur in data.

The covering is written as tables, so that many sets of points can be looked up. A polygon is spread over its leaves, rows of leaves and cells, so one of any size is no single task. Work
grows with edges x leaves passed, inner cells, and points x edges of their leaf.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEAF = ("poly_id", "cell_x", "cell_y")
MARGIN = 0.0123456789  # of the width, by which the covered square begins before the polygons
COARSEST, FINEST = 3, 12


class Square:
    """The covered square, cut into 2 ** level leaves along each side."""

    def __init__(self, x: float, y: float, size: float, level: int):
        self.x, self.y, self.level = x, y, level
        self.step = size / 2**level

    def column(self, x: Column) -> Column:
        return F.floor((x - self.x) / self.step).cast("int")

    def row(self, y: Column) -> Column:
        return F.floor((y - self.y) / self.step).cast("int")

    def west(self, column: Column) -> Column:
        return column * self.step + self.x

    def south(self, row: Column) -> Column:
        return row * self.step + self.y


def square_of(edges: DataFrame, level: int | None = None) -> Square | None:
    """The square around the polygons, None without edges. Finer with more edges, unless the level is given."""
    facts = edges.agg(
        F.min("x1").alias("x"), F.max("x1").alias("x_stop"), F.min("y1").alias("y"), F.max("y1").alias("y_stop"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    if not facts.n:
        return None
    size = max(facts.x_stop - facts.x, facts.y_stop - facts.y) or 1.0
    if level is None:
        level = min(FINEST, max(COARSEST, (int(facts.n).bit_length() + 1) // 2 + 2))
    margin = size * MARGIN
    return Square(facts.x - margin, facts.y - margin * 1.1, size + 3 * margin, level)


def border_edges(edges: DataFrame, square: Square) -> DataFrame:
    """Every edge with each leaf it passes; the columns of a row of leaves come from where the edge enters and leaves it."""
    x1, y1, x2, y2 = (F.col(name) for name in ("x1", "y1", "x2", "y2"))
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    rows = edges.select(
        "poly_id", "x1", "y1", "x2", "y2",
        F.explode(F.sequence(square.row(low), square.row(high))).alias("cell_y"),
    )
    bottom = F.greatest(low, square.south(F.col("cell_y")))
    top = F.least(high, square.south(F.col("cell_y") + 1))

    def at(y: Column) -> Column:
        slope = F.try_divide((y - y1) * (x2 - x1), y2 - y1)
        return F.greatest(F.least(x1, x2), F.least(F.greatest(x1, x2), x1 + slope))

    # A level edge is in one row and passes all columns between its ends.
    level = y1 == y2
    one, other = F.when(level, x1).otherwise(at(bottom)), F.when(level, x2).otherwise(at(top))
    # Rounding may move an entry across a side; a leaf too many does no harm.
    slack = square.step * 1e-9
    first, last = square.column(F.least(one, other) - slack), square.column(F.greatest(one, other) + slack)
    return rows.select("*", F.explode(F.sequence(first, last)).alias("cell_x"))


def _crossing(y: Column) -> Column:
    """Where an edge that spans the height y meets it, as in ``polygons``."""
    x1, y1, x2, y2 = (F.col(name) for name in ("x1", "y1", "x2", "y2"))
    slanted = F.try_divide((y - y1) * (x2 - x1), y2 - y1) + x1
    return F.when(x1 == x2, x1).otherwise(F.least(F.greatest(x1, x2), slanted))


def _spans(y: Column) -> Column:
    return (y > F.least("y1", "y2")) & (y <= F.greatest("y1", "y2"))


def border_leaves(passed: DataFrame, square: Square) -> DataFrame:
    """Leaves on a border, with ``odd``: the parity at the reference height of their east side, and the next leaf to the east."""
    reference = square.south(F.col("cell_y") + 0.5)
    # An edge crosses the reference height of a row in one place; the leaf there is one that it passes.
    met = _spans(reference) & (square.column(_crossing(reference)) == F.col("cell_x"))
    leaves = passed.groupBy(*LEAF).agg(F.count_if(met).alias("crossings"))
    # Rows of a polygon are as long as the square is wide, at most.
    from_east = W.partitionBy("poly_id", "cell_y").orderBy(F.desc("cell_x"))
    beyond = F.coalesce(F.sum("crossings").over(from_east.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return leaves.select(*LEAF, (beyond % 2 == 1).alias("odd"), F.lag("cell_x").over(from_east).alias("next_x"))


def inner_cells(leaves: DataFrame, level: int) -> DataFrame:
    """Cells (poly_id, level, cell_x, cell_y) wholly inside, the largest ones there are.

    Each leaf between borders counts for all cells it lies in, which are combined before they are shuffled;
    a cell that is full is kept unless the one around it is full too.
    """
    between = leaves.where(F.col("odd") & (F.col("next_x") - F.col("cell_x") > 1))
    cells = between.select(
        "poly_id", F.explode(F.sequence(F.col("cell_x") + 1, F.col("next_x") - 1)).alias("leaf_x"), F.col("cell_y").alias("leaf_y")
    )
    around = cells.select("poly_id", "leaf_x", "leaf_y", F.explode(F.sequence(F.lit(0), F.lit(level))).alias("level"))
    full = (
        around.groupBy("poly_id", "level", *_prefix(level))
        .agg(F.count(F.lit(1)).alias("leaves"))
        .where(F.expr(f"leaves = shiftleft(1L, 2 * ({level} - level))"))
        .select("poly_id", "level", "cell_x", "cell_y")
    )
    # The cell around: one level up, both numbers halved.
    larger = full.select("poly_id", (F.col("level") + 1).alias("level"), F.col("cell_x").alias("around_x"), F.col("cell_y").alias("around_y"))
    kept = full.withColumns({"around_x": F.shiftright("cell_x", 1), "around_y": F.shiftright("cell_y", 1)}).join(
        larger, ["poly_id", "level", "around_x", "around_y"], "left_anti"
    )
    return kept.select("poly_id", "level", "cell_x", "cell_y")


def _prefix(level: int) -> list[Column]:
    """The cell of ``level`` that a leaf lies in."""
    return [F.expr(f"shiftright(leaf_{axis}, {level} - level)").alias(f"cell_{axis}") for axis in "xy"]


@dataclass(frozen=True)
class Cover:
    """A covering of polygons: edges by leaf, leaves on a border, and cells wholly inside."""

    square: Square
    passed: DataFrame
    leaves: DataFrame
    inner: DataFrame


def cover_polygons(edges: DataFrame, path: str, level: int | None = None) -> Cover | None:
    """The covering of polygons, written below ``path``; None without edges."""
    square = square_of(edges, level)
    if square is None:
        return None
    spark = edges.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    passed = written(border_edges(edges, square), "passed")
    leaves = written(border_leaves(passed, square), "leaves")
    return Cover(square, passed, leaves, written(inner_cells(leaves, square.level), "inner"))


def points_in_polygons(points: DataFrame, cover: Cover | None, key: str) -> DataFrame:
    """(key, poly_id) for each polygon that holds a point of ``points`` (key, x, y).

    A key stands for one place. NULL coordinates lie in no polygon.
    """
    placed = points.select(F.col(key).alias("point"), "x", "y").where("x IS NOT NULL AND y IS NOT NULL").distinct()
    if cover is None:
        return placed.limit(0).select(F.col("point").alias(key), F.lit(0).alias("poly_id"))
    square = cover.square
    side = 2**square.level
    placed = placed.withColumns({"leaf_x": square.column(F.col("x")), "leaf_y": square.row(F.col("y"))})
    placed = placed.where(F.col("leaf_x").between(0, side - 1) & F.col("leaf_y").between(0, side - 1))

    depths = F.explode(F.sequence(F.lit(0), F.lit(square.level)))
    prefixes = placed.select("point", "leaf_x", "leaf_y", depths.alias("level")).select("point", "level", *_prefix(square.level))
    inner = prefixes.join(cover.inner, ["level", "cell_x", "cell_y"]).select("point", "poly_id")

    at_leaf = (F.col("leaf_x") == F.col("cell_x")) & (F.col("leaf_y") == F.col("cell_y"))
    bordered = placed.join(cover.leaves.select(*LEAF, "odd"), at_leaf).drop("leaf_x", "leaf_y")
    x, y, east = F.col("x"), F.col("y"), square.west(F.col("cell_x") + 1)
    reference = square.south(F.col("cell_y") + 0.5)
    crossing = _crossing(y)
    along_ray = _spans(y) & (x <= crossing) & (crossing < east)
    height = F.col("y1") + F.try_divide((east - F.col("x1")) * (F.col("y2") - F.col("y1")), F.col("x2") - F.col("x1"))
    at_side = (east > F.least("x1", "x2")) & (east <= F.greatest("x1", "x2"))
    along_side = at_side & ((y <= height) != (reference <= height))
    met = F.when(along_ray, 1).otherwise(0) + F.when(along_side, 1).otherwise(0)
    tested = (
        bordered.join(cover.passed, list(LEAF))
        .groupBy("point", "poly_id")
        .agg((F.sum(met) + F.when(F.first("odd"), 1).otherwise(0)).alias("parity"))
        .where("parity % 2 = 1")
    )
    return inner.unionByName(tested.select("point", "poly_id")).withColumnRenamed("point", key)

"""Weather-shaped inputs derived from the driver's tables, for Spark and as SQL.

``FIXTURES.md`` part 2 describes them. Each Spark function and the SQL of the
same name yield the same rows. Where the SQL pairs every cell with every hour,
Spark generates the hours from the cell's own row.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GRID_COLUMNS = 40
REGION_TILES = (4, 8)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _weather(k, *, k_steps: tuple, hour_terms: tuple | None = None) -> dict:
    """Five variables from an integer, each spread over its plausible range."""
    def spread(index: int, modulus: int):
        value = k * k_steps[index]
        if hour_terms:
            value = value + F.col("h") * hour_terms[index]
        return value % modulus

    return {
        "tmp_k": F.lit(283.15) + spread(0, 3000) / 100.0,
        "spfh": F.lit(0.004) + spread(1, 160) / 10000.0,
        "pres_pa": F.lit(97000.0) + spread(2, 4500),
        "u10": spread(3, 160) / 10.0 - 8.0,
        "v10": spread(4, 160) / 10.0 - 8.0,
    }


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cell per user; the hours of each day on which the user has events, with some absent."""
    days = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("int").alias("cell"), F.to_date("ts").alias("day"))
        .agg(F.max("event_id").alias("k"))
    )
    hourly = (
        days.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(23))))
        .withColumn("k", F.col("k") + F.col("h"))
        .where(F.col("k") % 23 != 0)
    )
    weather = _weather(F.col("k"), k_steps=(37, 13, 7, 11, 17))
    return hourly.select(
        "cell",
        F.call_function("div", "cell", F.lit(GRID_COLUMNS)).cast("int").alias("lat_idx"),
        (F.col("cell") % GRID_COLUMNS).cast("int").alias("lon_idx"),
        (F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("h"))).alias("ts"),
        *(column.alias(name) for name, column in weather.items()),
    )


OBS = """
SELECT cell, CAST(cell // 40 AS INT) AS lat_idx, CAST(cell % 40 AS INT) AS lon_idx, ts,
       283.15e0 + (k * 37 % 3000) / 100.0e0 AS tmp_k,
       0.004e0 + (k * 13 % 160) / 10000.0e0 AS spfh,
       97000.0e0 + (k * 7 % 4500) AS pres_pa,
       (k * 11 % 160) / 10.0e0 - 8.0e0 AS u10,
       (k * 17 % 160) / 10.0e0 - 8.0e0 AS v10
FROM (SELECT cell, CAST(day AS TIMESTAMP) + h * INTERVAL '1' HOUR AS ts, k + h AS k
      FROM (SELECT *, unnest(range(24)) AS h
            FROM (SELECT CAST(user_id AS INT) AS cell, CAST(ts AS DATE) AS day, max(event_id) AS k
                  FROM events GROUP BY 1, 2) AS days) AS hours) AS hourly
WHERE k % 23 <> 0
"""


def obs_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, hour = F.day("ts"), F.hour("ts")
    return obs(spark, sf_dir).withColumns(
        {
            "tmp_k": F.when((day + hour + F.col("cell")) % 29 != 0, F.col("tmp_k")),
            "spfh": F.when((day * 3 + hour) % 31 != 0, F.col("spfh")),
        }
    )


OBS_GAP = """
SELECT cell, lat_idx, lon_idx, ts,
       CASE WHEN (day(ts) + hour(ts) + cell) % 29 <> 0 THEN tmp_k END AS tmp_k,
       CASE WHEN (day(ts) * 3 + hour(ts)) % 31 <> 0 THEN spfh END AS spfh,
       pres_pa, u10, v10
FROM obs
"""


def obs_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``obs`` under its source names, with NaN and infinity for the gaps."""
    day, hour = F.day("ts"), F.hour("ts")
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    return obs(spark, sf_dir).select(
        "lat_idx",
        "lon_idx",
        "ts",
        F.when((day + hour) % 7 == 0, nan).otherwise(F.col("tmp_k")).alias("TMP_2maboveground"),
        F.when((day + hour) % 11 == 0, inf)
        .when((day + hour) % 13 == 0, -inf)
        .otherwise(F.col("spfh"))
        .alias("SPFH_2maboveground"),
    )


def obs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).select(
        "cell",
        "ts",
        F.stack(
            F.lit(3),
            *(part for name in ("tmp_k", "spfh", "pres_pa") for part in (F.lit(name), F.col(name))),
        ).alias("variable", "value"),
    )


OBS_LONG = """
SELECT cell, ts, 'tmp_k' AS variable, tmp_k AS value FROM obs
UNION ALL SELECT cell, ts, 'spfh', spfh FROM obs
UNION ALL SELECT cell, ts, 'pres_pa', pres_pa FROM obs
"""


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    row = F.floor(key / float(GRID_COLUMNS))
    return table(spark, sf_dir, "part").select(
        row.cast("int").alias("lat_idx"),
        (key % GRID_COLUMNS).cast("int").alias("lon_idx"),
        (row * 0.25 + 25.0).alias("latitude"),
        ((key % GRID_COLUMNS) * 0.25 - 107.0).alias("longitude"),
    )


GRID = """
SELECT CAST(floor(p_partkey / 40.0e0) AS INT) AS lat_idx,
       CAST(p_partkey % 40 AS INT) AS lon_idx,
       25.0e0 + 0.25e0 * floor(p_partkey / 40.0e0) AS latitude,
       -107.0e0 + 0.25e0 * (p_partkey % 40) AS longitude
FROM part
"""


def other_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of another size, with every seventh latitude moved."""
    key = F.col("c_custkey")
    row = F.floor(key / float(GRID_COLUMNS))
    moved = F.when(row % 7 == 3, F.lit(0.125)).otherwise(0.0)
    return table(spark, sf_dir, "customer").select(
        row.cast("int").alias("lat_idx"),
        (key % GRID_COLUMNS).cast("int").alias("lon_idx"),
        (row * 0.25 + 25.0 + moved).alias("latitude"),
        ((key % GRID_COLUMNS) * 0.25 - 107.0).alias("longitude"),
    )


OTHER_GRID = """
SELECT CAST(floor(c_custkey / 40.0e0) AS INT) AS lat_idx,
       CAST(c_custkey % 40 AS INT) AS lon_idx,
       25.0e0 + 0.25e0 * floor(c_custkey / 40.0e0)
         + CASE WHEN CAST(floor(c_custkey / 40.0e0) AS INT) % 7 = 3 THEN 0.125e0 ELSE 0.0e0 END AS latitude,
       -107.0e0 + 0.25e0 * (c_custkey % 40) AS longitude
FROM customer
"""


def hourly_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of every cell. Cells are dealt to the cores before each grows to 48 rows."""
    k = F.col("lat_idx").cast("bigint") * GRID_COLUMNS + F.col("lon_idx")
    cores = spark.sparkContext.defaultParallelism
    hours = grid(spark, sf_dir).repartition(cores).select(
        "lat_idx", "lon_idx", k.alias("k"), F.explode(F.sequence(F.lit(0), F.lit(47))).alias("h")
    )
    weather = _weather(F.col("k"), k_steps=(37, 13, 7, 11, 17), hour_terms=(101, 29, 53, 3, 5))
    weather["tmp_k"] = F.when((F.col("k") * 7 + F.col("h")) % 97 != 0, weather["tmp_k"])
    start = F.lit("2000-07-01 00:00:00").cast("timestamp_ntz")
    return hours.select(
        "lat_idx",
        "lon_idx",
        (start + F.make_dt_interval(hours=F.col("h"))).alias("ts"),
        *(column.alias(name) for name, column in weather.items()),
    )


HOURLY_GRID = """
SELECT lat_idx, lon_idx, TIMESTAMP '2000-07-01 00:00:00' + h * INTERVAL '1' HOUR AS ts,
       CASE WHEN (k * 7 + h) % 97 <> 0 THEN 283.15e0 + ((k * 37 + h * 101) % 3000) / 100.0e0 END AS tmp_k,
       0.004e0 + ((k * 13 + h * 29) % 160) / 10000.0e0 AS spfh,
       97000.0e0 + ((k * 7 + h * 53) % 4500) AS pres_pa,
       ((k * 11 + h * 3) % 160) / 10.0e0 - 8.0e0 AS u10,
       ((k * 17 + h * 5) % 160) / 10.0e0 - 8.0e0 AS v10
FROM (SELECT lat_idx, lon_idx, CAST(lat_idx * 40 + lon_idx AS BIGINT) AS k FROM grid) AS g
CROSS JOIN (SELECT DISTINCT CAST(event_id % 48 AS INT) AS h FROM events) AS hours
"""


def year_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hourly_grid`` moved to the last day of 1999 and the first of 2000."""
    return hourly_grid(spark, sf_dir).withColumn("ts", F.col("ts") - F.make_dt_interval(days=F.lit(183)))


YEAR_END = "SELECT * REPLACE (ts - INTERVAL '183' DAY AS ts) FROM hourly_grid"


def region_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staircase with scattered cells beside it: tile rows with gaps and empty tiles."""
    lat, lon = F.col("lat_idx"), F.col("lon_idx")
    inside = (F.abs(lat - lon) <= 3) | ((lat + lon * 3) % 61 == 0)
    return grid(spark, sf_dir).withColumn("inside", inside)


REGION_CELLS = """
SELECT *, abs(lat_idx - lon_idx) <= 3 OR (lat_idx + 3 * lon_idx) % 61 = 0 AS inside FROM grid
"""


def obs_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the cells of ``obs``."""
    return (
        obs(spark, sf_dir)
        .select("lat_idx", "lon_idx")
        .distinct()
        .withColumn("inside", (F.col("lat_idx") + F.col("lon_idx")) % 3 != 0)
    )


OBS_REGION = "SELECT DISTINCT lat_idx, lon_idx, (lat_idx + lon_idx) % 3 <> 0 AS inside FROM obs"

# An octagon as multiples of its half axes.
OCTAGON = (
    (1.0, -0.5), (1.0, 0.5), (0.5, 1.0), (-0.5, 1.0),
    (-1.0, 0.5), (-1.0, -0.5), (-0.5, -1.0), (0.5, -1.0),
)


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An octagon per supplier, every second with a hole, and one ring through all parts.

    That ring runs to and fro across the grid and holds most of the vertices.
    """
    s = F.col("s_suppkey")
    points = F.array(*(F.struct(F.lit(fx).alias("fx"), F.lit(fy).alias("fy")) for fx, fy in OCTAGON))
    rings = F.when(s % 2 == 0, F.array(F.lit(1.0), F.lit(0.4))).otherwise(F.array(F.lit(1.0)))
    octagons = (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", F.posexplode(rings).alias("ring_id", "scale"))
        .select("s_suppkey", "ring_id", "scale", F.posexplode(points).alias("pos", "p"))
        .select(
            (s + 1).cast("int").alias("poly_id"),
            "ring_id",
            "pos",
            (
                ((s * 13 % 40) * 0.25 - 106.95)
                + F.col("p.fx") * ((s % 5) * 0.25 + 0.5) * F.col("scale")
            ).alias("x"),
            (
                (s * 0.125 + 25.1) + F.col("p.fy") * ((s % 3) * 0.2 + 0.4) * F.col("scale")
            ).alias("y"),
        )
    )
    k = F.col("p_partkey")
    ring = table(spark, sf_dir, "part").select(
        F.lit(0).alias("poly_id"),
        F.lit(0).alias("ring_id"),
        k.cast("int").alias("pos"),
        ((k * 37 % 50) * 0.19 - 106.9).alias("x"),
        (k * 0.00625 + 25.03).alias("y"),
    )
    return octagons.unionByName(ring)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place per customer, anywhere in and around the polygons; some on corners and at their heights."""
    k = F.col("c_custkey")
    lattice = k % 5 == 0
    return table(spark, sf_dir, "customer").select(
        k.alias("place"),
        F.when(lattice, (k * 7 % 52) * 0.19 - 107.0).otherwise((k * 7919 % 10007) / 960.0 - 107.5).alias("x"),
        F.when(lattice, (k * 11 % 2400) * 0.00625 + 25.03).otherwise((k * 104729 % 20011) / 1200.0 + 24.5).alias("y"),
    )


PLACES = """
SELECT c_custkey AS place,
       CASE WHEN c_custkey % 5 = 0 THEN (c_custkey * 7 % 52) * 0.19e0 - 107.0e0
            ELSE (c_custkey * 7919 % 10007) / 960.0e0 - 107.5e0 END AS x,
       CASE WHEN c_custkey % 5 = 0 THEN (c_custkey * 11 % 2400) * 0.00625e0 + 25.03e0
            ELSE (c_custkey * 104729 % 20011) / 1200.0e0 + 24.5e0 END AS y
FROM customer
"""


def nested_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vertices`` as they come from a source: one row per polygon with all its rings."""
    point = F.struct("pos", F.col("x"), F.col("y"))
    rings = vertices(spark, sf_dir).groupBy("poly_id", "ring_id").agg(F.sort_array(F.collect_list(point)).alias("ring"))
    nested = rings.groupBy("poly_id").agg(F.sort_array(F.collect_list(F.struct("ring_id", "ring"))).alias("rings"))
    return nested.select(
        "poly_id",
        F.transform(
            "rings", lambda r: F.transform(r["ring"], lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
        ).alias("rings"),
    )


VERTICES = """
SELECT CAST(s_suppkey + 1 AS INT) AS poly_id, ring_id, pos,
       ((s_suppkey * 13 % 40) * 0.25e0 - 106.95e0) + fx * ((s_suppkey % 5) * 0.25e0 + 0.5e0) * scale AS x,
       (s_suppkey * 0.125e0 + 25.1e0) + fy * ((s_suppkey % 3) * 0.2e0 + 0.4e0) * scale AS y
FROM supplier
CROSS JOIN (VALUES (0, 1.0e0), (1, 0.4e0)) AS r(ring_id, scale)
CROSS JOIN (VALUES (0, 1.0e0, -0.5e0), (1, 1.0e0, 0.5e0), (2, 0.5e0, 1.0e0), (3, -0.5e0, 1.0e0),
                   (4, -1.0e0, 0.5e0), (5, -1.0e0, -0.5e0), (6, -0.5e0, -1.0e0), (7, 0.5e0, -1.0e0)
           ) AS p(pos, fx, fy)
WHERE ring_id = 0 OR s_suppkey % 2 = 0
UNION ALL
SELECT 0, 0, CAST(p_partkey AS INT), (p_partkey * 37 % 50) * 0.19e0 - 106.9e0,
       p_partkey * 0.00625e0 + 25.03e0
FROM part
"""

EDGES = """
SELECT poly_id, ring_id, pos, x AS x1, y AS y1,
       coalesce(lead(x) OVER ring, first_value(x) OVER ring) AS x2,
       coalesce(lead(y) OVER ring, first_value(y) OVER ring) AS y2
FROM vertices
WINDOW ring AS (PARTITION BY poly_id, ring_id ORDER BY pos)
"""


def mercator_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        (key % 17).cast("int").alias("poly_id"),
        F.lit(0).alias("ring_id"),
        F.floor(key / 17.0).cast("int").alias("pos"),
        ((key * 3701 % 1200000) - 11910000.0).alias("x"),
        ((key * 9103 % 1900000) + 2870000.0).alias("y"),
    )


MERCATOR_VERTICES = """
SELECT CAST(c_custkey % 17 AS INT) AS poly_id, 0 AS ring_id,
       CAST(floor(c_custkey / 17.0e0) AS INT) AS pos,
       (c_custkey * 3701 % 1200000) - 11910000.0e0 AS x,
       (c_custkey * 9103 % 1900000) + 2870000.0e0 AS y
FROM customer
"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, year = F.col("l_returnflag"), F.year("l_shipdate")
    metric = (
        F.when(flag == "A", "humidex").when(flag == "N", "heat_index").otherwise("temperature")
    )
    lost = ((flag == "N") & (year == 1998)) | ((flag == "R") & (year == 2001))
    return (
        table(spark, sf_dir, "lineitem")
        .where(~lost)
        .select(metric.alias("metric"), year.cast("int").alias("year"))
        .distinct()
    )


MANIFEST = """
SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 'humidex' WHEN 'N' THEN 'heat_index'
                                  ELSE 'temperature' END AS metric,
       CAST(year(l_shipdate) AS INT) AS year
FROM lineitem
WHERE NOT (l_returnflag = 'N' AND year(l_shipdate) = 1998)
  AND NOT (l_returnflag = 'R' AND year(l_shipdate) = 2001)
"""

# Name of each derived table -> (tables it is built on, SQL).
SQL = {
    "obs": ((), OBS),
    "obs_gap": (("obs",), OBS_GAP),
    "obs_long": (("obs",), OBS_LONG),
    "obs_region": (("obs",), OBS_REGION),
    "grid": ((), GRID),
    "other_grid": ((), OTHER_GRID),
    "hourly_grid": (("grid",), HOURLY_GRID),
    "year_end": (("hourly_grid",), YEAR_END),
    "region_cells": (("grid",), REGION_CELLS),
    "places": ((), PLACES),
    "vertices": ((), VERTICES),
    "edges": (("vertices",), EDGES),
    "mercator_vertices": ((), MERCATOR_VERTICES),
    "manifest": ((), MANIFEST),
}


def with_fixtures(names: tuple[str, ...], *ctes: str, select: str) -> str:
    """One statement: the named fixtures and their inputs, more CTEs, the final select."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for inner in SQL[name][0]:
            need(inner)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    parts = [f"{name} AS ({SQL[name][1]})" for name in ordered]
    return "WITH " + ",\n".join([*parts, *ctes]) + "\n" + select

"""Every registered query with its oracle SQL."""

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatgrid.functions import moist_air as air
from heatgrid.functions.metrics import METRICS, MetricSpec, with_quantities
from heatgrid.operators import calendar, checks, covering, identity, polygons, reducers, region, tiles
from heatgrid.operators.daily import daily_metrics, reduce_daily, to_long
from heatgrid.schema import STATISTICS
from heatgrid.plans.daily_run import run_daily
from heatgrid.session import few_rows, shared_folder
from heatgrid.sources import boundary, daily_store, hourly as hourly_source
from heatgrid.sources.late_hours import deliver_hours
from workloads import fixtures as fx
from workloads.oracle import DERIVED, METRIC_SQL, daily_ctes, digits, rounded_daily

Query = Callable[[SparkSession, str], DataFrame]

ALL = sorted(METRICS)
FIRST_YEAR, LAST_YEAR = 1995, 2001
STORE_YEAR = 2024


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str


CATALOG: dict[str, Entry] = {}


def register(name: str, sql: str) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        CATALOG[name] = Entry(query, sql)
        return query

    return keep


def rounded(daily: DataFrame, metrics: list[str]) -> DataFrame:
    keys = [name for name in ("lat_idx", "lon_idx", "day") if name in daily.columns]
    values = [
        F.round(f"{name}_{statistic}", digits(name)).alias(f"{name}_{statistic}")
        for name in metrics
        for statistic in STATISTICS
    ]
    return daily.select(*keys, *values, *(f"{name}_valid_hours" for name in metrics))


def rounded_columns(df: DataFrame, nine: tuple[str, ...] = ("spfh",)) -> DataFrame:
    """Round every double column, the small-valued ones to nine digits."""
    return df.select(
        *(
            F.round(name, 9 if name in nine else 6).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        )
    )


# --- daily statistics ---------------------------------------------------------


def _register_daily(
    key: str,
    metrics: list[str],
    source: Callable[[SparkSession, str], DataFrame] = fx.obs,
    min_valid_hours: int = 24,
) -> None:
    name = source.__name__
    sql = with_daily(name, metrics, min_valid_hours, rounded_daily(metrics))

    @register(key, sql)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        daily = daily_metrics(source(spark, sf_dir), metrics, min_valid_hours=min_valid_hours)
        return rounded(daily, metrics)


def with_daily(name: str, metrics: list[str], min_valid_hours: int, select: str, *more: str) -> str:
    return fx.with_fixtures(
        (name,), *daily_ctes(name, metrics, min_valid_hours), *more, select=select
    )


_register_daily("daily_temperature", ["temperature"])
_register_daily("daily_relative_humidity", ["relative_humidity"])
_register_daily("daily_specific_humidity", ["specific_humidity"])
_register_daily("daily_heat_index", ["heat_index"])
_register_daily("daily_apparent_temperature", ["apparent_temperature"])
_register_daily("daily_humidex", ["humidex"])
_register_daily("daily_simplified_wbgt", ["simplified_wbgt"])
_register_daily("daily_wet_bulb", ["wet_bulb_temperature"])
_register_daily("daily_all_metrics", ALL, fx.hourly_grid, min_valid_hours=23)
_register_daily("coverage_suppression", ["humidex", "temperature"], fx.obs_gap)
_register_daily("coverage_threshold_20", ["humidex", "temperature"], fx.obs_gap, 20)

EXTRA = ["humidex", "temperature"]
HOT = 80.0


@register(
    "further_day_reducers",
    with_daily(
        "obs_gap", EXTRA, 20,
        "SELECT d.lat_idx, d.lon_idx, d.day, "
        + ", ".join(
            f"""CASE WHEN d.{name}_valid_hours >= 20 THEN {name}_at END AS {name}_hour_of_max,
                CASE WHEN d.{name}_valid_hours >= 20 THEN coalesce({name}_longest, 0) END AS {name}_hot_hours,
                round(d.{name}_max, 6) AS {name}_max, d.{name}_valid_hours"""
            for name in EXTRA
        )
        + " FROM daily AS d "
        + " ".join(f"LEFT JOIN at_{name} USING (lat_idx, lon_idx, day) LEFT JOIN run_{name} USING (lat_idx, lon_idx, day)" for name in EXTRA),
        *(
            f"""
            of_hour_{name} AS (SELECT lat_idx, lon_idx, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INT) AS h, {METRIC_SQL[name]} AS v FROM d3),
            at_{name} AS (
              SELECT lat_idx, lon_idx, day, CAST(min(h) AS INT) AS {name}_at
              FROM (SELECT *, max(round(v, 9)) OVER (PARTITION BY lat_idx, lon_idx, day) AS top FROM of_hour_{name})
              WHERE round(v, 9) = top GROUP BY lat_idx, lon_idx, day),
            run_{name} AS (
              SELECT lat_idx, lon_idx, day, CAST(max(n) AS INT) AS {name}_longest
              FROM (SELECT lat_idx, lon_idx, day, island, count(*) AS n
                    FROM (SELECT *, h - row_number() OVER (PARTITION BY lat_idx, lon_idx, day ORDER BY h) AS island
                          FROM of_hour_{name} WHERE v > {HOT}e0)
                    GROUP BY lat_idx, lon_idx, day, island)
              GROUP BY lat_idx, lon_idx, day)"""
            for name in EXTRA
        ),
    ),
)
def further_day_reducers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hour of the maximum and the longest row of hot hours, in the aggregation of the daily statistics."""
    more = {"hour_of_max": reducers.HOUR_OF_MAX, "hot_hours": reducers.longest_run_above(HOT)}
    daily = daily_metrics(fx.obs_gap(spark, sf_dir), EXTRA, min_valid_hours=20, reducers=dict.fromkeys(EXTRA, more))
    return daily.select(
        "lat_idx", "lon_idx", "day",
        *(
            column
            for name in EXTRA
            for column in (f"{name}_hour_of_max", f"{name}_hot_hours", F.round(f"{name}_max", 6).alias(f"{name}_max"), f"{name}_valid_hours")
        ),
    )


def humidex_of_arrays(tc, vp_hpa):
    """The humidex as a function of numpy arrays."""
    return (tc + 5.0 / 9.0 * (vp_hpa - 10.0)) * 1.8 + 32.0


@register(
    "array_metric",
    with_daily(
        "obs_gap", ["humidex"], 20,
        "SELECT lat_idx, lon_idx, day, "
        + ", ".join(
            [
                f"round(humidex_{label}, 6) AS {name}_{label}"
                for name in ("humidex", "own_humidex")
                for label in STATISTICS
            ]
            + [f"humidex_valid_hours AS {name}_valid_hours" for name in ("humidex", "own_humidex")]
        )
        + " FROM daily",
    ),
)
def array_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric as a column and as a function of arrays, in one run."""
    registry = {**METRICS, "own_humidex": MetricSpec(("tc", "vp_hpa"), None, array=humidex_of_arrays)}
    names = ["humidex", "own_humidex"]
    daily = daily_metrics(fx.obs_gap(spark, sf_dir), names, min_valid_hours=20, registry=registry)
    values = [F.round(f"{name}_{s}", 6).alias(f"{name}_{s}") for name in names for s in STATISTICS]
    return daily.select("lat_idx", "lon_idx", "day", *values, *(f"{name}_valid_hours" for name in names))


COUNTED = ["humidex", "specific_humidity", "temperature"]


@register(
    "valid_hours_by_metric",
    with_daily(
        "obs_gap", COUNTED, 24,
        "SELECT lat_idx, lon_idx, day, "
        + ", ".join(f"{name}_valid_hours" for name in COUNTED)
        + " FROM daily",
    ),
)
def valid_hours_by_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_metrics(fx.obs_gap(spark, sf_dir), COUNTED)
    return daily.select("lat_idx", "lon_idx", "day", *(f"{name}_valid_hours" for name in COUNTED))


@register(
    "multi_year_daily",
    """
    SELECT CAST(l_suppkey AS INT) AS cell, CAST(l_shipdate AS DATE) AS day,
           round(min(l_quantity), 6) AS quantity_min, round(avg(l_quantity), 6) AS quantity_mean,
           round(max(l_quantity), 6) AS quantity_max,
           CAST(count(l_quantity) AS INT) AS quantity_valid_hours
    FROM lineitem GROUP BY 1, 2
    """,
)
def multi_year_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("cell"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_quantity").alias("quantity"),
    )
    return rounded_columns(
        reduce_daily(series, ["quantity"], keys=("cell",), min_valid_hours=1)
    )


# --- hourly columns and scans ---------------------------------------------------

INTERMEDIATES = ("tc", "p_hpa", "vp_hpa", "es_hpa", "es_slope", "rh_pct", "wind_ms")


@register(
    "hourly_intermediates",
    fx.with_fixtures(
        ("obs",),
        DERIVED.format(source="obs"),
        select="SELECT lat_idx, lon_idx, ts, "
        + ", ".join(f"round({name}, 6) AS {name}" for name in INTERMEDIATES)
        + " FROM d3",
    ),
)
def hourly_intermediates(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = with_quantities(fx.obs(spark, sf_dir), INTERMEDIATES)
    return rounded_columns(derived.select("lat_idx", "lon_idx", "ts", *INTERMEDIATES))


@register(
    "temperature_round_trip",
    fx.with_fixtures(
        ("obs",),
        select="""
        SELECT lat_idx, lon_idx, ts, round(tmp_k - 273.15e0, 6) AS tc,
               round((tmp_k - 273.15e0) * 1.8e0 + 32.0e0, 6) AS tf,
               round((((tmp_k - 273.15e0) * 1.8e0 + 32.0e0) - 32.0e0) / 1.8e0, 6) AS back
        FROM obs""",
    ),
)
def temperature_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    degrees = fx.obs(spark, sf_dir).select(
        "lat_idx", "lon_idx", "ts", air.celsius_from_kelvin(F.col("tmp_k")).alias("tc")
    )
    there = degrees.withColumn("tf", air.fahrenheit(F.col("tc")))
    return rounded_columns(there.withColumn("back", air.celsius_from_fahrenheit(F.col("tf"))))


@register(
    "nan_to_null",
    fx.with_fixtures(
        ("obs",),
        select="""
        SELECT lat_idx, lon_idx, ts,
               CASE WHEN (day(ts) + hour(ts)) % 7 <> 0 THEN round(tmp_k, 6) END AS tmp_k,
               CASE WHEN (day(ts) + hour(ts)) % 11 <> 0 AND (day(ts) + hour(ts)) % 13 <> 0
                    THEN round(spfh, 9) END AS spfh
        FROM obs""",
    ),
)
def nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(hourly_source.clean(fx.obs_nan(spark, sf_dir)))


@register(
    "pivot_long_variables",
    fx.with_fixtures(
        ("obs_long",),
        select="""
        SELECT cell, ts, round(max(CASE WHEN variable = 'tmp_k' THEN value END), 6) AS tmp_k,
               round(max(CASE WHEN variable = 'spfh' THEN value END), 9) AS spfh,
               round(max(CASE WHEN variable = 'pres_pa' THEN value END), 6) AS pres_pa
        FROM obs_long GROUP BY cell, ts""",
    ),
)
def pivot_long_variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = fx.obs_long(spark, sf_dir)
    return rounded_columns(hourly_source.widen(long, ("tmp_k", "spfh", "pres_pa"), ("cell", "ts")))


@register(
    "scan_year_crop",
    fx.with_fixtures(
        ("year_end",),
        select="""
        SELECT lat_idx, lon_idx, ts, round(tmp_k, 6) AS tmp_k, round(spfh, 9) AS spfh,
               round(pres_pa, 6) AS pres_pa
        FROM year_end
        WHERE year(ts) = 2000 AND lat_idx >= 2 AND lat_idx < 34 AND lon_idx >= 8 AND lon_idx < 24
        """,
    ),
)
def scan_year_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lay two years out, then read one year and a box of it."""
    path = f"{new_store(spark)}/hourly"
    cells = fx.year_end(spark, sf_dir).join(fx.grid(spark, sf_dir), ["lat_idx", "lon_idx"])
    hourly_source.write_hourly(cells, path, STORE_TILES)
    hourly = hourly_source.scan_hourly(spark, path)
    box = region.Extent(2, 34, 8, 24)
    chosen = hourly_source.select_hourly(hourly, [2000], ["humidex"], box)
    return rounded_columns(chosen.select("lat_idx", "lon_idx", "ts", "tmp_k", "spfh", "pres_pa"))


@register(
    "validate_hourly",
    """
    SELECT min(ts) AS first_ts, min(ts) = date_trunc('day', min(ts)) AS starts_at_midnight,
           CAST(count(DISTINCT date_trunc('hour', ts)) AS BIGINT) AS hours,
           count(DISTINCT date_trunc('hour', ts)) % 24 = 0 AS whole_days, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (ts <> date_trunc('hour', ts)) AS BIGINT) AS off_hour_rows,
           CAST(count(*) - count(DISTINCT (user_id, date_trunc('hour', ts))) AS BIGINT) AS repeated_rows
    FROM events
    """,
)
def validate_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events, which repeat hours and seldom fall on one."""
    return checks.hourly_coverage(fx.table(spark, sf_dir, "events"), ("user_id",))


# --- region, masks, tiles ---------------------------------------------------------


@register(
    "grid_axes",
    fx.with_fixtures(
        ("grid",),
        select="""
        SELECT DISTINCT 'latitude' AS axis, lat_idx AS idx, latitude AS coordinate FROM grid
        UNION ALL SELECT DISTINCT 'longitude', lon_idx, longitude FROM grid""",
    ),
)
def grid_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygons.grid_axes(fx.grid(spark, sf_dir))


@register(
    "grid_mismatch",
    fx.with_fixtures(
        ("grid", "other_grid"),
        select="""
        SELECT axis, idx, e.coordinate AS expected, a.coordinate AS actual
        FROM (SELECT DISTINCT 'latitude' AS axis, lat_idx AS idx, latitude AS coordinate FROM grid
              UNION ALL SELECT DISTINCT 'longitude', lon_idx, longitude FROM grid) AS e
        FULL JOIN (SELECT DISTINCT 'latitude' AS axis, lat_idx AS idx, latitude AS coordinate
                   FROM other_grid
                   UNION ALL SELECT DISTINCT 'longitude', lon_idx, longitude FROM other_grid) AS a
        USING (axis, idx)
        WHERE e.coordinate IS DISTINCT FROM a.coordinate""",
    ),
)
def grid_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.grid_differences(fx.grid(spark, sf_dir), fx.other_grid(spark, sf_dir))


MASKED = ("tmp_k", "spfh", "pres_pa")


@register(
    "mask_null_outside",
    fx.with_fixtures(
        ("hourly_grid", "region_cells"),
        select="""
        SELECT h.lat_idx, h.lon_idx, ts, CASE WHEN inside THEN round(tmp_k, 6) END AS tmp_k,
               CASE WHEN inside THEN round(spfh, 9) END AS spfh,
               CASE WHEN inside THEN round(pres_pa, 6) END AS pres_pa
        FROM hourly_grid AS h LEFT JOIN region_cells AS r
          ON h.lat_idx = r.lat_idx AND h.lon_idx = r.lon_idx""",
    ),
)
def mask_null_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = fx.hourly_grid(spark, sf_dir).select("lat_idx", "lon_idx", "ts", *MASKED)
    return rounded_columns(region.mask_outside(hourly, fx.region_cells(spark, sf_dir)))


INSIDE_SQL = """
SELECT lat_idx, lon_idx, ts, round(tmp_k, 6) AS tmp_k, round(spfh, 9) AS spfh,
       round(pres_pa, 6) AS pres_pa
FROM hourly_grid
"""


@register(
    "mask_semi_join",
    fx.with_fixtures(
        ("hourly_grid", "region_cells"),
        select=INSIDE_SQL
        + "WHERE (lat_idx, lon_idx) IN (SELECT (lat_idx, lon_idx) FROM region_cells WHERE inside)",
    ),
)
def mask_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = fx.hourly_grid(spark, sf_dir).select("lat_idx", "lon_idx", "ts", *MASKED)
    return rounded_columns(region.keep_inside(hourly, fx.region_cells(spark, sf_dir)))


@register(
    "occupied_tiles_filter",
    fx.with_fixtures(
        ("hourly_grid", "region_cells"),
        select=INSIDE_SQL
        + """WHERE (lat_idx // 4, lon_idx // 8)
                   IN (SELECT (lat_idx // 4, lon_idx // 8) FROM region_cells WHERE inside)""",
    ),
)
def occupied_tiles_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = fx.hourly_grid(spark, sf_dir).select("lat_idx", "lon_idx", "ts", *MASKED)
    cells = fx.region_cells(spark, sf_dir)
    return rounded_columns(tiles.keep_occupied(hourly, cells, fx.REGION_TILES))


BOX_SQL = """
SELECT min(lat_idx) AS lat_start, max(lat_idx) + 1 AS lat_stop,
       min(lon_idx) AS lon_start, max(lon_idx) + 1 AS lon_stop
FROM region_cells WHERE inside
"""


@register("region_bbox", fx.with_fixtures(("region_cells",), select=BOX_SQL))
def region_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region.bounding_box(fx.region_cells(spark, sf_dir))


@register(
    "region_bbox_snapped",
    fx.with_fixtures(
        ("region_cells",),
        f"box AS ({BOX_SQL})",
        "sizes AS (SELECT max(lat_idx) + 1 AS lat_size, max(lon_idx) + 1 AS lon_size FROM grid)",
        select="""
        SELECT lat_start // 7 * 7 AS lat_start, least((lat_stop + 6) // 7 * 7, lat_size) AS lat_stop,
               lon_start // 9 * 9 AS lon_start, least((lon_stop + 8) // 9 * 9, lon_size) AS lon_stop
        FROM box, sizes""",
    ),
)
def region_bbox_snapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return region.bounding_box(fx.region_cells(spark, sf_dir), (7, 9))


TILES_CTE = """
occupied AS (SELECT DISTINCT lat_idx // 4 AS tile_row, lon_idx // 8 AS tile_col
             FROM region_cells WHERE inside)"""

BLOCKS_CTE = """
runs AS (SELECT tile_row, tile_col,
                tile_col - row_number() OVER (PARTITION BY tile_row ORDER BY tile_col) AS island
         FROM occupied),
blocks AS (SELECT tile_row, min(tile_col) AS first_col, max(tile_col) AS last_col,
                  count(*) AS tiles FROM runs GROUP BY tile_row, island)"""


@register(
    "occupied_tiles",
    fx.with_fixtures(("region_cells",), TILES_CTE, select="SELECT tile_row, tile_col FROM occupied"),
)
def occupied_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.occupied_tiles(fx.region_cells(spark, sf_dir), fx.REGION_TILES)


@register(
    "occupied_blocks",
    fx.with_fixtures(
        ("region_cells",),
        TILES_CTE,
        BLOCKS_CTE,
        select="""
        SELECT tile_row, tile_row * 4 AS lat_start,
               least(tile_row * 4 + 4, (SELECT max(lat_idx) + 1 FROM grid)) AS lat_stop,
               first_col * 8 AS lon_start,
               least(last_col * 8 + 8, (SELECT max(lon_idx) + 1 FROM grid)) AS lon_stop
        FROM blocks""",
    ),
)
def occupied_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = tiles.occupied_blocks(fx.region_cells(spark, sf_dir), fx.REGION_TILES)
    return blocks.orderBy("lat_start", "lon_start")


@register(
    "tile_coverage_summary",
    fx.with_fixtures(
        ("region_cells",),
        TILES_CTE,
        BLOCKS_CTE,
        f"box AS ({BOX_SQL})",
        select="""
        SELECT (SELECT count(*) FROM blocks) AS blocks, (SELECT count(*) FROM occupied) AS covered,
               CAST(((lat_stop + 3) // 4 - lat_start // 4)
                    * ((lon_stop + 7) // 8 - lon_start // 8) AS BIGINT) AS total,
               CAST(((lat_stop + 3) // 4 - lat_start // 4) * ((lon_stop + 7) // 8 - lon_start // 8)
                    - (SELECT count(*) FROM occupied) AS BIGINT) AS skipped
        FROM box""",
    ),
)
def tile_coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.tile_coverage(fx.region_cells(spark, sf_dir), fx.REGION_TILES)


# --- polygons -----------------------------------------------------------------------


@register(
    "polygon_edges",
    fx.with_fixtures(
        ("edges",),
        select="""
        SELECT poly_id, ring_id, pos, round(x1, 6) AS x1, round(y1, 6) AS y1,
               round(x2, 6) AS x2, round(y2, 6) AS y2
        FROM edges""",
    ),
)
def polygon_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(polygons.edges_of(fx.vertices(spark, sf_dir)))


@register(
    "polygon_extent",
    fx.with_fixtures(
        ("vertices",),
        select="""
        SELECT poly_id, round(min(x), 6) AS min_x, round(max(x), 6) AS max_x,
               round(min(y), 6) AS min_y, round(max(y), 6) AS max_y
        FROM vertices GROUP BY poly_id""",
    ),
)
def polygon_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(polygons.polygon_extent(fx.vertices(spark, sf_dir)))


@register(
    "web_mercator_to_lonlat",
    fx.with_fixtures(
        ("mercator_vertices",),
        select="""
        SELECT poly_id, ring_id, pos, round(degrees(x / 6378137.0e0), 6) AS x,
               round(degrees(2.0e0 * atan(exp(y / 6378137.0e0)) - pi() / 2.0e0), 6) AS y
        FROM mercator_vertices""",
    ),
)
def web_mercator_to_lonlat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_columns(polygons.reproject(fx.mercator_vertices(spark, sf_dir)))


INSIDE_POLYGONS = """
        hits AS (SELECT lat_idx, lon_idx, poly_id
                 FROM grid JOIN edges
                   ON latitude > least(y1, y2) AND latitude <= greatest(y1, y2)
                  AND longitude <= greatest(x1, x2)
                  AND (x1 = x2 OR longitude <= (latitude - y1) * (x2 - x1) / (y2 - y1) + x1)
                 GROUP BY lat_idx, lon_idx, poly_id HAVING count(*) % 2 = 1)"""

INSIDE_SELECT = """
        SELECT lat_idx, lon_idx, latitude, longitude,
               (lat_idx, lon_idx) IN (SELECT (lat_idx, lon_idx) FROM hits) AS inside
        FROM grid"""


@register(
    "point_in_polygon",
    fx.with_fixtures(
        ("grid", "edges"),
        INSIDE_POLYGONS,
        select=INSIDE_SELECT,
    ),
)
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = polygons.edges_of(fx.vertices(spark, sf_dir))
    return polygons.cells_in_polygons(edges, fx.grid(spark, sf_dir))


@register("build_region", fx.with_fixtures(("grid", "edges"), INSIDE_POLYGONS, select=INSIDE_SELECT))
def build_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested polygons, written and read as a source, to a stored region."""
    root = new_store(spark)
    fx.nested_polygons(spark, sf_dir).write.parquet(f"{root}/polygons")
    polygons_read = boundary.read_polygons(spark, f"{root}/polygons")
    grid = fx.grid(spark, sf_dir)
    boundary.build_region(spark, f"{root}/region", grid, polygons_read)
    return boundary.build_region(spark, f"{root}/region", grid)


@register(
    "scattered_points_in_polygons",
    fx.with_fixtures(
        ("places", "edges"),
        select="""
        SELECT place, poly_id
        FROM places AS p JOIN edges AS e
          ON p.y > least(y1, y2) AND p.y <= greatest(y1, y2)
         AND p.x <= CASE WHEN x1 = x2 THEN x1
                         ELSE least(greatest(x1, x2), (p.y - y1) * (x2 - x1) / (y2 - y1) + x1) END
        GROUP BY place, poly_id HAVING count(*) % 2 = 1""",
    ),
)
def scattered_points_in_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places that are no grid cells, and the polygons that hold each."""
    edges = polygons.edges_of(fx.vertices(spark, sf_dir))
    cover = covering.cover_polygons(edges, f"{new_store(spark)}/cover")
    return covering.points_in_polygons(fx.places(spark, sf_dir), cover, "place")


# --- calendar -------------------------------------------------------------------------


@register(
    "daily_axis",
    """
    SELECT CAST(year(day) AS INT) AS year, CAST(day AS DATE) AS day
    FROM (SELECT unnest(generate_series(make_date(y, 1, 1)::TIMESTAMP, make_date(y, 12, 31)::TIMESTAMP,
                                        INTERVAL '1' DAY)) AS day
          FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders) AS years) AS days
    """,
)
def daily_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = fx.table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    return calendar.days_of_years(years)


@register(
    "day_axis_position",
    f"""
    SELECT DISTINCT CAST(l_shipdate AS DATE) AS day,
           CASE WHEN year(l_shipdate) BETWEEN {FIRST_YEAR + 1} AND {LAST_YEAR - 1}
                THEN CAST(date_diff('day', DATE '{FIRST_YEAR + 1}-01-01', CAST(l_shipdate AS DATE)) AS INT) END AS position
    FROM lineitem
    """,
)
def day_axis_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first and the last year of the data are off the axis."""
    days = fx.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    return calendar.locate_days(days, FIRST_YEAR + 1, LAST_YEAR - 1)


@register(
    "axis_mismatch",
    f"""
    WITH expected AS (SELECT CAST(day AS DATE) AS day
                      FROM generate_series(TIMESTAMP '{FIRST_YEAR}-02-01', TIMESTAMP '{LAST_YEAR}-10-31',
                                           INTERVAL '1' DAY) AS s(day)),
         actual AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)
    SELECT coalesce(e.day, a.day) AS day,
           CASE WHEN a.day IS NULL THEN 'missing' ELSE 'unexpected' END AS problem
    FROM expected AS e FULL JOIN actual AS a ON e.day = a.day
    WHERE a.day IS NULL OR e.day IS NULL
    """,
)
def axis_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The axis from February of the first to October of the last year against the data."""
    axis = calendar.day_axis(spark, FIRST_YEAR, LAST_YEAR)
    first, last = F.make_date(F.lit(FIRST_YEAR), F.lit(2), F.lit(1)), F.make_date(
        F.lit(LAST_YEAR), F.lit(10), F.lit(31)
    )
    days = fx.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    return checks.axis_differences(axis.where(F.col("day").between(first, last)), days, ["day"])


@register(
    "dense_daily_cube",
    fx.with_fixtures(
        ("obs_gap",),
        *daily_ctes("obs_gap", ["temperature"], 20),
        f"""
        spine AS (SELECT lat_idx, lon_idx, CAST(day AS DATE) AS day
                  FROM (SELECT DISTINCT lat_idx, lon_idx FROM obs) AS cells
                  CROSS JOIN generate_series(TIMESTAMP '{STORE_YEAR}-01-01',
                                             TIMESTAMP '{STORE_YEAR}-12-31', INTERVAL '1' DAY) AS s(day)),
        dense AS (SELECT lat_idx, lon_idx, day, temperature_min, temperature_mean, temperature_max,
                         coalesce(temperature_valid_hours, 0) AS temperature_valid_hours
                  FROM spine LEFT JOIN daily USING (lat_idx, lon_idx, day))""",
        select=rounded_daily(["temperature"], "dense"),
    ),
)
def dense_daily_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = daily_metrics(fx.obs_gap(spark, sf_dir), ["temperature"], min_valid_hours=20)
    cells = fx.obs_region(spark, sf_dir)
    return rounded(
        calendar.dense_daily(daily, cells, STORE_YEAR, STORE_YEAR), ["temperature"]
    )


# --- storage and completion -------------------------------------------------------------

STORED = ["humidex", "simplified_wbgt"]


@register(
    "daily_append_metric",
    with_daily(
        "obs_gap", STORED, 20,
        " UNION ALL ".join(
            f"""SELECT '{name}' AS metric, CAST(year(day) AS INT) AS year, day, lat_idx, lon_idx,
                round(CAST(CAST({name}_min AS FLOAT) AS DOUBLE), 6) AS min,
                round(CAST(CAST({name}_mean AS FLOAT) AS DOUBLE), 6) AS mean,
                round(CAST(CAST({name}_max AS FLOAT) AS DOUBLE), 6) AS max,
                {name}_valid_hours AS valid_hours FROM daily"""
            for name in STORED
        ),
    ),
)
def daily_append_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write one metric, then another beside it, and read the store back."""
    root = new_store(spark)
    hourly = fx.obs_gap(spark, sf_dir)
    for name in STORED:
        daily = daily_metrics(hourly, [name], min_valid_hours=20)
        daily_store.publish_daily(to_long(daily, [name]), root, [name], [STORE_YEAR])
    stored = daily_store.read_daily(spark, root, STORED, [STORE_YEAR])
    return stored.select(
        "metric", "year", "day", "lat_idx", "lon_idx",
        *(F.round(F.col(s).cast("double"), 6).alias(s) for s in STATISTICS),
        F.col("valid_hours").cast("int").alias("valid_hours"),
    )


def new_store(spark: SparkSession) -> str:
    """A folder of its own for each call; it has to outlive the result that reads it."""
    return f"{shared_folder(spark)}/heatgrid-{uuid4().hex}"


REPORTED = ["humidex", "temperature"]


@register(
    "gap_report",
    with_daily(
        "obs_gap", REPORTED, 24,
        """
        SELECT CAST(year(day) AS INT) AS year,
               CAST(count(*) FILTER (WHERE hours < 24) AS BIGINT) AS incomplete_cell_days,
               CAST(count(*) FILTER (WHERE hours = 0) AS BIGINT) AS fully_missing_cell_days
        FROM cube GROUP BY 1""",
        "obs_region AS (" + fx.OBS_REGION + ")",
        f"""
        cube AS (
          SELECT s.day, m.name, coalesce(CASE m.name WHEN 'humidex' THEN humidex_valid_hours
                                                     ELSE temperature_valid_hours END, 0) AS hours
          FROM (SELECT CAST(day AS DATE) AS day
                FROM generate_series(TIMESTAMP '2023-01-01', TIMESTAMP '{STORE_YEAR}-12-31',
                                     INTERVAL '1' DAY) AS g(day)) AS s
          CROSS JOIN (SELECT lat_idx, lon_idx FROM obs_region WHERE inside) AS c
          CROSS JOIN (VALUES ('humidex'), ('temperature')) AS m(name)
          LEFT JOIN daily AS d
            ON d.day = s.day AND d.lat_idx = c.lat_idx AND d.lon_idx = c.lon_idx)""",
    ),
)
def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_store(spark)
    long = to_long(daily_metrics(fx.obs_gap(spark, sf_dir), REPORTED), REPORTED)
    daily_store.publish_daily(long, root, REPORTED, [STORE_YEAR])
    daily = daily_store.read_daily(spark, root)
    cells = fx.obs_region(spark, sf_dir)
    return daily_store.gap_report(daily, cells, REPORTED, STORE_YEAR - 1, STORE_YEAR)


STORE_TILES = (64, 20)
RUN_METRICS = ["humidex", "temperature"]


def stored_columns(metric: str, table: str = "daily", places: int = 4) -> str:
    """The rows of one metric as the store keeps them, from the wide ``daily`` of the oracle."""
    values = ", ".join(
        f"round(CAST(CAST({metric}_{s} AS FLOAT) AS DOUBLE), {places}) AS {s}" for s in STATISTICS
    )
    return f"""SELECT '{metric}' AS metric, CAST(year(day) AS INT) AS year, day, lat_idx, lon_idx, {values},
               {metric}_valid_hours AS valid_hours FROM {table}"""


def stored_rows(daily: DataFrame, places: int = 4) -> DataFrame:
    return daily.select(
        "metric", "year", "day", "lat_idx", "lon_idx",
        *(F.round(F.col(s).cast("double"), places).alias(s) for s in STATISTICS),
        F.col("valid_hours").cast("int").alias("valid_hours"),
    )


@register(
    "run_daily_store",
    fx.with_fixtures(
        ("year_end", "grid", "edges"),
        INSIDE_POLYGONS,
        "inside_hours AS (SELECT * FROM year_end WHERE (lat_idx, lon_idx) IN (SELECT (lat_idx, lon_idx) FROM hits))",
        *daily_ctes("inside_hours", RUN_METRICS, 23),
        "stored AS (" + " UNION ALL ".join(stored_columns(name) for name in RUN_METRICS) + ")",
        f"""
        tiles AS (SELECT DISTINCT lat_idx // {STORE_TILES[0]} AS r, lon_idx // {STORE_TILES[1]} AS c FROM hits),
        facts AS (
          SELECT (SELECT count(*) FROM (SELECT DISTINCT lat_idx, lon_idx FROM hits)) AS cells, count(*) AS tiles_read,
                 (max(r) - min(r) + 1) * (max(c) - min(c) + 1) - count(*) AS tiles_skipped FROM tiles),
        gaps AS (
          SELECT metric, year, cells * (365 + (year = 2000)::INT) - count(*) FILTER (valid_hours >= 24) AS incomplete_cell_days,
                 cells * (365 + (year = 2000)::INT) - count(*) FILTER (valid_hours > 0) AS fully_missing_cell_days,
                 tiles_read, tiles_skipped
          FROM stored, facts GROUP BY metric, year, cells, tiles_read, tiles_skipped)""",
        select="""
        SELECT s.*, CAST(incomplete_cell_days AS BIGINT) AS incomplete_cell_days,
               CAST(fully_missing_cell_days AS BIGINT) AS fully_missing_cell_days,
               CAST(tiles_read AS BIGINT) AS tiles_read, CAST(tiles_skipped AS BIGINT) AS tiles_skipped
        FROM stored AS s JOIN gaps AS g ON s.metric = g.metric AND s.year = g.year""",
    ),
)
def run_daily_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole path: lay hours out over a year end, build the region, run, add a metric, read back.

    Each row has what its run reported for its metric and year.
    """
    root = new_store(spark)
    grid = fx.grid(spark, sf_dir)
    cells = fx.year_end(spark, sf_dir).join(grid, ["lat_idx", "lon_idx"])
    hourly_source.write_hourly(cells, f"{root}/hourly", STORE_TILES)
    region_cells = boundary.build_region(spark, f"{root}/region", grid, fx.nested_polygons(spark, sf_dir))
    hourly = hourly_source.scan_hourly(spark, f"{root}/hourly")
    reports = [
        report
        for wanted in (RUN_METRICS[:1], RUN_METRICS)
        for report in run_daily(spark, hourly, region_cells, f"{root}/out", wanted, 1999, 2000, STORE_TILES, 23)
    ]
    told = few_rows(
        spark,
        [(r.metrics[0], r.year, r.incomplete_cell_days, r.fully_missing_cell_days, r.tiles_read, r.tiles_skipped) for r in reports],
        "metric string, year int, incomplete_cell_days long, fully_missing_cell_days long, tiles_read long, tiles_skipped long",
    )
    return stored_rows(daily_store.read_daily(spark, f"{root}/out")).join(F.broadcast(told), ["metric", "year"])


ATTEMPTED = ["humidex", "temperature"]


@register(
    "published_attempts",
    with_daily(
        "obs", ATTEMPTED, 20,
        f"""{stored_columns("humidex", places=3)} WHERE lat_idx % 2 = 1
            UNION ALL {stored_columns("temperature", places=3)} WHERE lat_idx % 3 <> 0""",
    ),
)
def published_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writes to one store: one recorded for two metrics, one that breaks off before it is recorded, and
    one recorded for the first metric only. What counts is the last of each metric, whole and alone."""
    root = new_store(spark)
    daily = to_long(daily_metrics(fx.obs(spark, sf_dir), ATTEMPTED, min_valid_hours=20), ATTEMPTED)
    daily_store.publish_daily(daily.where(F.col("lat_idx") % 3 != 0), root, ATTEMPTED, [STORE_YEAR])
    daily_store.write_daily(daily, root)
    second = daily.where((F.col("metric") == ATTEMPTED[0]) & (F.col("lat_idx") % 2 == 1))
    daily_store.publish_daily(second, root, ATTEMPTED[:1], [STORE_YEAR])
    daily_store.remove_superseded(spark, root)
    return stored_rows(daily_store.read_daily(spark, root), 3)


REGION_PAIRS = {
    "same in another order": "SELECT * FROM region_cells",
    "one row of cells left out": "SELECT * REPLACE (inside AND lat_idx <> 7 AS inside) FROM region_cells",
    "other coordinates": "SELECT * REPLACE (latitude + CASE WHEN lat_idx = 7 THEN 0.125e0 ELSE 0.0e0 END AS latitude) FROM region_cells",
    "cells turned over": "SELECT * REPLACE (NOT inside AS inside) FROM region_cells",
    "a cell twice": "SELECT * FROM region_cells UNION ALL SELECT * FROM region_cells WHERE lat_idx = 3 AND lon_idx = 5",
}


@register(
    "region_identity",
    fx.with_fixtures(
        ("region_cells",),
        *(f"other{i} AS ({sql})" for i, sql in enumerate(REGION_PAIRS.values())),
        select=" UNION ALL ".join(
            f"""SELECT '{name}' AS pair, CAST((SELECT count(*) FROM other{i}) AS BIGINT) AS n_cells,
                (SELECT count(*) FROM (FROM region_cells EXCEPT ALL FROM other{i})) = 0
                AND (SELECT count(*) FROM (FROM other{i} EXCEPT ALL FROM region_cells)) = 0 AS same"""
            for i, name in enumerate(REGION_PAIRS)
        ),
    ),
)
def region_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region against others of the fixtures, by fingerprints that each take one aggregation."""
    cells = fx.region_cells(spark, sf_dir)
    lat, lon = F.col("lat_idx"), F.col("lon_idx")
    others = [
        cells.repartition(7, "lon_idx"),
        cells.withColumn("inside", F.col("inside") & (lat != 7)),
        cells.withColumn("latitude", F.col("latitude") + F.when(lat == 7, 0.125).otherwise(0.0)),
        cells.withColumn("inside", ~F.col("inside")),
        cells.unionByName(cells.where((lat == 3) & (lon == 5))),
    ]
    known = identity.fingerprint(cells)
    pairs = None
    for name, other in zip(REGION_PAIRS, others):
        counted = other.agg(F.count(F.lit(1)).alias("n_cells"), identity.print_of(cells.columns).alias("fingerprint"))
        row = counted.select(F.lit(name).alias("pair"), "n_cells", "fingerprint")
        pairs = row if pairs is None else pairs.unionByName(row)
    return pairs.select("pair", "n_cells", (F.col("fingerprint") == known.scalar()).alias("same"))


@register(
    "late_hours",
    with_daily(
        "obs_gap", ATTEMPTED, 20,
        " UNION ALL ".join(stored_columns(name, places=3) for name in ATTEMPTED),
    ),
)
def late_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose hours come in three deliveries, the evening first."""
    root = new_store(spark)
    hourly = fx.obs_gap(spark, sf_dir)
    hour = F.hour("ts")
    for part in (hour >= 17, hour < 5, (hour >= 5) & (hour < 17)):
        deliver_hours(spark, root, hourly.where(part), ATTEMPTED, min_valid_hours=20)
    return stored_rows(daily_store.read_daily(spark, root), 3)


WIDE = ["humidex", "specific_humidity"]


@register(
    "daily_wide_with_units",
    with_daily(
        "obs", WIDE, 20,
        "SELECT lat_idx, lon_idx, day, "
        + ", ".join(
            f"round(CAST(CAST({name}_{s} AS FLOAT) AS DOUBLE), {digits(name) - 2}) AS {name}_{s}" for name in WIDE for s in ("min", "max")
        )
        + ", 'deg_F' AS humidex_units, 'kg/kg' AS specific_humidity_units FROM daily",
    ),
)
def daily_wide_with_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of different units stored in one table, read back as columns that carry theirs."""
    root = new_store(spark)
    daily = daily_metrics(fx.obs(spark, sf_dir), WIDE, min_valid_hours=20)
    daily_store.publish_daily(to_long(daily, WIDE), root, WIDE, [STORE_YEAR])
    daily_store.record_units(spark, root, WIDE)
    wide = daily_store.read_wide(spark, root, WIDE)
    units = (F.lit(wide.schema[f"{name}_mean"].metadata["units"]).alias(f"{name}_units") for name in WIDE)
    values = (
        F.round(F.col(f"{name}_{s}").cast("double"), digits(name) - 2).alias(f"{name}_{s}") for name in WIDE for s in ("min", "max")
    )
    return wide.select("lat_idx", "lon_idx", "day", *values, *units)


FINISHED_SQL = "SELECT DISTINCT 'humidex' AS metric, CAST(year(o_orderdate) AS INT) AS year FROM orders"


@register(
    "manifest_union",
    fx.with_fixtures(
        ("manifest",), select=f"SELECT metric, year FROM manifest UNION {FINISHED_SQL}"
    ),
)
def manifest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    finished = fx.table(spark, sf_dir, "orders").select(
        F.lit("humidex").alias("metric"), F.year("o_orderdate").alias("year")
    )
    return daily_store.union_manifest(fx.manifest(spark, sf_dir), finished)


@register(
    "completed_years",
    fx.with_fixtures(
        ("manifest",),
        select="""
        SELECT metric, string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years,
               CAST(count(*) AS INT) AS n_years
        FROM manifest GROUP BY metric""",
    ),
)
def completed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = daily_store.completed_years(fx.manifest(spark, sf_dir))
    return years.select(
        "metric",
        F.array_join(F.col("years").cast("array<string>"), ",").alias("years"),
        F.size("years").alias("n_years"),
    )


REQUESTED = ["wet_bulb_temperature", "humidex", "heat_index", "temperature"]


@register(
    "pending_metrics",
    fx.with_fixtures(
        ("manifest",),
        select=f"""
        SELECT r.metric, r.request_order, CAST(count(*) AS INT) AS missing_years
        FROM (VALUES {", ".join(f"({i}, '{m}')" for i, m in enumerate(REQUESTED))}
             ) AS r(request_order, metric)
        CROSS JOIN generate_series({FIRST_YEAR}, {LAST_YEAR}) AS y(year)
        LEFT JOIN manifest AS f ON f.metric = r.metric AND f.year = y.year
        WHERE f.year IS NULL GROUP BY 1, 2""",
    ),
)
def pending_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = fx.manifest(spark, sf_dir)
    return daily_store.pending_metrics(spark, manifest, REQUESTED, FIRST_YEAR, LAST_YEAR)

"""The stored daily table, its manifest, and the hourly layouts."""

import dataclasses

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import day, grid_frame, to_spark, weather
from heatgrid.functions.metrics import METRICS
from heatgrid.operators.daily import daily_metrics, to_long, to_wide
from heatgrid.operators.region import Extent
from heatgrid.schema import MANIFEST
from heatgrid.sources import daily_store as store
from heatgrid.sources import hourly as source


@pytest.fixture
def hourly(spark):
    return to_spark(spark, weather(days=2))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "store")


def put(hourly, root, *metrics, years=(2000,)):
    store.publish_daily(to_long(daily_metrics(hourly, metrics), metrics), root, metrics, years)


SETUP = store.StoreSetup(1999, 2000, 20, 4, 8, 0, 1, "grid", "region")


def files(root, part):
    from pathlib import Path

    return {p: p.read_bytes() for p in Path(root, "daily").rglob("*.parquet") if part in str(p)}


def test_round_trip_and_types(spark, hourly, root):
    put(hourly, root, "humidex", "temperature")
    stored = store.read_daily(spark, root)
    assert dict(stored.dtypes) == {
        "metric": "string", "year": "int", "tile": "bigint", "day": "date", "lat_idx": "int", "lon_idx": "int",
        "min": "float", "mean": "float", "max": "float", "valid_hours": "tinyint",
    }
    assert stored.count() == 16
    wide = to_wide(stored, ["humidex"]).toPandas()
    direct = daily_metrics(hourly, ["humidex"]).toPandas()
    keys = ["lat_idx", "lon_idx", "day"]
    merged = wide.merge(direct, on=keys)
    assert len(merged) == 8
    np.testing.assert_allclose(merged.humidex_mean_x, merged.humidex_mean_y, rtol=1e-6)


def test_adding_a_metric_leaves_the_files_of_others_alone(spark, hourly, root):
    put(hourly, root, "humidex")
    before = files(root, "humidex")
    put(hourly, root, "simplified_wbgt")
    assert files(root, "humidex") == before
    assert {r.metric for r in store.read_daily(spark, root).select("metric").distinct().collect()} == {
        "humidex", "simplified_wbgt",
    }


def test_rewriting_replaces_only_its_metric_year(spark, root):
    put(to_spark(spark, weather(days=2, start="1999-12-31")), root, "humidex", years=(1999, 2000))
    before = files(root, "year=1999")
    put(to_spark(spark, weather(days=1, start="2000-01-01", seed=9)), root, "humidex")
    put(to_spark(spark, weather(days=1, start="2000-01-01", seed=9)), root, "humidex")
    assert files(root, "year=1999") == before
    assert store.read_daily(spark, root, ["humidex"], [2000]).count() == 4
    assert store.read_daily(spark, root).count() == 8


def test_years_written_in_any_order_hold_each_day_once(spark, root):
    """Three years of two cells in different tiles, the middle one last and twice."""
    axis = pd.date_range("2003-01-01", "2005-12-31")
    rng = np.random.default_rng(11)
    frame = pd.concat(
        pd.DataFrame(
            {
                "metric": "heat_index", "day": axis.date, "year": axis.year, "tile": tile, "lat_idx": 9 * tile,
                "lon_idx": 4, "valid_hours": 24, "min": -1.0, "mean": rng.integers(0, 99, len(axis)), "max": 100.0,
            }
        )
        for tile in (0, 1)
    )
    for year in (2005, 2003, 2004, 2004):
        store.publish_daily(spark.createDataFrame(frame[frame.year == year]), root, ["heat_index"], [year])
    keys = ["lat_idx", "day"]
    stored = store.read_daily(spark, root).toPandas().sort_values(keys, ignore_index=True)
    expected = frame.sort_values(keys, ignore_index=True)
    assert stored["mean"].tolist() == expected["mean"].tolist()
    assert stored.day.tolist() == expected.day.tolist()


def test_one_cell_is_read_from_one_tile(spark, root):
    hourly = to_spark(spark, weather(days=1, rows=4, cols=6))
    store.check_store(spark, root, dataclasses.replace(SETUP, tile_rows=2, tile_cols=3))
    store.publish_daily(to_long(daily_metrics(hourly, ["humidex"]), ["humidex"], (2, 3)), root, ["humidex"], [2000])
    one = store.read_daily(spark, root, ["humidex"], [2000], cell=(3, 1))
    assert one.count() == 1
    read = {row[0] for row in one.select(F.input_file_name()).collect()}
    assert len(read) == 1 and "tile=1000000" in read.pop()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(tile" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


@pytest.mark.parametrize(
    "other, message",
    [
        ({"min_valid_hours": 24}, "does not match"),
        ({"tile_rows": 8}, "does not match"),
        ({"tile_cols": 4}, "does not match"),
        ({"block_rows": 2}, "does not match"),
        ({"start_year": 2000, "end_year": 2001}, "does not match"),  # as many days
        ({"end_year": 2001}, "does not match"),
        ({"grid": "other"}, "another grid"),
        ({"region": "other"}, "another region"),
    ],
)
def test_store_keeps_what_it_was_set_up_for(spark, root, other, message):
    store.check_store(spark, root, SETUP)
    store.check_store(spark, root, SETUP)
    with pytest.raises(ValueError, match=message):
        store.check_store(spark, root, dataclasses.replace(SETUP, **other))


# --- attempts ---------------------------------------------------------------------------


def test_nothing_unrecorded_is_seen(spark, hourly, root):
    long = to_long(daily_metrics(hourly, ["humidex"]), ["humidex"])
    attempt = store.write_daily(long, root)
    assert store.read_daily(spark, root).count() == 0
    store.record_completed(spark, root, ["humidex"], [2000], attempt)
    assert store.read_daily(spark, root).count() == 8


def test_a_broken_attempt_leaves_nothing_in_a_later_one(spark, hourly, root):
    """The first has cells of row 0, the second those of row 1 only."""
    long = to_long(daily_metrics(hourly, ["humidex"]), ["humidex"], (1, 1))
    store.write_daily(long.where("lat_idx = 0"), root)
    store.publish_daily(long.where("lat_idx = 1"), root, ["humidex"], [2000])
    assert {r.lat_idx for r in store.read_daily(spark, root).collect()} == {1}


def test_the_last_recorded_attempt_counts_and_others_are_removed(spark, hourly, root):
    names = ["humidex", "temperature"]
    long = to_long(daily_metrics(hourly, names), names)
    first = store.publish_daily(long, root, names, [2000])
    broken = store.write_daily(long, root)
    second = store.publish_daily(long.where("metric = 'humidex' AND lat_idx = 1"), root, ["humidex"], [2000])
    counts = {r.metric: r["count"] for r in store.read_daily(spark, root).groupBy("metric").count().collect()}
    assert counts == {"humidex": 4, "temperature": 8}
    removed = store.remove_superseded(spark, root)
    assert sorted(removed) == sorted([f"attempt={broken}", f"attempt={first}/metric=humidex/year=2000/block=0"])
    assert store.remove_superseded(spark, root) == []
    left = {p.split("attempt=")[1].split("/")[0] for p in map(str, files(root, ""))}
    assert left == {first, second}
    assert store.read_daily(spark, root).count() == 12


def test_blocks_are_recorded_one_by_one(spark, root):
    store.check_store(spark, root, dataclasses.replace(SETUP, block_rows=1, blocks=2))
    store.record_completed(spark, root, ["humidex"], [2000], "a", 0)
    assert store.read_manifest(spark, root).count() == 0
    store.record_completed(spark, root, ["humidex"], [2000], "b", 3)
    assert [tuple(r) for r in store.read_manifest(spark, root).collect()] == [("humidex", 2000)]


def test_one_cell_reads_few_rows_of_its_tile(spark, root):
    """Pages hold the days of a few cells, and their bounds are in the file."""
    rows = spark.range(300 * 366).select(
        F.lit("humidex").alias("metric"), F.lit(2000).alias("year"), F.lit(0).cast("long").alias("tile"),
        F.date_add(F.lit(day("2000-01-01")), (F.col("id") % 366).cast("int")).alias("day"),
        F.expr("int(id div 366 div 20)").alias("lat_idx"), F.expr("int(id div 366 % 20)").alias("lon_idx"),
        *(F.rand(s).cast("float").alias(name) for s, name in enumerate(("min", "mean", "max"))),
        F.lit(24).cast("tinyint").alias("valid_hours"),
    )
    store.publish_daily(rows, root, ["humidex"], [2000])
    one = store.read_daily(spark, root, cell=(7, 11))
    assert one.count() == 366
    scanned = rows_scanned(one)
    assert 366 <= scanned <= 0.06 * 300 * 366


def rows_scanned(df) -> int:
    """Rows that the file scans of an executed plan have put out."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.finalPhysicalPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return total


def test_wide_view_carries_the_stored_units(spark, hourly, root):
    names = ["humidex", "specific_humidity"]
    put(hourly, root, *names)
    own = {**METRICS, "humidex": dataclasses.replace(METRICS["humidex"], units="own unit")}
    for _ in range(2):
        store.record_units(spark, root, names, own)
    assert store.read_units(spark, root).count() == 2
    wide = store.read_wide(spark, root, names, [2000])
    assert wide.count() == 8
    assert wide.schema["humidex_max"].metadata["units"] == "own unit"
    assert wide.schema["specific_humidity_min"].metadata["units"] == "kg/kg"


# --- manifest ---------------------------------------------------------------------------


def pending(spark, root, metrics, first, last):
    rows = store.pending_metrics(spark, store.read_manifest(spark, root), metrics, first, last)
    return [row.metric for row in rows.orderBy("request_order").collect()]


def test_pending_until_every_year_is_recorded(spark, root):
    asked = ["humidex", "heat_index"]
    assert pending(spark, root, asked, 1999, 2000) == asked
    store.record_completed(spark, root, ["humidex"], [2000])
    assert pending(spark, root, asked, 1999, 2000) == asked
    assert pending(spark, root, asked, 2000, 2000) == ["heat_index"]
    store.record_completed(spark, root, ["humidex"], [1999, 2000])
    assert pending(spark, root, asked, 1999, 2000) == ["heat_index"]
    assert store.read_manifest(spark, root).count() == 2
    years = store.completed_years(store.read_manifest(spark, root)).collect()
    assert [(r.metric, r.years) for r in years] == [("humidex", [1999, 2000])]
    with pytest.raises(ValueError, match="no such metric"):
        pending(spark, root, ["nonsense"], 1999, 2000)


def test_union_is_idempotent(spark):
    a = spark.createDataFrame([("humidex", 1999), ("humidex", 2000)], MANIFEST)
    assert store.union_manifest(a, a).count() == 2


# --- gaps and metadata ----------------------------------------------------------------------


def test_gap_report_equals_counting_on_the_dense_cube(spark):
    frame = weather(days=3, start="1999-12-30", rows=2, cols=3)
    frame.loc[(frame.lat_idx == 0) & (frame.ts < "1999-12-30 05:00"), "tmp_k"] = np.nan
    frame.loc[(frame.lon_idx == 2) & (frame.ts >= "2000-01-01"), "spfh"] = np.nan
    frame = frame[~((frame.lat_idx == 1) & (frame.lon_idx == 1))]
    names = ["temperature", "humidex"]
    inside = grid_frame(2, 3, [[1, 1, 0], [1, 1, 1]])
    cells = spark.createDataFrame(inside)
    daily = to_long(daily_metrics(to_spark(spark, frame), names), names)
    got = {r.year: tuple(r)[1:] for r in store.gap_report(daily, cells, names, 1998, 2000).collect()}

    rows = daily.toPandas().merge(inside[inside.inside], on=["lat_idx", "lon_idx"])
    for year, days in ((1998, 365), (1999, 365), (2000, 366)):
        expected = days * 5 * 2
        hours = rows[rows.year == year].valid_hours
        assert got[year] == (expected - (hours == 24).sum(), expected - (hours > 0).sum())


def test_metadata_survives_parquet(spark, hourly, tmp_path):
    names = ["humidex", "relative_humidity", "specific_humidity"]
    path = str(tmp_path / "wide")
    store.describe(daily_metrics(hourly, names), names).write.parquet(path)
    fields = {f.name: f.metadata for f in spark.read.parquet(path).schema}
    assert fields["humidex_mean"]["units"] == "deg_F"
    assert fields["humidex_mean"]["source_timestep"] == "hourly"
    assert fields["relative_humidity_max"]["units"] == "percent"
    assert fields["specific_humidity_min"]["units"] == "kg/kg"
    assert fields["specific_humidity_valid_hours"]["units"] == "hours"
    assert "relative humidity" in fields["relative_humidity_max"]["description"]


# --- hourly sources --------------------------------------------------------------------------


def test_clean_renames_and_turns_nan_and_infinity_into_null(spark):
    bad = float("nan"), float("inf"), float("-inf"), None, 1.5
    raw = spark.createDataFrame([(i, v, 2.0) for i, v in enumerate(bad)], "id int, TMP_2maboveground double, SPFH_2maboveground float")
    got = source.clean(raw).orderBy("id")
    assert got.dtypes == [("id", "int"), ("tmp_k", "double"), ("spfh", "double")]
    assert [r.tmp_k for r in got.collect()] == [None] * 4 + [1.5]


def test_widen(spark, hourly):
    keys = ["lat_idx", "lon_idx", "ts"]
    long = hourly.unpivot(keys, ["tmp_k", "spfh"], "variable", "value").where(
        "NOT (variable = 'spfh' AND hour(ts) = 3)"
    )
    wide = source.widen(long, ["tmp_k", "spfh"])
    assert wide.count() == 192 and wide.where("spfh IS NULL").count() == 8
    expected = hourly.select(*keys, "tmp_k", F.when(F.hour("ts") != 3, F.col("spfh")).alias("spfh"))
    assert wide.select(expected.columns).exceptAll(expected).isEmpty()


def test_layout_scan_and_pruning(spark, tmp_path):
    path = str(tmp_path / "hourly")
    frame = pd.concat(
        [weather(days=1, start=f"{y}-12-31", rows=4, cols=4) for y in (1999, 2000)]
    )
    source.write_hourly(to_spark(spark, frame), path, (2, 2))
    scan = source.scan_hourly(spark, path)
    assert scan.count() == len(frame)
    chosen = source.select_hourly(scan, [2000], ["humidex"], Extent(0, 2, 1, 4))
    assert chosen.count() == 2 * 3 * 24
    assert set(chosen.columns) == {"lat_idx", "lon_idx", "ts", "tile", "tmp_k", "spfh", "pres_pa"}
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "u10" not in plan and "latitude" not in plan
    assert "PartitionFilters: [isnotnull(year" in plan or "(year" in plan.split("PartitionFilters")[1][:60]
    assert "GreaterThanOrEqual(lat_idx,0)" in plan and "LessThan(lon_idx,4)" in plan
    # Rewriting a year leaves the other alone, and has to be asked for.
    again = to_spark(spark, weather(days=1, start="2000-12-31", rows=4, cols=4))
    with pytest.raises(ValueError, match="already has hours of 2000"):
        source.write_hourly(again, path, (2, 2))
    source.write_hourly(again, path, (2, 2), replace=True)
    rewritten = source.scan_hourly(spark, path)
    assert rewritten.count() == len(frame)
    found = {row[0] for row in rewritten.select(F.to_date("ts")).distinct().collect()}
    assert found == {day("1999-12-31"), day("2000-12-31")}


def test_the_year_is_that_of_the_hour(spark, tmp_path):
    """Whatever the column says, and in UTC whatever the session says."""
    path = str(tmp_path / "hourly")
    frame = weather(days=2, start="1999-12-31").assign(year=1987)
    hourly = to_spark(spark, frame)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        source.write_hourly(hourly, path, (2, 2))
        found = source.scan_hourly(spark, path).groupBy("year").agg(F.min("ts"), F.count("*")).orderBy("year").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [(r[0], str(r[1]), r[2]) for r in found] == [
        (1999, "1999-12-31 00:00:00", 96), (2000, "2000-01-01 00:00:00", 96),
    ]


def test_bucketed_table_needs_no_shuffle(spark):
    frame = weather(days=2, rows=3, cols=3)
    source.save_bucketed(to_spark(spark, frame), "hourly_bucketed", 4)
    table = spark.table("hourly_bucketed")
    daily = daily_metrics(source.select_hourly(table, [2000], ["humidex"]), ["humidex"])
    assert "Exchange" not in daily._jdf.queryExecution().executedPlan().toString()
    assert daily.count() == 18
    spark.sql("DROP TABLE hourly_bucketed")


def test_a_small_tile_is_one_file_and_a_large_one_several(spark, tmp_path):
    """Files of the hourly table by tile, where Spark joins no partitions."""
    from pathlib import Path

    hourly = to_spark(spark, weather(days=1, rows=32, cols=4))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        source.write_hourly(hourly, str(tmp_path / "small"), (32, 4))
        source.write_hourly(hourly, str(tmp_path / "large"), (32, 256))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    small, large = (list(Path(tmp_path, name).rglob("*.parquet")) for name in ("small", "large"))
    assert len(small) == 1 and len(large) > 1
    assert source.scan_hourly(spark, str(tmp_path / "small")).count() == hourly.count()

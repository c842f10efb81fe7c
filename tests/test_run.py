"""The incremental run from an hourly table to the daily store."""

import time
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import grid_frame, to_spark, weather
from heatgrid.functions.metrics import METRICS
from heatgrid.operators import tiles
from heatgrid.operators.daily import daily_metrics, to_wide
from heatgrid.operators.region import mask_outside
from heatgrid.operators import checks
from heatgrid.plans import daily_run
from heatgrid.plans.daily_run import daily_in_region, run_daily
from heatgrid.sources.daily_store import current_records, read_daily, read_manifest
from heatgrid.sources.hourly import scan_hourly, write_hourly

TILES = (5, 6)
SIZE = 20


@pytest.fixture(scope="module")
def staircase():
    lat, lon = np.meshgrid(np.arange(SIZE), np.arange(SIZE), indexing="ij")
    return (np.abs(2 * lat - lon) <= 2) | ((lat == 17) & (lon == 1))


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source") / "hourly")
    frames = [weather(days=2, rows=SIZE, cols=SIZE, start="1999-12-30"), weather(days=1, rows=SIZE, cols=SIZE, start="2000-01-01")]
    frame = pd.concat(frames)
    frame.loc[(frame.lat_idx == 5) & (frame.lon_idx == 11) & (frame.ts.between("1999-12-30 13:00", "1999-12-30 15:00")), "spfh"] = np.nan
    write_hourly(to_spark(spark, frame), path, TILES)
    return path


@pytest.fixture(scope="module")
def region(spark, staircase, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("region") / "cells")
    spark.createDataFrame(grid_frame(SIZE, SIZE, staircase)).selectExpr(
        "int(lat_idx) lat_idx", "int(lon_idx) lon_idx", "latitude", "longitude", "inside"
    ).write.parquet(path)
    return spark.read.parquet(path)


def snapshot(root):
    return {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_run_rerun_and_extend(spark, source, region, staircase, tmp_path):
    root = str(tmp_path / "out")
    hourly = scan_hourly(spark, source)
    reports = run_daily(spark, hourly, region, root, ["humidex", "temperature"], 1999, 2000, TILES)
    inside = int(staircase.sum())
    assert [(r.year, r.metrics) for r in reports] == [
        (1999, ("humidex", "temperature")), (2000, ("humidex", "temperature")),
    ]
    # Two days of 1999 are there, one cell-day of humidex is incomplete.
    assert reports[0].fully_missing_cell_days == 2 * inside * 363
    assert reports[0].incomplete_cell_days == 2 * inside * 363 + 1
    assert reports[1].incomplete_cell_days == 2 * inside * 365
    stored = read_daily(spark, root)
    assert stored.count() == 2 * inside * 3

    expected = daily_metrics(mask_outside(hourly.drop("year", "latitude", "longitude", "tile"), region), ["humidex", "temperature"])
    wide = to_wide(stored, ["humidex", "temperature"]).toPandas()
    merged = wide.merge(expected.toPandas(), on=["lat_idx", "lon_idx", "day"], suffixes=("", "_x"))
    assert len(merged) == inside * 3
    for column in [c for c in wide.columns if c.startswith(("humidex", "temperature"))]:
        np.testing.assert_allclose(merged[column].astype(float), merged[f"{column}_x"].astype(float), rtol=1e-6)
    outside = expected.toPandas().merge(grid_frame(SIZE, SIZE, staircase), on=["lat_idx", "lon_idx"])
    assert outside[~outside.inside].humidex_mean.isna().all()

    before = snapshot(root)
    assert run_daily(spark, hourly, region, root, ["temperature", "humidex"], 1999, 2000, TILES) == []
    assert snapshot(root) == before

    added = run_daily(spark, hourly, region, root, "all", 1999, 2000, TILES)
    assert {r.metrics for r in added} == {tuple(m for m in sorted(METRICS) if m not in ("humidex", "temperature"))}
    after = snapshot(root)
    assert {p: t for p, t in after.items() if p in before} == before
    assert read_daily(spark, root).count() == len(METRICS) * inside * 3
    assert read_manifest(spark, root).count() == 2 * len(METRICS)

    with pytest.raises(ValueError, match="does not match"):
        run_daily(spark, hourly, region, root, "all", 2000, 2001, TILES)
    with pytest.raises(ValueError, match="no such metric"):
        run_daily(spark, hourly, region, root, ["nonsense"], 1999, 2000, TILES)


def test_a_year_without_manifest_entry_is_done_again(spark, source, region, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    hourly = scan_hourly(spark, source)

    def lost(*_):
        raise RuntimeError("lost before the year was recorded")

    with monkeypatch.context() as patch:
        patch.setattr(daily_run, "record_completed", lost)
        with pytest.raises(RuntimeError):
            run_daily(spark, hourly, region, root, ["temperature"], 1999, 2000, TILES)
    assert read_daily(spark, root).count() == 0 and read_manifest(spark, root).count() == 0
    left = set(Path(root, "daily").iterdir())
    assert len(left) == 2
    reports = run_daily(spark, hourly, region, root, ["temperature"], 1999, 2000, TILES)
    assert [r.year for r in reports] == [1999, 2000]
    assert not left & set(Path(root, "daily").iterdir())
    assert read_daily(spark, root, years=[1999]).count() == 2 * region.where("inside").count()


@pytest.mark.parametrize("metrics", [["humidex"], sorted(METRICS)])
def test_a_region_too_large_to_broadcast_gives_the_same(spark, source, region, metrics):
    hourly = scan_hourly(spark, source).drop("year", "latitude", "longitude")
    small = daily_in_region(hourly, region, metrics, TILES)
    expected = small.toPandas()
    assert small._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") >= 2
    keys = ["lat_idx", "lon_idx", "day"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = daily_in_region(hourly, region, metrics, TILES)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        got = large.toPandas()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    got = got.sort_values(keys, ignore_index=True)
    pd.testing.assert_frame_equal(got, expected.sort_values(keys, ignore_index=True), rtol=1e-12)


def test_empty_tiles_are_pruned_at_the_scan(spark, source, region):
    hourly = scan_hourly(spark, source).drop("year", "latitude", "longitude")
    daily = daily_in_region(hourly, region, ["temperature"], TILES)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    occupied = {r.tile for r in tiles.with_tile_id(region.where("inside"), TILES).collect()}
    assert len(occupied) < 16  # of 4 x 4 tiles
    # Of the two years, each.
    assert partitions_read(daily) == 2 * len(occupied)


def partitions_read(df) -> int:
    """Partitions that the partitioned scan of an executed plan has read."""
    df.collect()
    root = df._jdf.queryExecution().executedPlan()
    counts, todo = [], [root]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.finalPhysicalPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif node.metrics().contains("numPartitions"):
            counts.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return max(counts)


def test_repeated_hours_stop_the_run(spark, region, tmp_path):
    frame = weather(days=1, rows=SIZE, cols=SIZE)
    path = str(tmp_path / "twice")
    write_hourly(to_spark(spark, pd.concat([frame, frame.iloc[:3]])), path, TILES)  # of cell (0, 0)
    hourly = scan_hourly(spark, path)
    with pytest.raises(Exception, match="more than one row for the same hour"):
        daily_in_region(hourly, region, ["temperature"], TILES).select("temperature_max").collect()
    with pytest.raises(Exception, match="more than one row for the same hour"):
        run_daily(spark, scan_hourly(spark, path), region, str(tmp_path / "o"), ["temperature"], 2000, 2000, TILES)


def test_repeated_hours_outside_the_region_do_not_matter(spark, region, staircase, tmp_path):
    """At any size of region, also in a tile that is read."""
    assert not staircase[0, 4] and staircase[0, 2]
    frame = weather(days=1, rows=SIZE, cols=SIZE)
    outside = frame[(frame.lat_idx == 0) & (frame.lon_idx == 4)].iloc[:3]
    path = str(tmp_path / "twice")
    write_hourly(to_spark(spark, pd.concat([frame, outside])), path, TILES)
    for limit in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            run_daily(spark, scan_hourly(spark, path), region, str(tmp_path / limit), ["temperature"], 2000, 2000, TILES)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        assert read_daily(spark, str(tmp_path / limit)).count() == staircase.sum()


def test_days_of_another_year_change_nothing(spark, region, source, tmp_path):
    root = str(tmp_path / "out")
    hourly = scan_hourly(spark, source)
    run_daily(spark, hourly, region, root, ["temperature"], 1999, 2000, TILES)
    before = snapshot(f"{root}/daily")
    # The partition claims to be 2000 and has a day of 1999.
    wrong = hourly.where("ts >= timestamp_ntz'1999-12-31'").withColumn("year", F.lit(2000))
    with pytest.raises(ValueError, match="1 of 2 days are outside 2000"):
        run_daily(spark, wrong, region, str(tmp_path / "fresh"), ["temperature"], 2000, 2000, TILES)
    with pytest.raises(ValueError, match="no hours for 1999"):
        run_daily(spark, wrong, region, root, ["humidex"], 1999, 2000, TILES)
    assert snapshot(f"{root}/daily") == before
    assert not list(Path(root).glob("staged*"))


def test_a_year_without_hours_is_not_finished(spark, source, region, tmp_path):
    root = str(tmp_path / "out")
    hourly = scan_hourly(spark, source)
    with pytest.raises(ValueError, match="no hours for 2000"):
        run_daily(spark, hourly.where("year = 1999"), region, root, ["temperature"], 1999, 2000, TILES)
    assert [tuple(r) for r in read_manifest(spark, root).collect()] == [("temperature", 1999)]
    assert [r.year for r in run_daily(spark, hourly, region, root, ["temperature"], 1999, 2000, TILES)] == [2000]


def test_a_store_has_one_coverage_rule(spark, source, region, tmp_path):
    root = str(tmp_path / "out")
    hourly = scan_hourly(spark, source)
    run_daily(spark, hourly, region, root, ["temperature"], 1999, 2000, TILES, 20)
    with pytest.raises(ValueError, match="does not match"):
        run_daily(spark, hourly, region, root, ["humidex"], 1999, 2000, TILES, 24)


def test_zones_of_session_and_driver_do_not_matter(spark, source, region, tmp_path, monkeypatch):
    """Days are UTC days for instants, whatever the session's zone, and a run leaves the session as it is."""
    hourly = scan_hourly(spark, source)
    frame = weather(days=2, start="2000-04-01")  # clocks change in between
    instants = to_spark(spark, frame).withColumn("ts", F.col("ts").cast("timestamp"))
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    monkeypatch.setenv("TZ", "America/Chicago")
    time.tzset()
    try:
        run_daily(spark, hourly, region, str(tmp_path / "out"), ["temperature"], 1999, 2000, TILES)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/Chicago"
    finally:
        monkeypatch.undo()
        time.tzset()
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    stored = read_daily(spark, str(tmp_path / "out"))
    assert {str(r.day) for r in stored.select("day").distinct().collect()} == {"1999-12-30", "1999-12-31", "2000-01-01"}
    assert stored.where("valid_hours < 24").isEmpty()
    written = str(tmp_path / "instants")
    instants.write.parquet(written)
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        daily = daily_metrics(spark.read.parquet(written), ["temperature"])
        assert daily.count() == 8 and daily.where("temperature_valid_hours < 24").isEmpty()
        facts = checks.hourly_coverage(spark.read.parquet(written)).first()
        assert facts.starts_at_midnight and facts.off_hour_rows == 0 and facts.hours == 48
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def generated_method_sizes(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(plan)
        return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_full_run_is_compiled_by_the_jvm(spark, source, region):
    hourly = scan_hourly(spark, source).drop("year", "latitude", "longitude")
    daily = daily_in_region(hourly, region, sorted(METRICS), TILES)
    sizes = generated_method_sizes(spark, daily)
    assert sizes and 0 < max(sizes) < 8000


# --- the region of a store, attempts, blocks ------------------------------------------------


def rows_of_region(spark, region, first, last):
    return region.withColumn("inside", F.col("lat_idx").between(first, last)).repartition(3)


def test_a_store_belongs_to_one_region(spark, source, region, tmp_path):
    """Another region on the same grid is refused, the same one in another order is not."""
    root = str(tmp_path / "out")
    hourly = scan_hourly(spark, source)
    north, south = rows_of_region(spark, region, 0, 4), rows_of_region(spark, region, 15, 19)
    run_daily(spark, hourly, north, root, ["temperature"], 1999, 2000, TILES)
    before = snapshot(root)
    with pytest.raises(ValueError, match="another region"):
        run_daily(spark, hourly, south, root, ["humidex"], 1999, 2000, TILES)
    moved = north.withColumn("latitude", F.col("latitude") + F.when(F.col("lat_idx") == 3, 1e-9).otherwise(0.0))
    with pytest.raises(ValueError, match="another grid"):
        run_daily(spark, hourly, moved, root, ["humidex"], 1999, 2000, TILES)
    assert {p: t for p, t in snapshot(root).items() if p in before and "region" not in str(p)} == {
        p: t for p, t in before.items() if "region" not in str(p)
    }
    assert {r.metric for r in read_daily(spark, root).select("metric").distinct().collect()} == {"temperature"}
    assert len(run_daily(spark, hourly, north.orderBy("lon_idx"), root, ["humidex"], 1999, 2000, TILES)) == 2


def test_a_broken_run_of_another_region_leaves_no_rows(spark, source, region, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    hourly = scan_hourly(spark, source)
    with monkeypatch.context() as patch:
        patch.setattr(daily_run, "record_completed", lambda *_: 1 / 0)
        patch.setattr(daily_run, "check_store", lambda *_: None)
        with pytest.raises(ZeroDivisionError):
            run_daily(spark, hourly, rows_of_region(spark, region, 0, 4), root, ["temperature"], 1999, 1999, TILES)
    assert read_daily(spark, root).count() == 0
    run_daily(spark, hourly, rows_of_region(spark, region, 15, 19), root, ["temperature"], 1999, 1999, TILES)
    assert {r.lat_idx for r in read_daily(spark, root).select("lat_idx").distinct().collect()} == set(range(15, 20))
    assert read_daily(spark, root).count() == 2 * 5 * SIZE


def test_a_lost_run_repeats_only_the_blocks_it_lacks(spark, source, region, tmp_path, monkeypatch):
    """Four blocks of one tile row; the run is lost in the third."""
    root, whole = str(tmp_path / "out"), str(tmp_path / "whole")
    hourly = scan_hourly(spark, source)
    record = daily_run.record_completed
    seen = []

    def third_is_lost(*args):
        if len(seen) == 2:
            raise RuntimeError("lost")
        seen.append(args[5])
        record(*args)

    with monkeypatch.context() as patch:
        patch.setattr(daily_run, "record_completed", third_is_lost)
        with pytest.raises(RuntimeError):
            run_daily(spark, hourly, region, root, ["humidex"], 1999, 1999, TILES, block_rows=1)
    assert seen == [0, 1] and read_manifest(spark, root).count() == 0
    before = {(r.block, r.attempt) for r in current_records(spark, root)}

    started = []
    compute = daily_run.daily_of_block
    monkeypatch.setattr(daily_run, "daily_of_block", lambda run, *rest: started.append(rest[-1]) or compute(run, *rest))
    reports = run_daily(spark, hourly, region, root, ["humidex"], 1999, 1999, TILES, block_rows=1)
    assert started == [2, 3]
    assert before <= {(r.block, r.attempt) for r in current_records(spark, root)}
    expected = run_daily(spark, hourly, region, whole, ["humidex"], 1999, 1999, TILES)
    assert reports == expected
    assert read_daily(spark, root).exceptAll(read_daily(spark, whole)).isEmpty()
    assert read_daily(spark, root).count() == read_daily(spark, whole).count()
    assert [tuple(r) for r in read_manifest(spark, root).collect()] == [("humidex", 1999)]


def test_a_block_without_hours_is_done_if_the_year_has_some(spark, source, region, tmp_path):
    hourly = scan_hourly(spark, source).where("lat_idx < 10")
    root = str(tmp_path / "out")
    report = run_daily(spark, hourly, region, root, ["temperature"], 1999, 1999, TILES, block_rows=1)[0]
    inside = region.where("inside").count()
    stored = read_daily(spark, root).count()
    assert report.fully_missing_cell_days == inside * 365 - stored
    with pytest.raises(ValueError, match="no hours for 2000"):
        run_daily(spark, hourly.where("year = 1999"), region, str(tmp_path / "o"), ["temperature"], 2000, 2000, TILES, block_rows=1)


def jobs_of(spark, group, action):
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        action()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(group))


def test_a_year_takes_few_jobs_and_no_window(spark, source, region, tmp_path, monkeypatch):
    """Jobs of parallel years keep the caller's group; the plan of a year has no window over the cells."""
    hourly = scan_hourly(spark, source)
    plans = []
    compute = daily_run.daily_of_block

    def kept(*args):
        daily = compute(*args)
        plans.append(daily._jdf.queryExecution().optimizedPlan().toString())
        return daily

    monkeypatch.setattr(daily_run, "daily_of_block", kept)
    one, both = str(tmp_path / "one"), str(tmp_path / "both")
    for root, first in ((one, 2000), (both, 1999)):  # once, for the index and the set-up
        run_daily(spark, hourly, region, root, ["humidex"], first, 2000, TILES)
    short = jobs_of(spark, "short", lambda: run_daily(spark, hourly, region, one, ["temperature"], 2000, 2000, TILES))
    long = jobs_of(spark, "long", lambda: run_daily(spark, hourly, region, both, ["temperature"], 1999, 2000, TILES))
    assert 0 < long - short <= 12
    assert plans and not any("Window" in plan for plan in plans)

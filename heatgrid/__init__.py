"""Daily heat-stress statistics over gridded hourly weather, as Spark jobs."""

from heatgrid.functions.metrics import METRICS, MetricSpec, derive_hourly, required_variables
from heatgrid.operators.covering import cover_polygons, points_in_polygons
from heatgrid.operators.daily import daily_metrics, reduce_daily, to_long, to_wide
from heatgrid.operators.reducers import HOUR_OF_MAX, Reducer, longest_run_above
from heatgrid.plans.daily_run import YearReport, daily_in_region, run_daily
from heatgrid.session import build_session
from heatgrid.sources.boundary import build_region, read_polygons
from heatgrid.sources.daily_store import gap_report, publish_daily, read_daily
from heatgrid.sources.hourly import clean, scan_hourly, write_hourly
from heatgrid.sources.late_hours import deliver_hours

__all__ = [
    "HOUR_OF_MAX",
    "METRICS",
    "MetricSpec",
    "Reducer",
    "YearReport",
    "build_region",
    "build_session",
    "clean",
    "cover_polygons",
    "daily_in_region",
    "daily_metrics",
    "deliver_hours",
    "derive_hourly",
    "gap_report",
    "longest_run_above",
    "points_in_polygons",
    "publish_daily",
    "read_daily",
    "read_polygons",
    "reduce_daily",
    "required_variables",
    "run_daily",
    "scan_hourly",
    "to_long",
    "to_wide",
    "write_hourly",
]

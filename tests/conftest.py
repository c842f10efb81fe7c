"""Session and small hourly tables for the tests."""

import datetime as dt
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from heatgrid.schema import VARIABLES  # noqa: E402
from heatgrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="10000",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def weather(days=2, rows=2, cols=2, start="2000-07-01", seed=7, drop=()) -> pd.DataFrame:
    """Complete random hours for a rows x cols grid; ``drop`` names variables to leave out."""
    rng = np.random.default_rng(seed)
    hours = pd.date_range(start, periods=24 * days, freq="h")
    lat, lon, ts = (
        axis.ravel() for axis in np.meshgrid(np.arange(rows), np.arange(cols), hours, indexing="ij")
    )
    n = len(ts)
    frame = pd.DataFrame(
        {
            "lat_idx": lat.astype("int32"),
            "lon_idx": lon.astype("int32"),
            "latitude": 30.0 + 0.5 * lat,
            "longitude": -100.0 + 0.5 * lon,
            "ts": ts,
            "tmp_k": rng.uniform(293, 316, n),
            "spfh": rng.uniform(0.004, 0.019, n),
            "pres_pa": rng.uniform(97000, 102000, n),
            "u10": rng.uniform(-9, 9, n),
            "v10": rng.uniform(-9, 9, n),
        }
    )
    frame["year"] = frame.ts.dt.year.astype("int32")
    return frame.drop(columns=list(drop))


def to_spark(spark, frame: pd.DataFrame):
    """A DataFrame with NULL, not NaN, for the gaps."""
    from heatgrid.sources.hourly import clean

    return clean(spark.createDataFrame(frame))


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def grid_frame(rows: int, cols: int, inside=None) -> pd.DataFrame:
    lat, lon = (axis.ravel() for axis in np.meshgrid(np.arange(rows), np.arange(cols), indexing="ij"))
    frame = pd.DataFrame(
        {
            "lat_idx": lat.astype("int32"),
            "lon_idx": lon.astype("int32"),
            "latitude": 30.0 + 0.5 * lat,
            "longitude": -100.0 + 0.5 * lon,
        }
    )
    if inside is not None:
        frame["inside"] = np.asarray(inside, dtype=bool).ravel()
    return frame


__all__ = ["VARIABLES", "day", "grid_frame", "to_spark", "weather"]

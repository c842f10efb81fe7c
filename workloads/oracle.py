"""SQL building blocks of the oracle: the formulas as published, in plain SQL."""

WET_BULB_PASSES = 8

DERIVED = """
d1 AS (SELECT *, tmp_k - 273.15e0 AS tc, pres_pa / 100.0e0 AS p_hpa,
              sqrt(u10 * u10 + v10 * v10) AS wind_ms FROM {source}),
d2 AS (SELECT *, spfh * p_hpa / (0.622e0 + 0.378e0 * spfh) AS vp_hpa,
              6.1078e0 * exp(17.27e0 * tc / (tc + 237.3e0)) AS es_hpa FROM d1),
d3 AS (SELECT *, tc * 1.8e0 + 32.0e0 AS tf,
              es_hpa * 17.27e0 * 237.3e0 / ((tc + 237.3e0) * (tc + 237.3e0)) AS es_slope,
              CASE WHEN tc IS NOT NULL AND spfh IS NOT NULL AND pres_pa IS NOT NULL
                   THEN greatest(0.0e0, least(100.0e0, vp_hpa / es_hpa * 100.0e0)) END AS rh_pct
       FROM d2)"""

HEAT_INDEX = """
CASE WHEN (0.5e0 * (tf + 61.0e0 + (tf - 68.0e0) * 1.2e0 + rh_pct * 0.094e0) + tf) * 0.5e0 >= 80.0e0
THEN -42.379e0 + 2.04901523e0 * tf + 10.14333127e0 * rh_pct - 0.22475541e0 * tf * rh_pct
     - 0.00683783e0 * tf * tf - 0.05481717e0 * rh_pct * rh_pct + 0.00122874e0 * tf * tf * rh_pct
     + 0.00085282e0 * tf * rh_pct * rh_pct - 0.00000199e0 * tf * tf * rh_pct * rh_pct
     + CASE WHEN rh_pct < 13.0e0 AND tf BETWEEN 80.0e0 AND 112.0e0
            THEN -((13.0e0 - rh_pct) / 4.0e0) * sqrt(abs((17.0e0 - abs(tf - 95.0e0)) / 17.0e0))
            WHEN rh_pct > 85.0e0 AND tf BETWEEN 80.0e0 AND 87.0e0
            THEN ((rh_pct - 85.0e0) / 10.0e0) * ((87.0e0 - tf) / 5.0e0)
            ELSE 0.0e0 END
ELSE 0.5e0 * (tf + 61.0e0 + (tf - 68.0e0) * 1.2e0 + rh_pct * 0.094e0) END"""

METRIC_SQL = {
    "apparent_temperature": "(tc + 0.33e0 * vp_hpa - 0.7e0 * wind_ms - 4.0e0) * 1.8e0 + 32.0e0",
    "heat_index": HEAT_INDEX,
    "humidex": "(tc + 5.0e0 / 9.0e0 * (vp_hpa - 10.0e0)) * 1.8e0 + 32.0e0",
    "relative_humidity": "rh_pct",
    "simplified_wbgt": "(0.567e0 * tc + 0.393e0 * vp_hpa + 3.94e0) * 1.8e0 + 32.0e0",
    "specific_humidity": "spfh",
    "temperature": "tf",
    "wet_bulb_temperature": f"w{WET_BULB_PASSES} * 1.8e0 + 32.0e0",
}

_WET_BULB_PARTS = """
p{i} AS (SELECT *, 6.1078e0 * exp(17.27e0 * w{i} / (w{i} + 237.3e0)) AS es{i},
                2.501e6 - 2370.0e0 * w{i} AS lat{i}, 1005.7e0 + 869.3e0 * spfh AS cp{i}
         FROM {source}),
s{i} AS (SELECT *,
         (0.622e0 * es{i} / (p_hpa - 0.378e0 * es{i}) - spfh - cp{i} / lat{i} * (tc - w{i}))
         / (0.622e0 * p_hpa * (es{i} * 17.27e0 * 237.3e0 / ((w{i} + 237.3e0) * (w{i} + 237.3e0)))
              / ((p_hpa - 0.378e0 * es{i}) * (p_hpa - 0.378e0 * es{i}))
            + cp{i} / lat{i} - (tc - w{i}) * cp{i} * 2370.0e0 / (lat{i} * lat{i})) AS step{i}
         FROM p{i}),
b{j} AS (SELECT *, CASE WHEN step{i} IS NOT NULL
                        THEN greatest(least(w{i} - step{i}, tc), tc - 40.0e0) END AS w{j}
         FROM s{i})"""


def _wet_bulb_ctes() -> str:
    parts = ["b0 AS (SELECT *, tc AS w0 FROM d3)"]
    parts += [
        _WET_BULB_PARTS.format(i=i, j=i + 1, source=f"b{i}") for i in range(WET_BULB_PASSES)
    ]
    return ",".join(parts)


def digits(metric: str) -> int:
    return 9 if metric == "specific_humidity" else 6


def daily_ctes(source: str, metrics: list[str], min_valid_hours: int = 24) -> list[str]:
    """CTEs ending in ``daily``: unrounded statistics per cell and day."""
    ctes, last = [DERIVED.format(source=source)], "d3"
    if "wet_bulb_temperature" in metrics:
        ctes.append(_wet_bulb_ctes())
        last = f"b{WET_BULB_PASSES}"
    values = ", ".join(f"{METRIC_SQL[name]} AS {name}" for name in metrics)
    ctes.append(
        f"metrics AS (SELECT lat_idx, lon_idx, CAST(ts AS DATE) AS day, {values} FROM {last})"
    )
    statistics = ", ".join(
        f"CASE WHEN count({name}) >= {min_valid_hours} THEN {function}({name}) END AS {name}_{label}"
        for name in metrics
        for function, label in (("min", "min"), ("avg", "mean"), ("max", "max"))
    )
    counts = ", ".join(f"CAST(count({name}) AS INT) AS {name}_valid_hours" for name in metrics)
    ctes.append(
        f"daily AS (SELECT lat_idx, lon_idx, day, {statistics}, {counts} FROM metrics "
        "GROUP BY lat_idx, lon_idx, day)"
    )
    return ctes


def rounded_daily(metrics: list[str], table: str = "daily") -> str:
    columns = [
        f"round({name}_{label}, {digits(name)}) AS {name}_{label}"
        for name in metrics
        for label in ("min", "mean", "max")
    ]
    columns += [f"{name}_valid_hours" for name in metrics]
    return f"SELECT lat_idx, lon_idx, day, {', '.join(columns)} FROM {table}"

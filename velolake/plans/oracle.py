"""Independent SQL formulations of the registered queries (DuckDB dialect).

They are written from the operator definitions, not from the Spark code:
the same binding of the driver tables, expressed with plain SQL
(window functions, ``FILTER``, ``generate_series``, a self-join for the
correlation).  Averages and moments use exact integer sums and a single
division, like the Spark side, so results compare bit for bit.
"""

from __future__ import annotations

from velolake import schemas as S

SID = "(CASE WHEN event_type = 'error' THEN 'BIKE ' ELSE 'STATION ' END || CAST(user_id AS VARCHAR))"
NBIKES = "CAST(CAST(floor(value) AS BIGINT) % 25 AS INTEGER)"
LONG = "(CAST(11970 + user_id % 100 AS DOUBLE) / 1000)"
LAT = "(CAST(57700 + user_id % 50 AS DOUBLE) / 1000)"
DIST = "CAST(user_id * 10 AS DOUBLE)"
NAME = (
    "(CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' "
    "ELSE 'Stop ' || CAST(user_id AS VARCHAR) END)"
)


def iso(ts: str) -> str:
    return (
        f"(CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') END)"
    )


READINGS = f"""readings AS (
  SELECT event_id AS readingId, {SID} AS stationId, ts AS timestamp,
         {NBIKES} AS AvailableBikes, event_type <> 'signup' AS IsOpen,
         {LONG} AS Long, {LAT} AS Lat, {DIST} AS Distance
  FROM events)"""

WEATHER = """weather AS (
  SELECT date_trunc('hour', ts) AS Time,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) // (count(*) * 100) AS DOUBLE) AS Temperature,
         CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) // count(*) AS DOUBLE) AS Humidity,
         max(value) AS Wind_Speed,
         min(value) AS Precipitation,
         CASE WHEN count(*) = 1 THEN NULL ELSE CAST(count(*) * 1000 AS DOUBLE) END AS Visibility,
         CAST(count(*) AS DOUBLE) AS Snowfall
  FROM events WHERE event_type = 'view'
  GROUP BY date_trunc('hour', ts))"""

MEASURES = ", ".join(S.WEATHER_MEASURES)


def _cal(ts: str) -> str:
    return (
        f"CAST(year({ts}) AS INTEGER) AS Year, CAST(month({ts}) AS INTEGER) AS Month, "
        f"CAST(dayofmonth({ts}) AS INTEGER) AS Day, CAST(hour({ts}) AS INTEGER) AS Hour"
    )


JOINED = f"""cal AS (
  SELECT *, {_cal('timestamp')}, CAST(minute(timestamp) AS INTEGER) AS Minute FROM readings),
wx AS (SELECT {_cal('Time')}, {MEASURES} FROM weather),
joined_left AS (
  SELECT c.readingId, c.stationId, c.timestamp, c.AvailableBikes, c.IsOpen, c.Long, c.Lat,
         c.Distance, c.Year, c.Month, c.Day, c.Hour, c.Minute,
         w.Temperature, w.Humidity, w.Wind_Speed, w.Precipitation, w.Visibility, w.Snowfall,
         c.AvailableBikes AS TotalAvailableBikes,
         CAST(CASE WHEN isodow(c.timestamp) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend,
         CASE WHEN starts_with(c.stationId, 'BIKE') THEN 'single_bikes' ELSE 'station_bikes' END AS kind
  FROM cal c LEFT JOIN wx w
    ON c.Year = w.Year AND c.Month = w.Month AND c.Day = w.Day AND c.Hour = w.Hour),
features AS (
  SELECT * FROM joined_left
  WHERE {' AND '.join(f'{m} IS NOT NULL' for m in S.WEATHER_MEASURES)})"""

BASE = f"WITH {READINGS},\n{WEATHER},\n{JOINED}\n"

SPLIT = """split AS (
  SELECT *, CAST(('0x' || substr(md5(CAST(readingId AS VARCHAR)), 1, 8)) AS BIGINT) % 1000 AS bucket
  FROM features),
train AS (SELECT * FROM split WHERE bucket >= 200),
test AS (SELECT * FROM split WHERE bucket < 200),
baseline AS (
  SELECT Hour, CAST(sum(TotalAvailableBikes) // count(*) AS INTEGER) AS prediction
  FROM train GROUP BY Hour),
scored AS (
  SELECT t.readingId, t.TotalAvailableBikes, b.prediction
  FROM test t JOIN baseline b ON t.Hour = b.Hour)"""

SLOT = "(date_trunc('hour', timestamp) + to_minutes(CAST(minute(timestamp) // 10 * 10 AS BIGINT)))"


def exact_double(expr: str) -> str:
    """A huge integer converted to the nearest double."""
    return f"CAST(CAST({expr} AS VARCHAR) AS DOUBLE)"


def correlation_sql() -> str:
    cols = S.CORRELATION_COLUMNS
    unpivot = "\n  UNION ALL ".join(
        f"SELECT readingId, kind, '{c}' AS col, CAST({c} AS DOUBLE) AS v "
        f"FROM features WHERE {c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))"
        for c in cols
    )
    return (
        BASE
        + f""", cells AS (
  {unpivot})
SELECT a.kind, a.col AS colA, b.col AS colB,
       CASE WHEN count(*) >= 2 AND min(a.v) < max(a.v) AND min(b.v) < max(b.v)
            THEN CASE WHEN a.col = b.col THEN 1.0::DOUBLE ELSE round(corr(a.v, b.v), 6) + 0.0::DOUBLE END END AS corr
FROM cells a JOIN cells b ON a.readingId = b.readingId
GROUP BY a.kind, a.col, b.col"""
    )


def haversine_sql(lat: str, lon: str, lat0: float, lon0: float) -> str:
    return (
        f"(2 * 6371008.8 * asin(sqrt(pow(sin((radians({lat}) - radians({lat0})) / 2), 2) + "
        f"cos(radians({lat})) * cos(radians({lat0})) * pow(sin((radians({lon}) - radians({lon0})) / 2), 2))))"
    )

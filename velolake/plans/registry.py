"""Registered queries: one per operator of the inventory, each with an
independent SQL formulation for the DuckDB oracle where one exists.

Every query reads the driver tables under ``sf_dir`` (through
:mod:`velolake.plans.binding`) and runs over all of their rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import columns as C
from velolake.ml import forest as ML
from velolake.operators import correlation as CORR
from velolake.operators import dedupe as DD
from velolake.operators import features as FE
from velolake.operators import joins as J
from velolake.operators import metrics as M
from velolake.operators import sampling as SA
from velolake.plans import binding as B
from velolake.plans import extended as X
from velolake.plans import oracle as O
from velolake.plans import stages as STG
from velolake.session import scratch_path
from velolake.sinks import documents as DOC
from velolake.sources import csv as CSV
from velolake.sources import snapshots as SN
from velolake.sources import store as ST
from velolake.sources import tables as TB
from velolake.sources import weather as WX
from velolake.streaming import ingest as ING

Query = Callable[[SparkSession, str], DataFrame]

D = B.REPORT_DAY
GEO_RADIUS_M = 2500.0
SAMPLE_N = 1000
TEST_SHARE = 0.2


def _ts(d: dt.date) -> str:
    return f"TIMESTAMP '{d.isoformat()} 00:00:00'"


def _days(n: int) -> dt.date:
    return D + dt.timedelta(days=n)


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------
def snapshot_flatten(spark, sf):
    snaps = TB.snapshot_text_from_events(B.events(spark, sf))
    st = SN.flatten_snapshot_text(snaps, keep=["pollId", "polledAt"])
    return st.select(
        "pollId", "polledAt", C.station_key().alias("stationId"),
        F.col("StationId").alias("sourceStationId"), "Name",
        "Lat", "Long", "IsOpen", "AvailableBikes", "Distance",
        F.size("BikeIds").alias("bikeIdCount"),
    )


SQL_SNAPSHOT_FLATTEN = f"""
SELECT event_id AS pollId, ts AS polledAt,
       COALESCE(NULLIF({O.NAME}, ''), {O.SID}) AS stationId, {O.SID} AS sourceStationId, {O.NAME} AS Name,
       {O.LAT} AS Lat, {O.LONG} AS Long, event_type <> 'signup' AS IsOpen,
       {O.NBIKES} AS AvailableBikes, {O.DIST} AS Distance, {O.NBIKES} AS bikeIdCount
FROM events"""


def two_week_scan(spark, sf):
    return ST.two_week_scan(B.readings(spark, sf), D).select(
        "readingId", "stationId", "timestamp", "AvailableBikes"
    )


SQL_TWO_WEEK_SCAN = O.BASE + f"""
SELECT readingId, stationId, timestamp, AvailableBikes FROM readings
WHERE timestamp >= {_ts(_days(-14))} AND timestamp < {_ts(_days(1))}"""


def two_week_scan_alt(spark, sf):
    return ST.two_week_scan_alt(B.readings(spark, sf), D).select(
        "readingId", "stationId", "timestamp", "AvailableBikes"
    )


SQL_TWO_WEEK_SCAN_ALT = O.BASE + f"""
SELECT readingId, stationId, timestamp, AvailableBikes FROM readings
WHERE timestamp >= {_ts(_days(-15))} AND timestamp < {_ts(_days(-1))}"""


def csv_round_trip(spark, sf):
    path = scratch_path(spark, "csv_round_trip")
    CSV.write_csv(B.readings(spark, sf), path)
    back = CSV.read_csv(spark, path, schema=S.READING_SCHEMA)
    return FE.with_bike_count(back).drop("BikeIds")


SQL_CSV_ROUND_TRIP = O.BASE + """
SELECT readingId, stationId, timestamp, AvailableBikes, IsOpen, Long, Lat, Distance,
       AvailableBikes AS TotalAvailableBikes
FROM readings"""


def weather_explode(spark, sf):
    responses = WX.to_daily_responses(B.weather(spark, sf))
    return WX.rename_weather(WX.explode_hourly(responses))


SQL_WEATHER_EXPLODE = O.BASE + f"SELECT Time AS timestamp, {O.MEASURES} FROM weather"


def weather_range_scan(spark, sf):
    # the range also stands on the events' own time, where the scan takes it
    events = WX.weather_window_for_day(B.events(spark, sf), D, ts="ts")
    return WX.weather_window_for_day(TB.weather_from_events(events), D)


SQL_WEATHER_RANGE_SCAN = O.BASE + f"""
SELECT Time, {O.MEASURES} FROM weather
WHERE Time >= {_ts(_days(-14))} AND Time < {_ts(_days(1))}"""


def weather_for_readings(spark, sf):
    return WX.weather_window_of_readings(B.weather(spark, sf), B.readings(spark, sf))


SQL_WEATHER_FOR_READINGS = O.BASE + f"""
SELECT Time, {O.MEASURES} FROM weather
WHERE Time >= (SELECT CAST(CAST(min(timestamp) AS DATE) AS TIMESTAMP) FROM readings)
  AND Time < (SELECT CAST(CAST(max(timestamp) AS DATE) + INTERVAL 1 DAY AS TIMESTAMP) FROM readings)"""


def geo_radius(spark, sf):
    near = ST.within_radius(B.readings(spark, sf), radius_m=GEO_RADIUS_M, distance_col=None)
    return near.select("readingId", "stationId")


SQL_GEO_RADIUS = O.BASE + f"""
SELECT readingId, stationId FROM readings
WHERE {O.haversine_sql('Lat', 'Long', S.STATION_CENTER_LAT, S.STATION_CENTER_LON)} <= {GEO_RADIUS_M}"""


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------
def upsert_latest(spark, sf):
    r = B.readings(spark, sf).select(
        "stationId", C.hour_floor("timestamp").alias("pollHour"), "readingId", "timestamp", "AvailableBikes"
    )
    # the event id is the ingest sequence: unique, so the hash-aggregate form
    return DD.latest_per_key(r, ["stationId", "pollHour"], "readingId", unique_seq=True)


SQL_UPSERT_LATEST = O.BASE + """
SELECT stationId, date_trunc('hour', timestamp) AS pollHour, readingId, timestamp, AvailableBikes
FROM readings
QUALIFY row_number() OVER (PARTITION BY stationId, date_trunc('hour', timestamp) ORDER BY readingId DESC) = 1"""


def column_subset(spark, sf):
    return CSV.select_columns(B.readings(spark, sf), ["stationId", "timestamp", "AvailableBikes"])


SQL_COLUMN_SUBSET = O.BASE + "SELECT stationId, timestamp, AvailableBikes FROM readings"


# ---------------------------------------------------------------------------
# Projections
# ---------------------------------------------------------------------------
def stringify(spark, sf):
    return SN.stringify(B.readings(spark, sf).drop("BikeIds"))


SQL_STRINGIFY = O.BASE + f"""
SELECT CAST(readingId AS VARCHAR) AS readingId, stationId, {O.iso('timestamp')} AS timestamp,
       CAST(AvailableBikes AS VARCHAR) AS AvailableBikes,
       CASE WHEN IsOpen THEN 'True' ELSE 'False' END AS IsOpen,
       CAST(Long AS VARCHAR) AS Long, CAST(Lat AS VARCHAR) AS Lat, CAST(Distance AS VARCHAR) AS Distance
FROM readings"""


def station_key(spark, sf):
    ev = B.events(spark, sf)
    items = ev.select(
        F.col("event_id").alias("readingId"),
        TB.station_name_expr().alias("Name"),
        TB.station_id_expr().alias("StationId"),
    )
    return items.select("readingId", "Name", C.station_key().alias("stationId"))


SQL_STATION_KEY = f"""
SELECT event_id AS readingId, {O.NAME} AS Name,
       CASE WHEN {O.NAME} IS NULL OR {O.NAME} = '' THEN {O.SID} ELSE {O.NAME} END AS stationId
FROM events"""


def weather_rename(spark, sf):
    return WX.rename_weather(B.source_named_weather(B.weather(spark, sf)))


SQL_WEATHER_RENAME = SQL_WEATHER_EXPLODE


def ts_coerce(spark, sf):
    return FE.with_timestamp(B.timestamp_text(B.events(spark, sf))).select("readingId", "timestamp")


SQL_TS_COERCE = f"""
SELECT event_id AS readingId,
       TRY_CAST(CASE event_id % 10 WHEN 0 THEN 'garbage' WHEN 1 THEN ''
                 WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
                 WHEN 3 THEN strftime(ts, '%Y-%m-%d')
                 ELSE {O.iso('ts')} END AS TIMESTAMP) AS timestamp
FROM events"""


def calendar_features(spark, sf):
    cal = FE.with_calendar(B.readings(spark, sf), time_of_day=True)
    return cal.select("readingId", "Year", "Month", "Day", "Hour", "Minute", "Time_of_Day")


SQL_CALENDAR_FEATURES = O.BASE + """
SELECT readingId, Year, Month, Day, Hour, Minute, strftime(timestamp, '%H:%M:%S') AS Time_of_Day FROM cal"""


def weekend_flag(spark, sf):
    return FE.with_weekend(B.readings(spark, sf)).select("readingId", "IsWeekend")


SQL_WEEKEND_FLAG = O.BASE + """
SELECT readingId, CAST(CASE WHEN dayname(timestamp) IN ('Saturday', 'Sunday') THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend
FROM readings"""


def bike_count(spark, sf):
    return FE.with_bike_count(B.readings(spark, sf)).select("readingId", "BikeIds", S.LABEL)


SQL_BIKE_COUNT = O.BASE + """
SELECT readingId,
       CASE WHEN AvailableBikes <= 0 THEN '[]'
            ELSE '[' || array_to_string(list_transform(range(1, AvailableBikes + 1),
                   lambda x: CASE readingId % 4
                          WHEN 0 THEN '''' || x || ''''
                          WHEN 1 THEN '"' || x || '"'
                          WHEN 2 THEN CASE WHEN x = AvailableBikes THEN 'None' ELSE '''' || x || '''' END
                          ELSE CAST(x AS VARCHAR) END), ', ') || ']' END AS BikeIds,
       AvailableBikes AS TotalAvailableBikes
FROM readings"""

FEATURE_OUT = [c for c in S.FEATURE_COLUMNS if c != "BikeIds"]


def weather_join(spark, sf):
    return B.features(spark, sf).select(*FEATURE_OUT, "kind")


SQL_WEATHER_JOIN = O.BASE + f"SELECT {', '.join(FEATURE_OUT)}, kind FROM features"


def weather_left_join(spark, sf):
    return B.features_left(spark, sf).select(*FEATURE_OUT, "kind")


SQL_WEATHER_LEFT_JOIN = O.BASE + f"SELECT {', '.join(FEATURE_OUT)}, kind FROM joined_left"


def feature_select(spark, sf):
    """P10 + P11: the model columns in model order with the row key and the
    label - one projection (the keyed split into parts is ``write_splits``;
    joining the parts back here would be a full-size join)."""
    return FE.select_features(B.features(spark, sf), keep=["readingId", S.LABEL])


SQL_FEATURE_SELECT = O.BASE + f"SELECT readingId, {', '.join(S.MODEL_FEATURES)}, {S.LABEL} FROM features"


def visibility_impute(spark, sf):
    return FE.impute_visibility(B.weather(spark, sf)).select("Time", "Visibility")


SQL_VISIBILITY_IMPUTE = O.BASE + f"SELECT Time, COALESCE(Visibility, {S.VISIBILITY_FILL}) AS Visibility FROM weather"


def current_weather(spark, sf):
    return WX.current_weather(WX.to_daily_responses(B.weather(spark, sf)), keep=["day"])


SQL_CURRENT_WEATHER = O.BASE + f"""
SELECT CAST(Time AS DATE) AS day, {O.MEASURES} FROM weather
QUALIFY row_number() OVER (PARTITION BY CAST(Time AS DATE) ORDER BY Time) = 1"""


def stockholm_time(spark, sf):
    return B.readings(spark, sf).select("readingId", C.local_wall_clock("timestamp").alias("localTime"))


SQL_STOCKHOLM_TIME = O.BASE + f"""
SELECT readingId, (timestamp AT TIME ZONE 'UTC') AT TIME ZONE '{S.LOCAL_TZ}' AS localTime FROM readings"""


def trailing_14d(spark, sf):
    days = B.readings(spark, sf).select(F.to_date("timestamp").alias("day")).distinct()
    return days.select(
        "day",
        C.trailing_range_start("day").alias("startDay"),
        C.trailing_range_text("day").alias("rangeText"),
    )


SQL_TRAILING_14D = O.BASE + f"""
SELECT day, CAST(day - INTERVAL {S.WINDOW_DAYS - 1} DAY AS DATE) AS startDay,
       strftime(day, '%Y-%m-%d') || '-' || strftime(CAST(day - INTERVAL {S.WINDOW_DAYS - 1} DAY AS DATE), '%Y-%m-%d') AS rangeText
FROM (SELECT DISTINCT CAST(timestamp AS DATE) AS day FROM readings)"""


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------
def single_bikes(spark, sf):
    return FE.single_bikes(B.features(spark, sf)).select("readingId", "stationId")


SQL_SINGLE_BIKES = O.BASE + "SELECT readingId, stationId FROM features WHERE stationId LIKE 'BIKE%'"


def stationary(spark, sf):
    return FE.stationary(B.features(spark, sf)).select("readingId", "stationId")


SQL_STATIONARY = O.BASE + "SELECT readingId, stationId FROM features WHERE stationId NOT LIKE 'BIKE%'"


def dropna_any(spark, sf):
    return FE.drop_incomplete(B.features_left(spark, sf)).select("readingId", "stationId")


SQL_DROPNA_ANY = O.BASE + f"""
SELECT readingId, stationId FROM joined_left
WHERE {' AND '.join(f'{m} IS NOT NULL' for m in S.WEATHER_MEASURES)}"""


def date_range(spark, sf):
    rows = FE.with_kind(FE.with_timestamp(B.timestamp_text(B.events(spark, sf))))
    return M.date_range(rows)


SQL_DATE_RANGE = f"""
WITH t AS (
  SELECT CASE WHEN starts_with({O.SID}, 'BIKE') THEN 'single_bikes' ELSE 'station_bikes' END AS kind,
         TRY_CAST(CASE event_id % 10 WHEN 0 THEN 'garbage' WHEN 1 THEN ''
                   WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
                   WHEN 3 THEN strftime(ts, '%Y-%m-%d')
                   ELSE {O.iso('ts')} END AS TIMESTAMP) AS timestamp
  FROM events)
SELECT kind, strftime(min(timestamp), '%Y-%m-%d') AS minDate, strftime(max(timestamp), '%Y-%m-%d') AS maxDate,
       strftime(min(timestamp), '%Y-%m-%d') || '-' || strftime(max(timestamp), '%Y-%m-%d') AS rangeName
FROM t WHERE timestamp IS NOT NULL GROUP BY kind"""


# ---------------------------------------------------------------------------
# Aggregates
# ---------------------------------------------------------------------------
def distinct_stations(spark, sf):
    return M.distinct_stations(B.features(spark, sf))


SQL_DISTINCT_STATIONS = O.BASE + "SELECT kind, count(DISTINCT stationId) AS numStations FROM features GROUP BY kind"


def temperature_extremes(spark, sf):
    return M.temperature_extremes(B.features(spark, sf))


SQL_TEMPERATURE_EXTREMES = O.BASE + """
SELECT kind, max(Temperature) AS warmestTemperature, min(Temperature) AS coldestTemperature
FROM features GROUP BY kind"""


def extreme_days(spark, sf):
    return M.extreme_days(B.features(spark, sf))


SQL_EXTREME_DAYS = O.BASE + """,
x AS (SELECT *, max(Temperature) OVER (PARTITION BY kind) AS hi, min(Temperature) OVER (PARTITION BY kind) AS lo
      FROM features)
SELECT kind, min(timestamp) FILTER (WHERE Temperature = hi) AS warmestDay,
       min(timestamp) FILTER (WHERE Temperature = lo) AS coldestDay
FROM x GROUP BY kind"""


def busiest_timestamp(spark, sf):
    return M.busiest_timestamp(B.features(spark, sf))


SQL_BUSIEST_TIMESTAMP = O.BASE + f""",
c AS (SELECT kind, {O.SLOT} AS busiestTime, count(*) AS readings FROM features GROUP BY ALL)
SELECT kind, busiestTime, readings FROM c
QUALIFY row_number() OVER (PARTITION BY kind ORDER BY readings DESC, busiestTime) = 1"""


def busiest_day(spark, sf):
    return M.busiest_day(B.features(spark, sf))


SQL_BUSIEST_DAY = O.BASE + """,
c AS (SELECT kind, CAST(timestamp AS DATE) AS busiestDay, count(*) AS readings FROM features GROUP BY ALL)
SELECT kind, busiestDay, readings FROM c
QUALIFY row_number() OVER (PARTITION BY kind ORDER BY readings DESC, busiestDay) = 1"""


def correlation_matrix(spark, sf):
    # equal to six digits: sums of doubles depend on the order of rows
    return CORR.correlation_long(B.features(spark, sf)).withColumn("corr", F.round("corr", 6))


SQL_CORRELATION_MATRIX = O.correlation_sql()


def weekend_vs_weekday(spark, sf):
    return M.weekend_vs_weekday(B.features(spark, sf))


SQL_WEEKEND_VS_WEEKDAY = O.BASE + """
SELECT kind, CASE IsWeekend WHEN 0 THEN 'Weekdays' WHEN 1 THEN 'Weekend' END AS dayType,
       CAST(sum(AvailableBikes) AS DOUBLE) / count(AvailableBikes) AS meanAvailableBikes
FROM features GROUP BY kind, IsWeekend"""


def hourly_resample(spark, sf):
    hours = M.hourly_resample(B.features(spark, sf))
    # averages of doubles depend on the order of rows in the last digits
    return hours.select("kind", "hour", *[F.round(m, 6).alias(m) for m in M.HOURLY_MEANS], S.LABEL)


SQL_HOURLY_RESAMPLE = O.BASE + f""",
agg AS (
  SELECT kind, date_trunc('hour', timestamp) AS hour,
         round(avg(Humidity), 6) AS Humidity,
         round(avg(Wind_Speed), 6) AS Wind_Speed,
         round(avg(Temperature), 6) AS Temperature,
         sum(TotalAvailableBikes) AS TotalAvailableBikes
  FROM features GROUP BY ALL),
grid AS (
  SELECT kind, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM agg GROUP BY kind)
SELECT g.kind, g.hour, a.Humidity, a.Wind_Speed, a.Temperature,
       CAST(COALESCE(a.TotalAvailableBikes, 0) AS BIGINT) AS TotalAvailableBikes
FROM grid g LEFT JOIN agg a ON g.kind = a.kind AND g.hour = a.hour"""


def station_profile(spark, sf):
    return M.station_profile(B.features(spark, sf))


SQL_STATION_PROFILE = O.BASE + f"""
SELECT stationId, min({S.LABEL}) AS minBikes, max({S.LABEL}) AS maxBikes,
       CAST(sum({S.LABEL}) AS DOUBLE) / count({S.LABEL}) AS meanBikes,
       count(DISTINCT (Lat, Long)) AS positions,
       min(Lat) AS minLat, max(Lat) AS maxLat, min(Long) AS minLong, max(Long) AS maxLong
FROM features GROUP BY stationId"""


def metrics_pack(spark, sf):
    return M.metrics_pack(B.features(spark, sf))


SQL_METRICS_PACK = O.BASE + f""",
s AS (SELECT kind, count(*) AS rows, count(DISTINCT stationId) AS numStations,
             max(Temperature) AS warmestTemperature, min(Temperature) AS coldestTemperature
      FROM features GROUP BY kind),
x AS (SELECT *, max(Temperature) OVER (PARTITION BY kind) AS hi, min(Temperature) OVER (PARTITION BY kind) AS lo
      FROM features),
d AS (SELECT kind, min(timestamp) FILTER (WHERE Temperature = hi) AS warmestDay,
             min(timestamp) FILTER (WHERE Temperature = lo) AS coldestDay
      FROM x GROUP BY kind),
c AS (SELECT kind, {O.SLOT} AS busiestTime, count(*) AS n FROM features GROUP BY ALL),
b AS (SELECT kind, busiestTime FROM c QUALIFY row_number() OVER (PARTITION BY kind ORDER BY n DESC, busiestTime) = 1)
SELECT s.*, d.warmestDay, d.coldestDay, b.busiestTime
FROM s LEFT JOIN d ON s.kind = d.kind LEFT JOIN b ON s.kind = b.kind"""


def poll_counts(spark, sf):
    return M.poll_counts(B.readings(spark, sf))


SQL_POLL_COUNTS = O.BASE + f"SELECT {O.SLOT} AS pollTime, count(*) AS readings FROM readings GROUP BY ALL"


# ---------------------------------------------------------------------------
# Sorts, samples, splits, evaluation
# ---------------------------------------------------------------------------
def _baseline_scored(spark, sf):
    train, test = SA.split_by_hash(B.features(spark, sf), TEST_SHARE)
    return ML.score_baseline(ML.hour_baseline(train), test).select("readingId", S.LABEL, "prediction")


def top5_rows(spark, sf):
    return SA.head(_baseline_scored(spark, sf), 5)


SQL_TOP5_ROWS = O.BASE + f""", {O.SPLIT}
SELECT readingId, TotalAvailableBikes, prediction FROM scored ORDER BY readingId LIMIT 5"""


def sample_n(spark, sf):
    return SA.sample_n(B.features(spark, sf), SAMPLE_N).select("readingId", "stationId")


SQL_SAMPLE_N = O.BASE + f"""
SELECT readingId, stationId FROM features
ORDER BY md5(CAST(readingId AS VARCHAR)), readingId LIMIT {SAMPLE_N}"""


def train_split(spark, sf):
    return SA.split_by_hash(B.features(spark, sf), TEST_SHARE)[0].select("readingId", S.LABEL)


SQL_TRAIN_SPLIT = O.BASE + f", {O.SPLIT}\nSELECT readingId, TotalAvailableBikes FROM train"


def test_split(spark, sf):
    return SA.split_by_hash(B.features(spark, sf), TEST_SHARE)[1].select("readingId", S.LABEL)


SQL_TEST_SPLIT = O.BASE + f", {O.SPLIT}\nSELECT readingId, TotalAvailableBikes FROM test"


def regression_metrics(spark, sf):
    return ML.regression_metrics(_baseline_scored(spark, sf))


SQL_REGRESSION_METRICS = O.BASE + f""", {O.SPLIT},
m AS (SELECT count(*) AS n, sum(abs(prediction - TotalAvailableBikes)) AS sae,
             sum((prediction - TotalAvailableBikes) * (prediction - TotalAvailableBikes)) AS sse,
             sum(TotalAvailableBikes) AS sy, sum(TotalAvailableBikes * TotalAvailableBikes) AS syy
      FROM scored)
SELECT n, CAST(sae AS DOUBLE) / n AS MAE, CAST(sse AS DOUBLE) / n AS MSE,
       1.0 - {O.exact_double('n * sse')} / {O.exact_double('n * syy - sy * sy')} AS R2
FROM m"""


# ---------------------------------------------------------------------------
# Model, document, streams
# ---------------------------------------------------------------------------
def forest_predictions(spark, sf):
    """M2 + M3: random forest fitted on the training split, scored on the
    test split (not SQL-expressible)."""
    train, test = SA.split_by_hash(B.features(spark, sf), TEST_SHARE)
    model = ML.fit(train, maxDepth=QUERY_DEPTH)
    return ML.score(model, test)


# MLlib ships the growing forest to the executors at every level; at its
# full depth of 30 that takes minutes on a few thousand rows.
QUERY_DEPTH = 12


def splits_read_back(spark, sf):
    """S7 + P11 + K2: the four parts written, read back and joined by key."""
    base = scratch_path(spark, "splits")
    path = STG.write_splits(B.features(spark, sf), base, "all", TEST_SHARE)
    out = None
    for split in STG.SPLITS:
        target = STG.read_split(spark, path, split, "target")
        parts = STG.read_split(spark, path, split, "features").join(target, "readingId")
        parts = parts.select("readingId", F.lit(split).alias("split"), "Hour", S.LABEL)
        out = parts if out is None else out.unionByName(parts)
    return out


SQL_SPLITS_READ_BACK = O.BASE + f""", {O.SPLIT}
SELECT readingId, 'train' AS split, Hour, TotalAvailableBikes FROM train JOIN features f USING (readingId, TotalAvailableBikes, Hour)
UNION ALL SELECT readingId, 'test', Hour, TotalAvailableBikes FROM test JOIN features f USING (readingId, TotalAvailableBikes, Hour)"""


def metrics_csv(spark, sf):
    """K6 + F8: the metrics as a one-row CSV at a dated path, read back."""
    path = CSV.object_path(scratch_path(spark, "metrics_csv"), "model-metrics", CSV.dated_name("metrics-", D.isoformat()))
    CSV.write_csv(CSV.require_rows(regression_metrics(spark, sf), "the metrics"), path)
    schema = spark.createDataFrame([], "n long, MAE double, MSE double, R2 double").schema
    return CSV.read_csv(spark, path, schema)


def side_tables(spark, sf):
    """K7: the weekend table written with the other side tables, read back."""
    parts = DOC.stored_parts(B.features(spark, sf))
    paths = DOC.write_side_tables(None, scratch_path(spark, "side_tables"), "all", parts)
    schema = spark.createDataFrame([], "kind string, dayType string, meanAvailableBikes double").schema
    return CSV.read_csv(spark, paths["weekend"], schema)


def dated_object(spark, sf):
    """K4: readings written under the name of their day, counted by the name
    found in the path."""
    base, day = scratch_path(spark, "dated_object"), D.isoformat()
    path = f"{base}/{CSV.dated_name('readings-', day)}"
    CSV.write_csv(ST.two_week_scan(B.readings(spark, sf), D).select("readingId", "stationId"), path)
    back = spark.read.options(**CSV.CSV_OPTIONS).csv(path)
    name = F.regexp_extract(F.input_file_name(), r"/(readings-[0-9-]+\.csv)/", 1)
    return back.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))


SQL_DATED_OBJECT = O.BASE + f"""
SELECT 'readings-{D.isoformat()}.csv' AS name, count(*) AS n FROM readings
WHERE timestamp >= {_ts(_days(-14))} AND timestamp < {_ts(_days(1))}"""


def whole_bikes(spark, sf):
    """Halves round to the even neighbour."""
    half = (F.col("event_id") % 1001 - 500) / F.lit(2.0)
    return B.events(spark, sf).select("event_id", C.whole_bikes(half).alias("bikes"))


SQL_WHOLE_BIKES = "SELECT event_id, CAST(round_even((event_id % 1001 - 500) / 2.0, 0) AS BIGINT) AS bikes FROM events"


def station_positions(spark, sf):
    """Distinct positions in long form."""
    return M.station_positions(B.readings(spark, sf))


SQL_STATION_POSITIONS = O.BASE + """
SELECT stationId, Lat, Long, count(*) AS readings FROM readings GROUP BY stationId, Lat, Long"""


def one_station_profile(spark, sf):
    """the profile of one station."""
    return M.station_profile(B.features(spark, sf), only="STATION 1")


SQL_ONE_STATION_PROFILE = SQL_STATION_PROFILE.replace("FROM features", "FROM features WHERE stationId = 'STATION 1'")


def null_safe_join(spark, sf):
    """Readings whose time does not parse meet the weather row without
    a time, as null keys match null keys in the surveyed merge."""
    r = B.readings(spark, sf).withColumn("timestamp", F.when(F.col("readingId") % 7 != 0, F.col("timestamp")))
    w = B.weather(spark, sf)
    none = w.agg(F.lit(None).cast("timestamp_ntz").alias("Time"), *[F.max(m).alias(m) for m in S.WEATHER_MEASURES])
    joined = J.join_weather(FE.with_calendar(r), w.unionByName(none), how="left", null_safe=True)
    return joined.select("readingId", *S.WEATHER_MEASURES)


SQL_NULL_SAFE_JOIN = O.BASE + f"""
SELECT r.readingId, {", ".join(f"CASE WHEN r.readingId % 7 = 0 THEN (SELECT max({m}) FROM weather) ELSE w.{m} END AS {m}" for m in S.WEATHER_MEASURES)}
FROM readings r LEFT JOIN weather w ON date_trunc('hour', r.timestamp) = w.Time"""


def yesterday_range(spark, sf):
    """Yesterday on the local wall clock, and its two-week range."""
    p = C.yesterday_range("timestamp")
    return B.readings(spark, sf).select("readingId", p["end"].alias("yesterday"), p["start"].alias("rangeStart"))


SQL_YESTERDAY_RANGE = O.BASE + f""",
l AS (SELECT readingId, CAST((timestamp AT TIME ZONE 'UTC') AT TIME ZONE '{S.LOCAL_TZ}' AS DATE) AS d FROM readings)
SELECT readingId, CAST(d - 1 AS DATE) AS yesterday, CAST(d - {S.WINDOW_DAYS} AS DATE) AS rangeStart FROM l"""


def model_reload(spark, sf):
    """K8 + M2 + M3: rows that a saved and reloaded model scores otherwise
    than the live one, and rows that a single full tree, taught a label that
    is a function of its features, does not give back."""
    train, test = SA.split_by_hash(B.features(spark, sf), TEST_SHARE)
    exact = lambda df: df.withColumn(S.LABEL, (F.col("IsWeekend") * 5 + 2).cast("int"))
    model = ML.fit(exact(train), numTrees=1, bootstrap=False, maxDepth=5)
    path = ML.save(model, scratch_path(spark, "model_reload"))
    live, back = ML.score(model, exact(test)), ML.score(ML.load(path), exact(test), label=None)
    both = live.join(back.select("readingId", F.col("prediction").alias("again")), "readingId")
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("prediction") != F.col("again")).alias("differing"),
        F.count_if(F.col("prediction") != F.col(S.LABEL)).alias("wrong"),
    )


SQL_MODEL_RELOAD = O.BASE + f", {O.SPLIT}\nSELECT count(*) AS n, 0::BIGINT AS differing, 0::BIGINT AS wrong FROM test"


def quality_counts(spark, sf):
    """S1 + P8: snapshots and lists with bad texts mixed in; what is landed
    is what is kept and what is set aside, by reason."""
    snaps = TB.snapshot_text_from_events(B.events(spark, sf))
    bad = F.when(F.col("pollId") % 11 == 0, "not json").when(F.col("pollId") % 13 == 0, '{"a": 1}').when(F.col("pollId") % 17 == 0, F.lit(None).cast("string"))
    snaps = snaps.withColumn("payload", F.when(bad.isNotNull() | (F.col("pollId") % 17 == 0), bad).otherwise(F.col("payload")))
    aside = SN.set_aside(snaps)
    kept = SN.flatten_snapshot_text(snaps.join(aside.select("pollId"), "pollId", "left_anti"), keep=["pollId"])
    lists = B.readings(spark, sf).withColumn("BikeIds", F.when(F.col("readingId") % 19 == 0, "no list").otherwise(F.col("BikeIds")))
    unread = FE.unread_lists(lists).select(F.lit("unread list").alias("outcome"))
    counted = kept.select(F.lit("kept").alias("outcome")).unionByName(aside.select(F.col("reason").alias("outcome"))).unionByName(unread)
    return counted.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


SQL_QUALITY_COUNTS = """
SELECT CASE WHEN event_id % 11 = 0 OR event_id % 13 = 0 THEN 'no list' WHEN event_id % 17 = 0 THEN 'missing' ELSE 'kept' END AS outcome, count(*) AS n
FROM events GROUP BY 1
UNION ALL SELECT 'unread list', count(*) FROM events WHERE event_id % 19 = 0"""


def metrics_document(spark, sf):
    """K5: the feature table is written once to the shared scratch folder
    (one scan and join of the events); the document's four aggregates then
    read that columnar table instead of repeating the join."""
    path = scratch_path(spark, "metrics_document")
    B.features(spark, sf).write.parquet(path)
    return DOC.metrics_document(spark.read.parquet(path))


def _stream_dirs(spark, name):
    root = scratch_path(spark, name)
    return f"{root}/landing", f"{root}/sink", f"{root}/checkpoint"


def stream_ingest(spark, sf):
    """T-1: every snapshot delivered twice; the stream keeps one copy."""
    landing, sink, ckpt = _stream_dirs(spark, "stream_ingest")
    snaps = TB.snapshot_text_from_events(B.events(spark, sf))
    ING.land_snapshots(snaps, landing, landed_seq=0)
    ING.land_snapshots(snaps, landing, landed_seq=1)
    ING.start_ingest(spark, landing, sink, ckpt).awaitTermination()
    return ING.read_latest(spark, sink).select("stationId", "timestamp", "AvailableBikes", "IsOpen")


SQL_STREAM_INGEST = f"""
SELECT COALESCE(NULLIF({O.NAME}, ''), {O.SID}) AS stationId, {O.iso('ts')} AS timestamp,
       CAST({O.NBIKES} AS VARCHAR) AS AvailableBikes,
       CASE WHEN event_type <> 'signup' THEN 'True' ELSE 'False' END AS IsOpen
FROM events"""


def stream_hourly(spark, sf):
    """A7 as a stream: all hours, the newer half landed and read first."""
    landing, sink, ckpt = _stream_dirs(spark, "stream_hourly")
    snaps = TB.snapshot_text_from_events(B.events(spark, sf))
    for half in ("polledAt >= timestamp_ntz'2024-01-16'", "NOT polledAt >= timestamp_ntz'2024-01-16'"):
        ING.land_snapshots(snaps.where(half), landing)
        ING.start_hourly(spark, landing, sink, ckpt).awaitTermination()
    return ING.read_hourly(spark, sink)


SQL_STREAM_HOURLY = f"""
SELECT date_trunc('hour', ts) AS hour, count(*) AS readings, CAST(sum({O.NBIKES}) AS BIGINT) AS availableBikes
FROM events GROUP BY date_trunc('hour', ts)"""


def stream_upsert(spark, sf):
    """K1 in a stream: a second delivery carries corrected counts for every
    reading and must win."""
    landing, sink, ckpt = _stream_dirs(spark, "stream_upsert")
    ev = B.events(spark, sf)
    ING.land_snapshots(TB.snapshot_text_from_events(ev), landing, landed_seq=0)
    corrected = ev.withColumn("value", F.col("value") + 1)
    ING.land_snapshots(TB.snapshot_text_from_events(corrected), landing, landed_seq=1)
    ING.start_upsert(spark, landing, sink, ckpt).awaitTermination()
    return ING.read_latest(spark, sink).select("stationId", "timestamp", "AvailableBikes", "IsOpen")


SQL_STREAM_UPSERT = f"""
SELECT COALESCE(NULLIF({O.NAME}, ''), {O.SID}) AS stationId, {O.iso('ts')} AS timestamp,
       CAST(CAST(floor(value + 1) AS BIGINT) % 25 AS VARCHAR) AS AvailableBikes,
       CASE WHEN event_type <> 'signup' THEN 'True' ELSE 'False' END AS IsOpen
FROM events"""


# ---------------------------------------------------------------------------
QUERIES: dict[str, tuple[Query, str | None]] = {
    "snapshot_flatten": (snapshot_flatten, SQL_SNAPSHOT_FLATTEN),
    "two_week_scan": (two_week_scan, SQL_TWO_WEEK_SCAN),
    "two_week_scan_alt": (two_week_scan_alt, SQL_TWO_WEEK_SCAN_ALT),
    "csv_round_trip": (csv_round_trip, SQL_CSV_ROUND_TRIP),
    "weather_explode": (weather_explode, SQL_WEATHER_EXPLODE),
    "weather_range_scan": (weather_range_scan, SQL_WEATHER_RANGE_SCAN),
    "weather_for_readings": (weather_for_readings, SQL_WEATHER_FOR_READINGS),
    "geo_radius": (geo_radius, SQL_GEO_RADIUS),
    "upsert_latest": (upsert_latest, SQL_UPSERT_LATEST),
    "column_subset": (column_subset, SQL_COLUMN_SUBSET),
    "stringify": (stringify, SQL_STRINGIFY),
    "station_key": (station_key, SQL_STATION_KEY),
    "weather_rename": (weather_rename, SQL_WEATHER_RENAME),
    "ts_coerce": (ts_coerce, SQL_TS_COERCE),
    "calendar_features": (calendar_features, SQL_CALENDAR_FEATURES),
    "weekend_flag": (weekend_flag, SQL_WEEKEND_FLAG),
    "bike_count": (bike_count, SQL_BIKE_COUNT),
    "weather_join": (weather_join, SQL_WEATHER_JOIN),
    "weather_left_join": (weather_left_join, SQL_WEATHER_LEFT_JOIN),
    "feature_select": (feature_select, SQL_FEATURE_SELECT),
    "visibility_impute": (visibility_impute, SQL_VISIBILITY_IMPUTE),
    "current_weather": (current_weather, SQL_CURRENT_WEATHER),
    "stockholm_time": (stockholm_time, SQL_STOCKHOLM_TIME),
    "trailing_14d": (trailing_14d, SQL_TRAILING_14D),
    "single_bikes": (single_bikes, SQL_SINGLE_BIKES),
    "stationary": (stationary, SQL_STATIONARY),
    "dropna_any": (dropna_any, SQL_DROPNA_ANY),
    "date_range": (date_range, SQL_DATE_RANGE),
    "distinct_stations": (distinct_stations, SQL_DISTINCT_STATIONS),
    "temperature_extremes": (temperature_extremes, SQL_TEMPERATURE_EXTREMES),
    "extreme_days": (extreme_days, SQL_EXTREME_DAYS),
    "busiest_timestamp": (busiest_timestamp, SQL_BUSIEST_TIMESTAMP),
    "busiest_day": (busiest_day, SQL_BUSIEST_DAY),
    "correlation_matrix": (correlation_matrix, SQL_CORRELATION_MATRIX),
    "weekend_vs_weekday": (weekend_vs_weekday, SQL_WEEKEND_VS_WEEKDAY),
    "hourly_resample": (hourly_resample, SQL_HOURLY_RESAMPLE),
    "station_profile": (station_profile, SQL_STATION_PROFILE),
    "metrics_pack": (metrics_pack, SQL_METRICS_PACK),
    "poll_counts": (poll_counts, SQL_POLL_COUNTS),
    "top5_rows": (top5_rows, SQL_TOP5_ROWS),
    "sample_n": (sample_n, SQL_SAMPLE_N),
    "train_split": (train_split, SQL_TRAIN_SPLIT),
    "test_split": (test_split, SQL_TEST_SPLIT),
    "regression_metrics": (regression_metrics, SQL_REGRESSION_METRICS),
    "stream_ingest": (stream_ingest, SQL_STREAM_INGEST),
    "stream_hourly": (stream_hourly, SQL_STREAM_HOURLY),
    "stream_upsert": (stream_upsert, SQL_STREAM_UPSERT),
    "splits_read_back": (splits_read_back, SQL_SPLITS_READ_BACK),
    "metrics_csv": (metrics_csv, SQL_REGRESSION_METRICS),
    "side_tables": (side_tables, SQL_WEEKEND_VS_WEEKDAY),
    "dated_object": (dated_object, SQL_DATED_OBJECT),
    "whole_bikes": (whole_bikes, SQL_WHOLE_BIKES),
    "station_positions": (station_positions, SQL_STATION_POSITIONS),
    "one_station_profile": (one_station_profile, SQL_ONE_STATION_PROFILE),
    "null_safe_join": (null_safe_join, SQL_NULL_SAFE_JOIN),
    "yesterday_range": (yesterday_range, SQL_YESTERDAY_RANGE),
    "model_reload": (model_reload, SQL_MODEL_RELOAD),
    "quality_counts": (quality_counts, SQL_QUALITY_COUNTS),
    "metrics_document": (metrics_document, None),
    "forest_predictions": (forest_predictions, None),
    **X.QUERIES,
    "document_rows": (X.document_rows, X.document_rows_sql(SQL_METRICS_PACK, SQL_CORRELATION_MATRIX, SQL_WEEKEND_VS_WEEKDAY, SQL_HOURLY_RESAMPLE)),
    "side_table_rows": (X.side_table_rows, X.side_table_rows_sql(SQL_CORRELATION_MATRIX, SQL_WEEKEND_VS_WEEKDAY, SQL_HOURLY_RESAMPLE)),
}


def queries() -> dict[str, Query]:
    return {k: q for k, (q, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in QUERIES.items() if sql}

"""Declared schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the surveyed system for equal results).
# ---------------------------------------------------------------------------

# Weather source field names, in the order the source lists them, and the
# canonical names used everywhere after ingest.
WEATHER_RENAME = {
    "time": "Time",
    "temperature_2m": "Temperature",
    "relativehumidity_2m": "Humidity",
    "windspeed_10m": "Wind_Speed",
    "precipitation": "Precipitation",
    "visibility": "Visibility",
    "snowfall": "Snowfall",
}
WEATHER_SOURCE_FIELDS = list(WEATHER_RENAME)
WEATHER_MEASURES = [
    "Temperature",
    "Humidity",
    "Wind_Speed",
    "Precipitation",
    "Visibility",
    "Snowfall",
]
# Older model code spells the wind column differently; accepted as an alias.
COLUMN_ALIASES = {"Windspeed": "Wind_Speed"}

# Join keys between readings and hourly weather.
HOUR_KEYS = ["Year", "Month", "Day", "Hour"]

# Model features, in model order, and the label.
MODEL_FEATURES = [
    "IsOpen",
    "Long",
    "Lat",
    "Year",
    "Month",
    "Day",
    "Hour",
    "Minute",
    "Temperature",
    "Humidity",
    "Wind_Speed",
    "Precipitation",
    "Visibility",
    "Snowfall",
    "IsWeekend",
]
MODEL_FEATURES_NO_MINUTE = [c for c in MODEL_FEATURES if c != "Minute"]
LABEL = "TotalAvailableBikes"

# Columns of the dashboard correlation matrix, in matrix order.
CORRELATION_COLUMNS = [
    "AvailableBikes",
    "Distance",
    "Long",
    "Lat",
    "Year",
    "Month",
    "Day",
    "Hour",
    "Temperature",
    "Humidity",
    "Wind_Speed",
    "Precipitation",
    "Visibility",
    "Snowfall",
    "IsWeekend",
]

# Visibility imputed where the weather source has no value.
VISIBILITY_FILL = 23180.0

# Station search area of the station source: centre and radius in metres.
STATION_CENTER_LAT = 57.7089
STATION_CENTER_LON = 11.9746
STATION_RADIUS_M = 30000.0

# Station ids of free-floating bikes start with this prefix.
SINGLE_BIKE_PREFIX = "BIKE"
KIND_SINGLE = "single_bikes"
KIND_STATION = "station_bikes"

# Weekend codes and their labels.
WEEKEND_LABELS = {0: "Weekdays", 1: "Weekend"}

# Time zone of the local-time helper; two-week window length.
LOCAL_TZ = "Europe/Stockholm"
WINDOW_DAYS = 14

# Text read as missing by the CSV source (the pandas read_csv defaults).
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

# One station object of a snapshot (the station API returns a list of them).
STATION_SCHEMA = T.StructType(
    [
        T.StructField("StationId", T.StringType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Lat", T.DoubleType()),
        T.StructField("Long", T.DoubleType()),
        T.StructField("IsOpen", T.BooleanType()),
        T.StructField("AvailableBikes", T.IntegerType()),
        T.StructField("Distance", T.DoubleType()),
        T.StructField("BikeIds", T.ArrayType(T.StringType())),
    ]
)
SNAPSHOT_SCHEMA = T.ArrayType(STATION_SCHEMA)

# Raw reading item as kept by the keyed store: every attribute is text.
RAW_READING_SCHEMA = T.StructType(
    [
        T.StructField("stationId", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("sourceStationId", T.StringType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Lat", T.StringType()),
        T.StructField("Long", T.StringType()),
        T.StructField("IsOpen", T.StringType()),
        T.StructField("AvailableBikes", T.StringType()),
        T.StructField("Distance", T.StringType()),
        T.StructField("BikeIds", T.StringType()),
    ]
)

# Typed reading (what the batch stages work on).
READING_SCHEMA = T.StructType(
    [
        T.StructField("readingId", T.LongType()),
        T.StructField("stationId", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("AvailableBikes", T.IntegerType()),
        T.StructField("BikeIds", T.StringType()),
        T.StructField("IsOpen", T.BooleanType()),
        T.StructField("Long", T.DoubleType()),
        T.StructField("Lat", T.DoubleType()),
        T.StructField("Distance", T.DoubleType()),
    ]
)

# Weather response: parallel arrays under ``hourly``.
WEATHER_RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [
                    T.StructField(f, T.ArrayType(T.DoubleType()))
                    for f in WEATHER_SOURCE_FIELDS[1:]
                ]
            ),
        )
    ]
)

# Flat hourly weather table.
WEATHER_SCHEMA = T.StructType(
    [T.StructField("Time", T.TimestampNTZType())]
    + [T.StructField(m, T.DoubleType()) for m in WEATHER_MEASURES]
)

# Feature table written by the preprocessing stage.
FEATURE_COLUMNS = [
    "readingId",
    "stationId",
    "timestamp",
    "BikeIds",
    "AvailableBikes",
    "IsOpen",
    "Long",
    "Lat",
    "Distance",
    "Year",
    "Month",
    "Day",
    "Hour",
    "Minute",
    "Temperature",
    "Humidity",
    "Wind_Speed",
    "Precipitation",
    "Visibility",
    "Snowfall",
    "TotalAvailableBikes",
    "IsWeekend",
]

# One scoring row of the model (P15), in model order.
_MODEL_TYPES = {"IsOpen": T.BooleanType(), "IsWeekend": T.IntegerType()}
for _c in ("Year", "Month", "Day", "Hour", "Minute"):
    _MODEL_TYPES[_c] = T.IntegerType()
MODEL_ROW_SCHEMA = T.StructType(
    [T.StructField(c, _MODEL_TYPES.get(c, T.DoubleType())) for c in MODEL_FEATURES]
)

"""Weather source: struct-of-arrays responses, renames, range scans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake import schemas as S


def read_weather_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed weather responses (JSON) with the declared response schema."""
    return spark.read.option("multiLine", "true").schema(S.WEATHER_RESPONSE_SCHEMA).json(path)


def explode_hourly(df: DataFrame, hourly: str = "hourly", keep: list[str] | None = None) -> DataFrame:
    """Parallel arrays -> one row per hour, source field names.

    ``arrays_zip`` pads shorter arrays with nulls, so a missing value stays
    a null in its own row instead of shifting later hours.
    """
    keep = keep or []
    h = F.col(hourly)
    zipped = F.arrays_zip(*[h.getField(f).alias(f) for f in S.WEATHER_SOURCE_FIELDS])
    return df.select(*keep, F.inline(zipped))


def rename_weather(df: DataFrame) -> DataFrame:
    """P4 (and P3): source names -> canonical names; ``Time`` -> ``timestamp``
    only when no ``timestamp`` column exists yet.  Text times are parsed."""
    present = {k: v for k, v in S.WEATHER_RENAME.items() if k in df.columns}
    out = df.withColumnsRenamed(present)
    return time_as_timestamp(out)


def time_as_timestamp(df: DataFrame) -> DataFrame:
    """``Time`` becomes ``timestamp`` when ``timestamp`` is absent."""
    if "Time" in df.columns and "timestamp" not in df.columns:
        df = df.withColumnRenamed("Time", "timestamp")
    if "timestamp" in df.columns and dict(df.dtypes)["timestamp"] == "string":
        df = df.withColumn("timestamp", F.col("timestamp").try_cast("timestamp_ntz"))
    return df


def _field(name: str):
    return lambda r: r[name]


def to_daily_responses(weather: DataFrame) -> DataFrame:
    """Inverse of S4 for tests and landing: one struct-of-arrays per day
    (at most 24 hours per group, so every group is bounded)."""
    row = F.struct(
        F.col("Time").alias("t"),
        *[F.col(m).alias(m) for m in S.WEATHER_MEASURES],
    )
    daily = weather.groupBy(F.to_date("Time").alias("day")).agg(
        F.sort_array(F.collect_list(row)).alias("rows")
    )
    arrays = [
        F.transform("rows", lambda r: F.date_format(r["t"], "yyyy-MM-dd'T'HH:mm")).alias("time")
    ] + [
        F.transform("rows", _field(m)).alias(src)
        for src, m in zip(S.WEATHER_SOURCE_FIELDS[1:], S.WEATHER_MEASURES)
    ]
    return daily.select("day", F.struct(*arrays).alias("hourly"))


def current_weather(df: DataFrame, hourly: str = "hourly", keep: list[str] | None = None) -> DataFrame:
    """The first hour of each response (null when the arrays are empty)."""
    keep = keep or []
    h = F.col(hourly)
    return df.select(
        *keep,
        *[F.get(h.getField(src), 0).alias(m) for src, m in zip(S.WEATHER_SOURCE_FIELDS[1:], S.WEATHER_MEASURES)],
    )


def day_window(
    df: DataFrame, start: dt.date, end: dt.date, ts: str = "Time"
) -> DataFrame:
    """Whole days ``start`` .. ``end`` inclusive (a half-open range on
    the timestamp, so parquet row groups are skipped by min/max stats)."""
    lo = dt.datetime.combine(start, dt.time())
    hi = dt.datetime.combine(end + dt.timedelta(days=1), dt.time())
    lo_, hi_ = (F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz") for x in (lo, hi))
    return df.where((F.col(ts) >= lo_) & (F.col(ts) < hi_))


def weather_window_for_day(df: DataFrame, today: dt.date, days: int = S.WINDOW_DAYS, ts: str = "Time") -> DataFrame:
    """``[today - days, today]`` as the weather fetch requests it."""
    return day_window(df, today - dt.timedelta(days=days), today, ts)


def weather_window_of_readings(
    weather: DataFrame, readings: DataFrame, ts: str = "Time", readings_ts: str = "timestamp"
) -> DataFrame:
    """F3 (data-driven): weather for the days the readings span.  Both bounds
    come from one scalar subquery over the readings, not from a join."""
    days = readings.select(F.struct(F.to_date(F.min(readings_ts)).alias("lo"), F.date_add(F.to_date(F.max(readings_ts)), 1).alias("hi"))).scalar()
    t = F.col(ts)
    return weather.where((t >= days["lo"].cast("timestamp_ntz")) & (t < days["hi"].cast("timestamp_ntz")))

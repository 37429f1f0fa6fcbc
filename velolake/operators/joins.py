"""Readings joined to hourly weather on (Year, Month, Day, Hour).

The weather side has one row per hour, so its size is bounded by the time
span, never by the number of readings.  It is still broadcast only after its
stored size has been checked against a bound in bytes; above the bound the join is
left to the planner (sort-merge / AQE), which never fails on size, and AQE's
skew-join handling splits an hour that holds an outsized share of readings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import columns as C
from velolake.session import scratch_path

# Bytes as stored (Parquet) up to which a side is broadcast.
MAX_BROADCAST_BYTES = 32 << 20


def checked_broadcast(small: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(frame, broadcast?)``.

    The frame is written to a fresh folder in the shared scratch space and
    read back from there, so its size is known from the files and nothing is
    cached: a later call with new data reads the new data.  Only a frame
    within the bound gets the broadcast hint.
    """
    spark, path = small.sparkSession, scratch_path(small.sparkSession, "small-side")
    small.write.parquet(path)
    stored = spark.read.schema(small.schema).parquet(path)
    size = int(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return (F.broadcast(stored), True) if size <= max_bytes else (stored, False)


def weather_by_hour(weather: DataFrame, ts: str = "Time") -> DataFrame:
    """Hourly weather keyed by the four hour keys, measures only (so the
    joined table carries no ``_x``/``_y`` duplicates, cf. P9)."""
    cal = C.calendar_columns(ts)
    return weather.select(*[cal[k].alias(k) for k in S.HOUR_KEYS], *S.WEATHER_MEASURES)


def join_weather(
    readings: DataFrame,
    weather: DataFrame,
    how: str = "inner",
    null_safe: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    weather_ts: str = "Time",
) -> DataFrame:
    """Readings (with calendar columns) joined to hourly weather.

    ``how="left"`` keeps unmatched readings with null weather (J1);
    ``null_safe=True`` also matches readings whose hour keys are null with
    weather rows whose keys are null (pandas ``merge`` matches NaN keys).
    """
    w = weather_by_hour(weather, weather_ts)
    w, _ = checked_broadcast(w, max_broadcast_bytes)
    if not null_safe:
        return readings.join(w, on=S.HOUR_KEYS, how=how)
    r = readings.alias("r")
    wa = w.alias("w")
    cond = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"w.{k}")) for k in S.HOUR_KEYS])
    return r.join(wa, cond, how).select("r.*", *[F.col(f"w.{m}") for m in S.WEATHER_MEASURES])

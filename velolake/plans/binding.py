"""The driver tables bound to the station / weather model, as lazy plans.

Every builder reads the parquet tables under ``sf_dir`` and returns an
unexecuted DataFrame, so filters and column selections of the query that
uses it reach the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import columns as C
from velolake.operators import features as FE
from velolake.sources import tables as TB

# The day the two-week windows of the registered queries end on (the
# driver's events cover 2024-01-01 .. 2024-01-30).
REPORT_DAY = dt.date(2024, 1, 20)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.events(spark, sf_dir)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.readings_from_events(events(spark, sf_dir))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.weather_from_events(events(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Feature table (J2: inner join + null drop) with the ``kind`` column.
    Readings and weather derive from one read of ``events``; ``dealt``:
    readings are dealt over all cores first, if their files have fewer splits."""
    ev = events(spark, sf_dir)
    cores = spark.sparkContext.defaultParallelism
    of_readings = ev.repartition(cores) if dealt and ev.rdd.getNumPartitions() < cores else ev
    return FE.with_kind(FE.build_features(TB.readings_from_events(of_readings), TB.weather_from_events(ev)))


def features_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading, null weather where the hour has none."""
    ev = events(spark, sf_dir)
    return FE.with_kind(FE.build_features_left(TB.readings_from_events(ev), TB.weather_from_events(ev)))


def timestamp_text(ev: DataFrame) -> DataFrame:
    """Readings whose timestamp arrives as text in several forms, some of
    them unusable: ``garbage`` (id ending in 0), empty (1), space-separated
    (2), date only (3), ISO with ``T`` (otherwise)."""
    rot = F.col("event_id") % 10
    iso = C.as_text("ts", "timestamp_ntz")
    text = (
        F.when(rot == 0, F.lit("garbage"))
        .when(rot == 1, F.lit(""))
        .when(rot == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(rot == 3, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(iso)
    )
    return ev.select(
        F.col("event_id").alias("readingId"),
        TB.station_id_expr().alias("stationId"),
        text.alias("timestamp"),
    )


def source_named_weather(w: DataFrame) -> DataFrame:
    """Hourly weather as the weather handler writes it: source field names,
    time as ISO text."""
    return w.select(
        F.date_format("Time", "yyyy-MM-dd'T'HH:mm").alias("time"),
        *[F.col(m).alias(src) for src, m in zip(S.WEATHER_SOURCE_FIELDS[1:], S.WEATHER_MEASURES)],
    )

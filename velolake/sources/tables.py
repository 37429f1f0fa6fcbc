"""Driver tables and their binding to the station / weather data model.

The driver ships generic parquet tables.  ``events`` carries both inputs:

* readings: one station reading per event;
* weather: one hourly row per hour that has ``view`` events.

Both are narrow projections / one partial aggregation over a column-pruned
parquet scan, so they scale with the table and push filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.functions import columns as C

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]

# The stored bike-id list comes in every text form the parser must accept,
# chosen by event id (see ``columns.list_literal``).
BIKE_ID_STYLES = ("single", "double", "none_last", "bare")


def bike_id_style(event_id: str = "event_id") -> Column:
    return F.element_at(
        F.array(*[F.lit(s) for s in BIKE_ID_STYLES]),
        (F.col(event_id) % len(BIKE_ID_STYLES)).cast("int") + 1,
    )


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


# ---------------------------------------------------------------------------
# Readings
# ---------------------------------------------------------------------------
def station_id_expr() -> Column:
    """``BIKE <user>`` for ``error`` events (free-floating bikes), else
    ``STATION <user>``."""
    return F.concat(
        F.when(F.col("event_type") == "error", F.lit("BIKE ")).otherwise(F.lit("STATION ")),
        F.col("user_id").cast("string"),
    )


MAX_BIKES = 24


def available_bikes_expr() -> Column:
    return (F.floor(F.col("value")) % (MAX_BIKES + 1)).cast("int")


def readings_from_events(ev: DataFrame) -> DataFrame:
    """Typed readings: ``readingId stationId timestamp AvailableBikes BikeIds
    IsOpen Long Lat Distance``.  ``readingId`` (the event id) doubles as the
    ingest sequence number and as the stable row key."""
    n = available_bikes_expr()
    ev = ev.withColumn("_n", n).withColumn("_style", bike_id_style())
    return ev.select(
        F.col("event_id").alias("readingId"),
        station_id_expr().alias("stationId"),
        F.col("ts").alias("timestamp"),
        n.alias("AvailableBikes"),
        C.list_literal_bounded("_n", "_style", MAX_BIKES).alias("BikeIds"),
        (F.col("event_type") != "signup").alias("IsOpen"),
        ((F.lit(11970) + F.col("user_id") % 100).cast("double") / 1000.0).alias("Long"),
        ((F.lit(57700) + F.col("user_id") % 50).cast("double") / 1000.0).alias("Lat"),
        (F.col("user_id") * 10).cast("double").alias("Distance"),
    )


def station_name_expr() -> Column:
    """The station ``Name`` as the API sends it: missing, empty or a text,
    in rotation by event id (so the key fallback P2 is exercised)."""
    rot = F.col("event_id") % 3
    return F.when(rot == 0, F.lit(None).cast("string")).when(rot == 1, F.lit("")).otherwise(
        F.concat(F.lit("Stop "), F.col("user_id").cast("string"))
    )


def snapshot_text_from_events(ev: DataFrame) -> DataFrame:
    """Each event rendered as the station API renders one station: a JSON
    list holding the station object (``BikeIds`` as a real array).  ``Name``
    is null / empty / text in rotation so the key fallback is exercised."""
    n = available_bikes_expr()
    name = station_name_expr()
    # the id arrays for 0..MAX_BIKES, generated here and picked per row
    id_arrays = ", ".join(
        "array(" + ", ".join(f"'{i}'" for i in range(1, k + 1)) + ")" if k else "CAST(array() AS array<string>)"
        for k in range(MAX_BIKES + 1)
    )
    ids = F.expr(f"element_at(array({id_arrays}), CAST(floor(value) % {MAX_BIKES + 1} AS INT) + 1)")
    station = F.struct(
        station_id_expr().alias("StationId"),
        name.alias("Name"),
        ((F.lit(57700) + F.col("user_id") % 50).cast("double") / 1000.0).alias("Lat"),
        ((F.lit(11970) + F.col("user_id") % 100).cast("double") / 1000.0).alias("Long"),
        (F.col("event_type") != "signup").alias("IsOpen"),
        n.alias("AvailableBikes"),
        (F.col("user_id") * 10).cast("double").alias("Distance"),
        ids.alias("BikeIds"),
    )
    return ev.select(
        F.col("event_id").alias("pollId"),
        F.col("ts").alias("polledAt"),
        F.to_json(F.array(station), {"ignoreNullFields": "false"}).alias("payload"),
    )


# ---------------------------------------------------------------------------
# Weather
# ---------------------------------------------------------------------------
def weather_from_events(ev: DataFrame) -> DataFrame:
    """Hourly weather from ``view`` events (one row per hour that has any).

    All measures are exact (decimal / integer arithmetic), so the result
    does not depend on how rows are partitioned.
    """
    views = ev.where(F.col("event_type") == "view")
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    hourly = views.groupBy(C.hour_floor("ts").alias("Time")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("_s"),
        F.sum(k).alias("_k"),
        F.max("value").alias("Wind_Speed"),
        F.min("value").alias("Precipitation"),
    )
    n = F.col("_n")
    return hourly.select(
        "Time",
        # floor(sum / n) in integer arithmetic (all values are positive)
        F.expr("cast(cast(_s * 100 as bigint) div (_n * 100) as double)").alias("Temperature"),
        F.expr("cast(_k div _n as double)").alias("Humidity"),
        "Wind_Speed",
        "Precipitation",
        F.when(n == 1, F.lit(None).cast("double")).otherwise((n * 1000).cast("double")).alias(
            "Visibility"
        ),
        n.cast("double").alias("Snowfall"),
    )

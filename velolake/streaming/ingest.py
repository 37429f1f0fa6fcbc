"""T-1: continuous ingest of station snapshots with Structured Streaming.

Snapshots land as JSON lines ``{pollId, polledAt, landedSeq, payload}``
(``payload``: the station API's JSON list, ``landedSeq``: delivery number,
higher = later).  Three streams:

* :func:`start_ingest` - flatten, key (P2), stringify (P1), keep one row per
  (stationId, timestamp): each micro-batch is merged into the store.
* :func:`start_hourly` - sums per hour (A7 as a stream): each micro-batch
  adds its own.
* :func:`start_upsert` - strict last-write-wins (K1): every micro-batch is
  merged into a store partitioned by reading day (only touched days are
  rewritten; a replayed batch gives the same result).

Checkpoints live under the session's shared checkpoint folder.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from velolake.functions import columns as C
from velolake.operators.dedupe import upsert_into, write_partitions
from velolake.sources.snapshots import flatten_snapshot_text, snapshot_to_items

LANDED_SCHEMA = T.StructType(
    [
        T.StructField("pollId", T.LongType()),
        T.StructField("polledAt", T.StringType()),
        T.StructField("landedSeq", T.IntegerType()),
        T.StructField("payload", T.StringType()),
    ]
)
KEY = ["stationId", "timestamp"]


MAX_FILES = 1000  # landed files that one micro-batch takes


def land_snapshots(snaps: DataFrame, path: str, landed_seq: int = 0) -> str:
    """Write snapshots (``pollId, polledAt, payload``) as JSON lines, one
    delivery (appended files) per call."""
    out = snaps.select(
        "pollId",
        C.as_text("polledAt", "timestamp_ntz").alias("polledAt"),
        F.lit(landed_seq).alias("landedSeq"),
        "payload",
    )
    out.write.mode("append").json(path)
    return path


def read_landed(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def items_stream(landed: DataFrame) -> DataFrame:
    """Landed snapshots -> store items (all text) plus a typed event time.
    Watermarks need a zoned timestamp, so the naive poll time is cast."""
    stations = flatten_snapshot_text(landed, keep=["pollId", "polledAt", "landedSeq"])
    items = snapshot_to_items(stations.withColumn("polledAt", C.coerce_timestamp("polledAt")), "polledAt", keep=("landedSeq", "pollId"))
    return items.withColumn("eventTime", C.coerce_timestamp("timestamp").cast("timestamp"))


def _run(stream: DataFrame, write_batch, checkpoint: str, available_now: bool, processing_time: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)).start()


def start_ingest(
    spark: SparkSession,
    landing: str,
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str = "10 minutes",
    max_files_per_trigger: int | None = MAX_FILES,
) -> StreamingQuery:
    """One row per reading, whenever and however often it is delivered: each
    micro-batch is merged into the store by (stationId, timestamp), the later
    poll winning.  No reading is too late.  ``available_now`` processes what
    has landed and stops (batch-style runs, tests); otherwise the query polls
    every ``processing_time`` (the source's poll interval)."""
    items = items_stream(read_landed(spark, landing, max_files_per_trigger))
    keyed = items.select(
        "*", F.struct("landedSeq", "pollId").alias("_seq"), F.to_date("eventTime").alias("readingDate")
    ).drop("eventTime", "landedSeq", "pollId")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        upsert_into(batch.sparkSession, sink, batch, KEY, "_seq", "readingDate")

    return _run(keyed, write_batch, checkpoint, available_now, processing_time)


def start_hourly(
    spark: SparkSession,
    landing: str,
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str = "10 minutes",
    max_files_per_trigger: int | None = MAX_FILES,
) -> StreamingQuery:
    """Readings and available bikes per event-time hour.  Each micro-batch
    writes its own sums to its own partition (a replayed batch overwrites
    it), :func:`read_hourly` adds them up: runs in any order give one result
    and no reading is too late.  What is summed are deliveries: a poll landed
    twice counts twice here, and once in ``event_time.start_hours``."""
    items = items_stream(read_landed(spark, landing, max_files_per_trigger))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy(C.hour_floor(F.col("eventTime").cast("timestamp_ntz")).alias("hour")).agg(
            F.count(F.lit(1)).alias("readings"), F.sum(F.col("AvailableBikes").cast("long")).alias("availableBikes")
        )
        write_partitions(sums.withColumn("batch", F.lit(f"{run_id}-{batch_id}")), sink, ["batch"])

    # batches are numbered per checkpoint: two queries may share a sink
    run_id = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    return _run(items, write_batch, checkpoint, available_now, processing_time)


def read_hourly(spark: SparkSession, sink: str, before=None) -> DataFrame:
    """Hours of :func:`start_hourly`; with ``before`` (a timestamp) those
    that had ended by then."""
    hours = spark.read.parquet(sink).groupBy("hour").agg(F.sum("readings").alias("readings"), F.sum("availableBikes").alias("availableBikes"))
    return hours if before is None else hours.where(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(before).cast("timestamp_ntz"))


def start_upsert(
    spark: SparkSession,
    landing: str,
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str = "10 minutes",
    max_files_per_trigger: int | None = MAX_FILES,
) -> StreamingQuery:
    """Strict last-write-wins (K1) into a store partitioned by reading day:
    every micro-batch is merged with :func:`dedupe.upsert_into` (only the
    days it touches are read and rewritten).  A replayed batch merges the
    same rows again and yields the same winners, so retries are idempotent."""
    landed = read_landed(spark, landing, max_files_per_trigger)
    stations = flatten_snapshot_text(landed, keep=["pollId", "polledAt", "landedSeq"])
    stations = stations.withColumn("polledAt", C.coerce_timestamp("polledAt"))
    keyed = stations.select(
        C.station_key("Name", "StationId").alias("stationId"),
        C.as_text("polledAt", "timestamp_ntz").alias("timestamp"),
        F.struct("landedSeq", "pollId").alias("_seq"),
        C.as_text("AvailableBikes").alias("AvailableBikes"),
        C.as_text("IsOpen", "boolean").alias("IsOpen"),
        F.to_date("polledAt").alias("readingDate"),
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        upsert_into(batch.sparkSession, sink, batch, KEY, "_seq", "readingDate")

    return _run(keyed, write_batch, checkpoint, available_now, processing_time)


def read_latest(spark: SparkSession, sink: str) -> DataFrame:
    """The store written by :func:`start_upsert` or :func:`start_ingest`: one
    row per key."""
    return spark.read.parquet(sink).drop("_seq", "readingDate")

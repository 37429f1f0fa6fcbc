"""Station snapshots (the station API's JSON list) -> reading rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import columns as C


def read_snapshot_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed snapshot files (one JSON list of stations per file) -> one row
    per station, with the file name as the poll id.  The declared schema
    avoids an inference pass over the whole folder."""
    raw = (
        spark.read.option("multiLine", "true")
        .schema(S.STATION_SCHEMA)
        .json(path)
        .withColumn("pollFile", F.col("_metadata.file_path"))
    )
    return raw


def set_aside(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The rows that :func:`flatten_snapshot_text` can't use, with a
    ``reason``: no text, text that is no list of stations, or an element that
    is no station.  Kept snapshots and these are all snapshots."""
    parsed = F.from_json(F.col(payload), S.SNAPSHOT_SCHEMA)
    # a list text is an array of values even where they are no stations
    listed = F.col(payload).startswith("[") & parsed.isNotNull()
    empty = F.exists(parsed, lambda s: s.isNull() | (s["StationId"].isNull() & s["Name"].isNull()))
    reason = F.when(F.col(payload).isNull(), "missing").when(~listed, "no list").when(empty, "no station")
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def flatten_snapshot_text(
    df: DataFrame, payload: str = "payload", keep: list[str] | None = None
) -> DataFrame:
    """A text column holding a JSON list of station objects -> one row per
    station.  Unparsable text yields no rows here; :func:`set_aside` has it."""
    keep = keep or [c for c in df.columns if c != payload]
    parsed = df.select(*keep, F.explode(F.from_json(F.col(payload), S.SNAPSHOT_SCHEMA)).alias("s"))
    return parsed.select(*keep, "s.*")


def snapshot_to_items(stations: DataFrame, polled_at: str = "polledAt", keep: tuple[str, ...] = ()) -> DataFrame:
    """Station rows -> store items: ``stationId`` (P2), poll ``timestamp``
    and every station attribute as text (P1), ``BikeIds`` as a list literal."""
    ids = F.col("BikeIds")
    bike_ids_text = F.when(ids.isNull(), F.lit(None)).otherwise(
        F.concat(
            F.lit("["),
            F.array_join(
                F.transform(ids, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ", "None"
            ),
            F.lit("]"),
        )
    )
    return stations.select(
        C.station_key("Name", "StationId").alias("stationId"),
        C.as_text(polled_at, "timestamp_ntz").alias("timestamp"),
        # the API attribute; named apart from the key, since Spark resolves
        # names case-insensitively
        C.as_text("StationId").alias("sourceStationId"),
        C.as_text("Name").alias("Name"),
        C.as_text("Lat", "double").alias("Lat"),
        C.as_text("Long", "double").alias("Long"),
        C.as_text("IsOpen", "boolean").alias("IsOpen"),
        C.as_text("AvailableBikes").alias("AvailableBikes"),
        C.as_text("Distance", "double").alias("Distance"),
        bike_ids_text.alias("BikeIds"),
        *keep,
    )


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text; nulls stay null."""
    types = dict(df.dtypes)
    return df.select(*[C.as_text(c, types[c]).alias(c) for c in df.columns])

"""The dashboard metrics document and its side tables.

One JSON document per station kind: the scalar metrics rendered as text,
and the three tables (correlation, weekend comparison, hourly series) as
lists of records.  Every list is bounded by a fixed size (15x15 cells, two
day types) or by the time span (hours), never by the number of readings,
so ``collect_list`` per kind is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import columns as C
from velolake.operators import correlation as CORR
from velolake.operators import metrics as M
from velolake.session import scratch_path
from velolake.sources.csv import object_path, write_csv

JSON_OPTIONS = {"ignoreNullFields": "false"}


def _text(col: str) -> F.Column:
    return F.col(col).cast("string")


def _ordered_records(df: DataFrame, pos: F.Column, fields: list[str], by: str = "kind") -> DataFrame:
    """Per ``by``: the rows as a list of records (``fields`` in this order),
    sorted by ``pos``."""
    rec = F.struct(pos.alias("_pos"), F.struct(*[F.col(c) for c in fields]).alias("_rec"))
    return df.groupBy(by).agg(F.transform(F.sort_array(F.collect_list(rec)), lambda x: x["_rec"]).alias("rows"))


def metrics_tables(features: DataFrame) -> dict[str, DataFrame]:
    """The three long tables of the document (K7 side outputs)."""
    corr = CORR.correlation_long(features)
    weekend = M.weekend_vs_weekday(features)
    hourly = M.hourly_resample(features).withColumn("hour", C.timestamp_text("hour"))
    return {"correlation": corr, "weekend": weekend, "hourly": hourly}


def stored_parts(features: DataFrame) -> dict[str, DataFrame]:
    """The scalar pack and the three tables, each computed once: written to
    the shared scratch folder and read back for every output made of them."""
    spark, root = features.sparkSession, scratch_path(features.sparkSession, "metric-parts")
    out = {}
    for name, df in {"pack": M.metrics_pack(features), **metrics_tables(features)}.items():
        df.write.parquet(f"{root}/{name}")
        out[name] = spark.read.schema(df.schema).parquet(f"{root}/{name}")
    return out


def metrics_document(features: DataFrame | None = None, parts: dict[str, DataFrame] | None = None) -> DataFrame:
    """``(kind, document)``: the nine metrics of one kind as one JSON text,
    keyed and shaped as the dashboard reads them: scalars as text, tables
    as lists of records (the correlation matrix one record per row, in
    column order; gap hours with null means).  ``parts`` are the tables of
    :func:`stored_parts`, where they are at hand."""
    cols = list(S.CORRELATION_COLUMNS)
    t = parts or {"pack": M.metrics_pack(features), **metrics_tables(features)}
    pack = t["pack"]
    scalars = pack.select(
        "kind",
        _text("numStations").alias("number_of_bikes_available"),
        _text("warmestTemperature").alias("warmest_temperature"),
        _text("coldestTemperature").alias("coldest_temperature"),
        C.timestamp_text("coldestDay").alias("coldest_day"),
        C.timestamp_text("warmestDay").alias("warmest_day"),
        C.timestamp_text("busiestTime").alias("day_with_most_used_bikes"),
    )
    wide = CORR.correlation_wide(t["correlation"], cols)
    names = F.array(*[F.lit(c) for c in cols])
    corr = _ordered_records(wide, F.array_position(names, F.col("colA")), cols).withColumnRenamed(
        "rows", "correlation_matrix"
    )
    week = t["weekend"].select(
        "kind",
        F.col("dayType").alias("IsWeekend"),
        F.col("meanAvailableBikes").alias("AvailableBikes"),
    )
    week = _ordered_records(week, F.col("IsWeekend"), ["IsWeekend", "AvailableBikes"]).withColumnRenamed(
        "rows", "weekend_vs_weekday"
    )
    hourly = t["hourly"].withColumnRenamed("hour", "timestamp")
    hour = _ordered_records(
        hourly, F.col("timestamp"), ["timestamp", "Humidity", "Wind_Speed", "Temperature", S.LABEL]
    ).withColumnRenamed("rows", "weather_over_timestamp")
    doc = scalars.join(corr, "kind", "left").join(week, "kind", "left").join(hour, "kind", "left")
    body = F.struct(*[F.col(c) for c in doc.columns if c != "kind"])
    return doc.select("kind", F.to_json(body, JSON_OPTIONS).alias("document"))


def write_documents(docs: DataFrame, base: str, date_range: str, kinds=(S.KIND_STATION, S.KIND_SINGLE)) -> dict[str, str]:
    """K5: ``{base}/{kind}/{range}/`` holds the kind's document (one line of
    JSON; one small file per kind)."""
    path = scratch_path(docs.sparkSession, "documents")  # one row per kind, made once
    docs.write.parquet(path)
    docs = docs.sparkSession.read.schema(docs.schema).parquet(path)
    out = {}
    for kind in kinds:
        path = object_path(base, kind, date_range)
        docs.where(F.col("kind") == kind).select("document").coalesce(1).write.mode("overwrite").text(path)
        out[kind] = path
    return out


def write_side_tables(features: DataFrame | None, base: str, date_range: str, parts: dict[str, DataFrame] | None = None) -> dict[str, str]:
    """K7: each long table as CSV under ``{base}/{table}/{range}``."""
    out = {}
    tables = {k: v for k, v in parts.items() if k != "pack"} if parts else metrics_tables(features)
    for name, table in tables.items():
        out[name] = write_csv(table, object_path(base, name, date_range))
    return out

"""M3 in a stream: a saved model scores readings as they land.

* :func:`score_stream` - any stream of feature rows through a saved
  ``PipelineModel``: the same ``transform`` as in batch, appended to a sink.
* :func:`start_live_scoring` - landed snapshots, joined to the weather as it
  is stored when their micro-batch runs, scored by the saved model.  Every
  reading gets a row: one whose hour has no weather yet, or whose own values
  are missing, has a null prediction, and :func:`unscored` finds it for a
  later run.  A replayed micro-batch overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from velolake import schemas as S
from velolake.functions import columns as C
from velolake.ml import forest as ML
from velolake.operators import features as FE
from velolake.operators.dedupe import write_partitions
from velolake.streaming.event_time import _trigger
from velolake.streaming.ingest import MAX_FILES, items_stream, read_landed


def typed_readings(items: DataFrame) -> DataFrame:
    """Store items (all text) as typed readings; the poll is their id."""
    kinds = {f.name: f.dataType for f in S.READING_SCHEMA}
    text = {c: F.col(c).cast(kinds[c]).alias(c) for c in ("stationId", "BikeIds", "Lat", "Long", "Distance", "AvailableBikes", "IsOpen")}
    return items.select(F.col("pollId").alias("readingId"), C.coerce_timestamp("timestamp").alias("timestamp"), *text.values())


def score_complete(model: PipelineModel, features: DataFrame, keep: Sequence[str] = ("readingId",), label: str | None = S.LABEL) -> DataFrame:
    """:func:`forest.score`, null where a feature other than Visibility
    (which the model fills) is missing."""
    needed = [S.COLUMN_ALIASES.get(c, c) for c in S.MODEL_FEATURES if c != "Visibility"]
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in needed])
    marked = features.withColumn("_complete", whole)
    scored = ML.score(model, marked, keep=[*keep, "_complete"], label=label)
    blank = {c: F.when(F.col("_complete"), F.col(c)).alias(c) for c in ("prediction", "predictedBikes")}
    return scored.select(*[blank.get(c, F.col(c)) for c in scored.columns if c != "_complete"])


def score_stream(
    features: DataFrame, model_path: str, sink: str, checkpoint: str, keep: Sequence[str] = ("readingId",), available_now: bool = True, processing_time: str = "10 minutes"
) -> StreamingQuery:
    """Scores of a stream of feature rows, appended to ``sink`` (parquet)."""
    scored = score_complete(ML.load(model_path), features, keep)
    writer = scored.writeStream.format("parquet").outputMode("append").option("path", sink)
    return _trigger(writer.option("checkpointLocation", checkpoint), available_now, processing_time)


def start_live_scoring(
    spark: SparkSession,
    landing: str,
    weather: Callable[[], DataFrame],
    model_path: str,
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str = "10 minutes",
    max_files_per_trigger: int | None = MAX_FILES,
) -> StreamingQuery:
    """Scores of landed snapshots below ``sink``.  ``weather`` gives the
    hourly weather anew for each micro-batch."""
    model = ML.load(model_path)
    items = items_stream(read_landed(spark, landing, max_files_per_trigger))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        features = FE.build_features_left(typed_readings(batch), weather())
        scored = score_complete(model, features, keep=("readingId", "stationId", "timestamp"))
        write_partitions(scored.withColumn("batch", F.lit(batch_id)), sink, ["batch"])

    return _trigger(items.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint), available_now, processing_time)


def unscored(scores: DataFrame) -> DataFrame:
    """Readings that no row of ``scores`` has a prediction for."""
    best = scores.groupBy("readingId", "stationId", "timestamp").agg(F.max("prediction").alias("best"))
    return best.where(F.col("best").isNull()).drop("best")

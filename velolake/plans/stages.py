"""The batch stages end to end (entries 2-4 of the surveyed system).

* :func:`prepare` - two-week readings + weather -> feature table, written
  once, partitioned by ``kind`` and day (K2 layout ``{base}/{kind}/...``);
  the written table cuts the lineage for the later stages.
* :func:`publish_metrics` - the metrics document per kind (K5) and the side
  tables (K7) from the written feature table.
* :func:`train_and_evaluate` - hash split (M1), forest (M2), scoring (M3),
  metrics (M4) written as a one-row CSV (K6), model saved (K8).

Output folders are below ``base``, a shared location (object store / HDFS);
nothing is written to a machine-local folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake.ml import forest as ML
from velolake.operators import features as FE
from velolake.operators import metrics as M
from velolake.operators import sampling as SA
from velolake.session import scratch_path
from velolake.sinks import documents as DOC
from velolake.sources import csv as CSV
from velolake.sources import store as ST


def prepare(
    spark: SparkSession,
    readings: DataFrame,
    weather: DataFrame,
    base: str,
    day: dt.date,
) -> tuple[str, str]:
    """Write the feature table of the two weeks ending on ``day``; returns
    ``(path, date_range)``.  Rows are partitioned by kind and calendar day,
    so a later stage that needs one kind or a few days prunes the rest."""
    window = ST.two_week_scan(readings, day)
    CSV.require_rows(window, "the two-week window")
    feats = FE.with_kind(FE.build_features(window, weather))
    # stored once: the range and the table are both read from it
    joined = scratch_path(spark, "joined-features")
    feats.write.parquet(joined)
    rows = CSV.require_rows(spark.read.schema(feats.schema).parquet(joined), "the readings joined to weather")
    date_range = M.date_range(rows, by=None).first().rangeName
    path = CSV.object_path(base, "features", date_range)
    (
        # not "day": names resolve case-insensitively and "Day" is a feature
        rows.withColumn("readingDate", F.to_date("timestamp"))
        .hint("rebalance", "kind", "readingDate")  # few files per kind and day
        .write.mode("overwrite")
        .partitionBy("kind", "readingDate")
        .parquet(path)
    )
    return path, date_range


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("readingDate")


def publish_metrics(spark: SparkSession, features_path: str, base: str, date_range: str) -> dict[str, str]:
    """K5 + K7 from the written feature table: the pack and the three tables
    are computed once, all outputs are made of them."""
    parts = DOC.stored_parts(read_features(spark, features_path))
    docs = DOC.write_documents(DOC.metrics_document(parts=parts), f"{base.rstrip('/')}/graphs", date_range)
    out = {f"document_{k}": v for k, v in docs.items()}
    out.update(DOC.write_side_tables(None, f"{base.rstrip('/')}/tables", date_range, parts))
    return out


SPLITS = ("train", "test")
PARTS = ("features", "target")


def split(features: DataFrame, test_share: float = 0.2, key: str = "readingId", exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """M1: by hash, or with exactly ``ceil(test_share * rows)`` test rows."""
    return (SA.split_exact if exact else SA.split_by_hash)(features, test_share, key)


def write_splits(features: DataFrame, base: str, date_range: str, test_share: float = 0.2, key: str = "readingId", exact: bool = False) -> str:
    """M1 + P11 + K2: the four parts (train/test x features/target), each
    as parquet under ``{path}/split=<s>/part=<p>``.  Both parts keep the row
    key, so features and target are joined by key, never by row order.
    The input should be a written table (as :func:`prepare` produces): each
    part is one scan of it."""
    from velolake import schemas as S

    train, test = split(features, test_share, key, exact)
    path = CSV.object_path(base, "splits", date_range)
    for name, df in zip(SPLITS, (train, test)):
        target, feats = FE.split_target(df, S.LABEL, key)
        FE.select_features(feats, keep=[key]).write.mode("overwrite").parquet(f"{path}/split={name}/part=features")
        target.write.mode("overwrite").parquet(f"{path}/split={name}/part=target")
    return path


def read_split(spark: SparkSession, path: str, split: str, part: str) -> DataFrame:
    """Load one of the four parts from its folder."""
    return spark.read.parquet(f"{path}/split={split}/part={part}")


def train_and_evaluate(
    spark: SparkSession,
    features_path: str,
    base: str,
    date_range: str,
    test_share: float = 0.2,
    exact: bool = False,
    **forest_params,
) -> dict[str, str]:
    """M1-M4 + K6 + K8; returns the written locations."""
    feats = read_features(spark, features_path)
    train, test = split(feats, test_share, exact=exact)
    model = ML.fit(train, **forest_params)
    model_path = ML.save(model, CSV.object_path(base, "model", date_range))
    scored = ML.score(model, test)
    metrics_path = CSV.write_csv(
        ML.regression_metrics(scored), CSV.object_path(base, "model-metrics", date_range)
    )
    return {"model": model_path, "metrics": metrics_path}


def run(spark: SparkSession, readings: DataFrame, weather: DataFrame, base: str, day: dt.date, **forest_params) -> dict[str, str]:
    """All three stages for the two weeks ending on ``day``."""
    path, date_range = prepare(spark, readings, weather, base, day)
    out = {"features": path}
    out.update(publish_metrics(spark, path, base, date_range))
    out.update(train_and_evaluate(spark, path, base, date_range, **forest_params))
    return out


__all__ = ["prepare", "publish_metrics", "train_and_evaluate", "run", "read_features"]

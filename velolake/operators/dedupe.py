"""K1: keyed upsert - for every key the row with the highest ingest
sequence wins (the store's last-write-wins ``put``).

Written as an aggregate, not as ``row_number()`` over a window: the
``max(struct(seq, payload))`` combines inside each map task, so a key that
holds a third of all rows is reduced before the shuffle instead of being
sorted whole by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake.session import checkpoint_root


def latest_per_key(df: DataFrame, keys: Sequence[str], seq: str, unique_seq: bool = False) -> DataFrame:
    """One row per ``keys``: the row with the largest ``seq`` (rows with a
    null ``seq`` only win when the key has no other row).

    ``unique_seq=True`` promises that ``seq`` is non-null and unique within a
    key (an ingest sequence).  Then every payload column is taken with
    ``max_by(col, seq)``, which picks the same row; for fixed-width columns
    that runs as a hash aggregate instead of the sort-based aggregate a
    struct buffer needs.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys and c != seq]
    if unique_seq:
        aggs = [F.max(seq).alias(seq)] + [F.max_by(c, seq).alias(c) for c in payload]
        return df.groupBy(*keys).agg(*aggs).select(*keys, seq, *payload)
    best = F.max(F.struct(F.col(seq).alias(seq), *[F.col(c).alias(c) for c in payload])).alias("_w")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in [seq, *payload]])


def merge_latest(existing: DataFrame, updates: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Upsert ``updates`` into ``existing`` (same columns): union by name,
    then last write wins per key."""
    return latest_per_key(existing.unionByName(updates), keys, seq)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> str:
    """Overwrite only the partitions present in ``df`` (dynamic partition
    overwrite), so an upsert of one day rewrites that day only."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .format(fmt)
        .save(path)
    )
    return path


def upsert_into(
    spark,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    seq: str,
    date_col: str,
) -> str:
    """K1 against a stored table partitioned by ``date_col``: only the days
    present in ``updates`` are read (partition pruning), merged with the
    updates (last write wins per key) and rewritten (dynamic partition
    overwrite); all other days are untouched.

    The merged rows are checkpointed into the session's shared checkpoint
    folder first: the table cannot be overwritten while the plan still
    reads it, and the checkpoint also cuts the lineage.  The list of days is
    collected to the driver - one value per day, bounded by the calendar.
    """
    checkpoint_root(spark)
    updates = updates.checkpoint(eager=True)  # read twice: for its days and for the merge
    days = [r[0] for r in updates.select(date_col).distinct().collect()]
    # a null day is a partition too, and overwritten like the others
    touched = F.col(date_col).isin([d for d in days if d is not None])
    if None in days:
        touched = touched | F.col(date_col).isNull()
    try:
        existing = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        existing = None  # no table yet
    if existing is not None:
        if date_col not in existing.columns:
            raise ValueError(f"the table at {path} has no column {date_col}")
        existing = existing.where(touched)
    merged = updates if existing is None else existing.unionByName(updates)
    merged = latest_per_key(merged, [*keys, date_col], seq)
    return write_partitions(merged.checkpoint(eager=True), path, [date_col])

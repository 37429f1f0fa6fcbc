"""Helpers shared by the text operators: inputs, row identity, scratch tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from velolake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder.  Only a
    plain local session that names none (tests) gets a temporary folder."""
    sc = spark.sparkContext
    unset = not sc.getCheckpointDir() and not sc.getConf().get("spark.checkpoint.dir", None)
    if unset and sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="velolake-llm-"))
    return scratch_path(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared space and read it back:
    the lineage cut.  A lost executor costs a re-read, not a recomputation."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so a task holds few texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column has it (Spark
    compares names without regard to case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def replaced(df: DataFrame, columns: dict) -> DataFrame:
    """``df`` with ``columns`` added; columns of the same name give way."""
    names = {c.lower() for c in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names], *[v.alias(k) for k, v in columns.items()])


def extended(df: DataFrame, schema: StructType) -> tuple[list[str], StructType]:
    """Columns kept of ``df`` and the schema with ``schema``'s fields added;
    input columns whose names clash with the new fields give way."""
    names = {f.name.lower() for f in schema.fields}
    kept = [c for c in df.columns if c.lower() not in names]
    return kept, StructType([df.schema[c] for c in kept] + schema.fields)


TOTALS_IN = 16  # tasks in which the totals of all tasks meet


def task_totals(df: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], width: int) -> np.ndarray:
    """Sum of the vectors of ``width`` whole numbers that ``count`` gives,
    one a task.  The vectors first meet in ``TOTALS_IN`` tasks, which add them
    up as they come, so the driver gets that many at most however many tasks
    there are."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([count(batches).astype("<i8").tobytes()], pa.binary())], names=["total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(width, np.int64), False
        for batch in slices(batches, 1):
            for x in batch.column(0):
                total += np.frombuffer(x.as_py(), "<i8")
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["total"])

    parts = df.mapInArrow(each, "total binary").repartition(TOTALS_IN).mapInArrow(add, "total binary")
    return sum((np.frombuffer(r.total, "<i8") for r in parts.collect()), np.zeros(width, np.int64))


BROADCAST_ENTRIES = 1 << 20  # numbers or short texts that a join sends to all executors
SALTS = 16  # parts that a key's rows are dealt over where the other side is larger


def with_one(left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "left", entries: Column | None = None) -> DataFrame:
    """``left`` joined to ``right``, which has one row a key.  A key may hold
    much of ``left``: a right side of counted size (its rows, or the sum of
    ``entries``) is broadcast, a larger one meets a key's rows in ``SALTS``
    parts, dealt by the column ``spread``."""
    size = right.count() if entries is None else right.agg(F.sum(entries)).first()[0] or 0
    if size <= BROADCAST_ENTRIES:
        return left.join(F.broadcast(right), key, how)
    salt = free_name(left.columns + right.columns, "salt")
    many = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(many, [key, salt], how).drop(salt)

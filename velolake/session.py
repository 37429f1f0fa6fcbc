"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings that matter for correctness regardless of cluster size.
CORRECTNESS_CONF = {
    # Naive timestamps are UTC wall-clock; keep conversions stable.
    "spark.sql.session.timeZone": "UTC",
}

# Settings that matter for scale.  On a cluster these come from the job
# config; ``build_session`` only fills them in when they are unset.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state (dedupe keys, open windows) kept off-heap in RocksDB
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "velolake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    ``master``/``shuffle_partitions`` are only meant for local runs; on a
    cluster leave them ``None`` so the deployment's values win.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf.update(CORRECTNESS_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in CORRECTNESS_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    When the session has none (a unit test, a laptop) and ``fallback`` is
    given, it is installed as the checkpoint dir.  Without either we refuse
    to guess: a machine-local temp folder is wrong on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if fallback is None:
        fallback = os.environ.get("VELOLAKE_CHECKPOINT_DIR")
    if not fallback:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder "
            "(or pass a fallback in local tests)"
        )
    sc.setCheckpointDir(fallback)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/velolake/{name}-{uuid.uuid4().hex}"


def at_once(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What independent steps return that run side by side; an error of one is
    raised when all have ended."""
    given = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(steps)) as pool:
        waiting = [pool.submit(given(step) if callable(given) else step) for step in steps]
    return [step.result() for step in waiting]

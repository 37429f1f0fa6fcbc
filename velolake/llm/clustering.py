"""Centroid clustering with Orchard's search.

Vectors are turned into whole numbers, ``floor(SCALE * x)``, so sums, means
(rounded down) and squared distances are exact and no order of rows matters.
The first centroids are the vectors whose ids hash lowest.  Each round assigns
all vectors and moves every centroid that got some to their mean.

The nearest centroid is found by Orchard's search.  Each centroid has a list
of the others, nearest first.  A vector walks the list of its best centroid so
far; a centroid met for the first time is measured, and if it is nearer, the
walk goes on at the start of that one's list.  It ends when the next entry is
strictly further from the best centroid than twice the vector is: by the
triangle inequality no later one can be nearer or as near.  At the same
distance the smaller number is better.  A batch of vectors walks together, one
step of each at a time.

A round gathers one vector of sums a task (``task_totals``); the driver holds
the centroids only.

Defined cases: a vector that is null, of another length, or holds a null or
non-finite component takes no part and gives no row; repeated rows count each;
an id may repeat or be null (hashed as empty text); fewer vectors than
centroids make fewer clusters; two equal centroids leave the larger number
empty, which stays where it is; components whose distances could leave 64 bits
raise an error; input columns named like the added ones give way; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from velolake.llm.common import extended, free_name, replaced, slices, stored, task_totals

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
BATCH = 1 << 14  # vectors that walk together


# ---------------------------------------------------------------------------
# Search
# ---------------------------------------------------------------------------
def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each centroid the others from near to far, and all distances."""
    between = ((centroids[:, None] - centroids[None]) ** 2).sum(2)
    own = between - np.eye(len(centroids), dtype=np.int64)  # itself comes first
    return np.argsort(own, axis=1, kind="stable")[:, 1:], between


def nearest(vectors: np.ndarray, centroids: np.ndarray, lists: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each vector's nearest centroid, and how
    many distances were measured."""
    n, k = len(vectors), len(centroids)
    best = np.zeros(n, np.int64)
    least = ((vectors - centroids[0]) ** 2).sum(1)
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    at = np.zeros(n, np.int64)  # place in the list of the best one
    walking, measured = np.arange(n if k > 1 else 0), n
    while len(walking):
        other = lists[best[walking], at[walking]]
        near = between[best[walking], other] <= 4 * least[walking]
        walking, other = walking[near], other[near]
        at[walking] += 1
        new = ~seen[walking, other]
        who, other = walking[new], other[new]
        seen[who, other] = True
        far = ((vectors[who] - centroids[other]) ** 2).sum(1)
        measured += len(who)
        better = (far < least[who]) | ((far == least[who]) & (other < best[who]))
        who = who[better]
        best[who], least[who], at[who] = other[better], far[better], 0
        walking = walking[at[walking] < k - 1]
    return best, least, measured


# ---------------------------------------------------------------------------
# Vectors
# ---------------------------------------------------------------------------
def whole_vectors(df: DataFrame, vector: str, column: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """Rows with a usable vector, and it as whole numbers in ``column``."""
    v = F.col(f"`{vector}`")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    limit = math.isqrt((1 << 59) // dimensions)  # four times a squared distance fits 64 bits

    def whole(x):
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) < limit, y).otherwise(F.raise_error(F.lit(f"a component of {limit // scale} or more")).cast("long"))

    usable = df.where(v.isNotNull() & (F.size(v) == dimensions) & ~F.exists(v, bad))
    return usable.withColumn(column, F.transform(v, whole))


def matrices(batches: Iterator[pa.RecordBatch], place: int, dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in slices(batches, BATCH):
        if batch.num_rows:
            yield batch, batch.column(place).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def first_centroids(vectors: DataFrame, id_col: str, column: str, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ids hash lowest (of one id, by components)."""
    ident = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    h = F.sha2(F.concat(F.lit(f"{seed}:"), ident), 256)
    rows = vectors.select(h.alias("h"), F.col(f"`{column}`").alias("v")).orderBy("h", "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64)


def moved(vectors: DataFrame, column: str, centroids: np.ndarray) -> np.ndarray:
    """One round: the means of the vectors that are nearest to each centroid."""
    k, dimensions = centroids.shape
    lists, between = neighbour_lists(centroids)

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((k, dimensions + 1), np.int64)
        for _, x in matrices(batches, 0, dimensions):
            cluster = nearest(x, centroids, lists, between)[0]
            np.add.at(total, cluster, np.concatenate([x, np.ones((len(x), 1), np.int64)], 1))
        return total.ravel()

    total = task_totals(vectors.select(F.col(f"`{column}`")), count, k * (dimensions + 1)).reshape(k, dimensions + 1)
    return np.where(total[:, -1:] > 0, total[:, :-1] // np.maximum(total[:, -1:], 1), centroids)


ASSIGNED = StructType([StructField("cluster", IntegerType()), StructField("distance", LongType())])


def assigned(vectors: DataFrame, column: str, centroids: np.ndarray) -> DataFrame:
    """Rows with their ``cluster`` and ``distance``, without ``column``."""
    lists, between = neighbour_lists(centroids)
    kept, schema = extended(vectors.drop(column), ASSIGNED)
    places = {c: k for k, c in enumerate(vectors.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in matrices(batches, places[column], centroids.shape[1]):
            cluster, distance, _ = nearest(x, centroids, lists, between)
            yield pa.RecordBatch.from_arrays([batch.column(places[c]) for c in kept] + [pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=schema.names)

    return vectors.mapInArrow(run, schema)


def clustered(
    df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """Rows that take part with ``cluster`` and ``distance``; the centroids."""
    column = free_name(df.columns, "whole_vector")
    vectors = stored(whole_vectors(df, vector, column, dimensions, scale), "vectors")
    centroids = first_centroids(vectors, id_col, column, clusters, seed)
    if not len(centroids):
        centroids = np.zeros((1, dimensions), np.int64)  # of no vectors
    for _ in range(rounds):
        centroids = moved(vectors, column, centroids)
    return assigned(vectors, column, centroids), centroids


def with_inertia(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``cluster_inertia``, ``inertia`` and ``centroid_sha256`` beside each
    row of :func:`clustered`; one row a cluster is broadcast."""
    rows = stored(rows, "assigned")
    inertia = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    schema = StructType(
        [StructField("cluster", IntegerType()), StructField("cluster_inertia", LongType()), StructField("inertia", LongType()), StructField("centroid_sha256", StringType())]
    )
    of_cluster = [(k, inertia.get(k, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids.tolist())]
    side = rows.sparkSession.createDataFrame(of_cluster, schema)
    number = free_name(rows.columns, "cluster_number")
    joined = rows.join(F.broadcast(side.select(F.col("cluster").alias(number), F.struct(*schema.names[1:]).alias(number + "_s"))), F.col("cluster") == F.col(number))
    return replaced(joined, {n: F.col(f"{number}_s.{n}") for n in schema.names[1:]}).drop(number, number + "_s")


def digest(embeddings: DataFrame) -> DataFrame:
    """Per vector: its cluster and distance, inertias, its centroid's hash."""
    return with_inertia(*clustered(embeddings.select("vec_id", "embedding"))).drop("embedding")


def oracle() -> str:
    """The digest in SQL: all distances of each round."""
    finite = "x IS NOT NULL AND isfinite(x)"

    def assignment(k: int) -> str:
        return f"""
a{k} AS (
  SELECT r, vec_id, v, arg_min(c, (d, c)) AS cluster, min(d) AS distance
  FROM (SELECT r, vec_id, v.v AS v, m.c, list_sum([(v.v[i] - m.v[i]) * (v.v[i] - m.v[i]) FOR i IN range(1, {DIMENSIONS + 1})])::BIGINT AS d FROM v, c{k} m)
  GROUP BY r, vec_id, v)"""

    def move(k: int) -> str:
        return f"""
s{k} AS (SELECT cluster, i, floor(sum(v[i])::DOUBLE / count(*))::BIGINT AS x FROM a{k}, range(1, {DIMENSIONS + 1}) t(i) GROUP BY cluster, i),
c{k + 1} AS (SELECT c, coalesce((SELECT list(x ORDER BY i) FROM s{k} WHERE cluster = c), v) AS v FROM c{k})"""

    rounds = ",".join(assignment(k) + "," + move(k) for k in range(ROUNDS))
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len([x FOR x IN embedding IF {finite}]) = {DIMENSIONS}),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id), v) - 1 AS c, v FROM v ORDER BY c LIMIT {CLUSTERS}),{rounds},{assignment(ROUNDS)}
SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} m ON c = cluster"""

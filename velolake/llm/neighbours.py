"""Approximate nearest neighbours by balanced posting lists (inner product).

Vectors are lifted by one coordinate, the root of M^2 - |x|^2 (M: the largest
norm), so the nearest by distance to a lifted query is the largest inner
product.  Centroids are fitted on a bounded sample; every vector is indexed:
it goes to the list of its nearest centroid and, as a boundary vector, to
the lists of other centroids nearly as near.
Centroids are searched in memory through a graph of their neighbours.  A
query reads the lists whose centroid is at most a ratio farther than its
nearest one.  The ratio is the smallest one that finds ``RECALL`` of the true
neighbours of a sample of the queries, which are searched by brute force: it
is measured on the table itself, whatever its size.

Lists of centroids near each other are a bundle, and bundles are kept
balanced by splitting: a large one (say, with a list full of copies of a
vector) is dealt out over blocks by a hash of the id, and a query that reads
a list of the bundle reads that list in all blocks.  The queries of
a bundle are dealt out in the same way.  Each (bundle, block of vectors, block
of queries) is one group of work; it gives the best ``k`` of the lists'
vectors for each of its queries, and a last step keeps the best over groups.  A query reads the
bundle of its nearest list first; the others then give only what scores at
least as high as the ``k``-th found there, as nothing else can be among the
best.  Where the lists within the ratio hold fewer than ``k`` vectors, a
query reads on, list by list, until they hold enough.

Defined cases: vectors that are null, zero, of another length than most
(of equally many, than the longest) or hold null or non-finite components take no part (neither as query nor as
candidate); equal scores go to the smaller id; of rows with one id
the best counts, and a query never finds rows of its own id; a null id takes
no part; fewer candidates than ``k`` give fewer rows; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from velolake.llm.common import stored

K = 20
MAX_SAMPLE = 20_000  # vectors that the centroids are fitted on
LIST_SIZE = 400  # vectors that a list holds on average
MAX_LISTS = 4096
BUNDLE = 16  # lists that are worked on together
BLOCK = 8192  # vectors that a block of a bundle holds on average
ITERATIONS = 8
REPLICAS = 4  # lists that a boundary vector may be in
BOUNDARY = 1.1  # of the nearest distance: how far they may be
READ = 1.25  # of the nearest distance: how far a query's lists may be, where no query is there to measure it
RECALL = 0.97  # of the true neighbours of the sampled queries, which the ratio must find
ASKED = 4096  # queries that a block of a bundle's queries holds on average
MEASURED = 200  # queries that the ratio is measured on
DEGREE = 24  # neighbours of a centroid in the graph
BEAM = 64


# ---------------------------------------------------------------------------
# Centroids
# ---------------------------------------------------------------------------
def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c**2).sum(1) / 2
    return np.concatenate([(x[i : i + 4096] @ c.T - half).argmax(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def fit_centroids(sample: np.ndarray, lists: int, seed: int = 5) -> np.ndarray:
    """Lloyd's iterations from distinct sampled vectors; a cluster that is
    far over the mean gives its place's neighbours to empty ones."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    c = distinct[rng.permutation(len(distinct))[: max(1, min(lists, len(distinct)))]]
    for _ in range(ITERATIONS):
        own = _nearest(sample, c)
        n = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, sample)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
        empty, full = np.flatnonzero(n == 0), np.argsort(-n)
        for e, f in zip(empty, full):
            members = np.flatnonzero(own == f)
            c[e] = sample[members[rng.integers(len(members))]]
    return c


class CentroidGraph:
    """Centroids and a graph of their neighbours, searched best-first from a
    few entries; both directions of a link are kept."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        self.half = (centroids**2).sum(1) / 2
        n = len(centroids)
        links: list[set[int]] = [set() for _ in range(n)]
        for i in range(0, n, 1024):
            s = centroids[i : i + 1024] @ centroids.T - self.half
            near = np.argsort(-s, axis=1, kind="stable")[:, : DEGREE + 1]
            for r, row in enumerate(near):
                for j in row:
                    if j != i + r:
                        links[i + r].add(int(j))
                        links[int(j)].add(i + r)
        # a ring over all centroids keeps the graph in one piece
        for i in range(n):
            if n > 1:
                links[i].add((i + 1) % n)
                links[(i + 1) % n].add(i)
        self.links = [np.array(sorted(x), np.int64) for x in links]
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 64)).astype(int))

    def search(self, x: np.ndarray, beam: int = BEAM, ratio: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and distances of the centroids found near ``x``, nearest
        first.  The beam holds the nearest ones and all within ``ratio`` of
        the nearest; it is walked until all of it has been looked around."""
        norm = (x**2).sum()
        seen = np.zeros(len(self.c), bool)
        ids, score = self.entries, self.c[self.entries] @ x - self.half[self.entries]
        seen[ids] = True
        done: set[int] = set()
        while True:
            order = np.argsort(-score, kind="stable")
            near = norm - 2 * score[order] <= ratio**2 * max(norm - 2 * score[order[0]], 0.0)
            order = order[: max(beam, int(near.sum()))]
            ids, score = ids[order], score[order]
            todo = [i for i in ids.tolist() if i not in done][:8]
            if not todo:
                break
            done.update(todo)
            new = np.unique(np.concatenate([self.links[i] for i in todo]))
            new = new[~seen[new]]
            seen[new] = True
            ids, score = np.concatenate([ids, new]), np.concatenate([score, self.c[new] @ x - self.half[new]])
        return ids, np.sqrt(np.maximum(0.0, norm - 2 * score))

    def lists_of(self, x: np.ndarray) -> list[int]:
        """Lists of a vector: the nearest, and those within ``BOUNDARY`` of
        it, ``REPLICAS`` in all at most.  None is left out for being near to
        another: in many dimensions centroids are nearer to each other than
        vectors are to them."""
        ids, far = self.search(x, 16)
        return ids[far <= BOUNDARY * far[0] + 1e-12][:REPLICAS].tolist()

    def ratio_to(self, x: np.ndarray, lists: np.ndarray) -> float:
        """The ratio at which a query reads the nearest of ``lists``."""
        far = np.sqrt(np.maximum(0.0, (x**2).sum() - 2 * (self.c @ x - self.half)))
        return float(min(1e6, far[lists].min() / max(far.min(), 1e-12)))

    def read_for(self, x: np.ndarray, held: np.ndarray, needed: int, ratio: float = READ) -> list[int]:
        """Lists a query reads: those within ``ratio`` of its nearest, and
        more until their own vectors (``held``) are as many as needed."""
        ids, far = self.search(x, ratio=ratio)
        near = ids[far <= ratio * far[0] + 1e-12]
        if held[near].sum() < needed:
            order = np.argsort(self.half - self.c @ x, kind="stable")
            enough = np.searchsorted(np.cumsum(held[order]), needed) + 1
            near = np.union1d(near, order[:enough])
        return near.tolist()


# ---------------------------------------------------------------------------
# The index
# ---------------------------------------------------------------------------
def valid(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """Ids and vectors (as doubles) that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("vec"))
        .where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
        .where(~bad & F.exists("vec", lambda x: x != 0))
    )


FOUND = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])


def _part(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, vectors and the lists of the bundle each is in (or reads), as bits."""
    bits = np.array([sum(1 << (int(x) % BUNDLE) for x in lists) for lists in rows["lists"]], np.int64)
    return rows["id"].to_numpy(), np.array(rows["vec"].tolist(), float), bits


def _best(vectors: tuple, queries: tuple, floor: np.ndarray, k: int) -> pd.DataFrame:
    """The best ``k`` of the vectors in the lists that each query reads, as
    far as they reach its ``floor``:
    scores by matrix product find those that can be among them, sums row by
    row rank them, so equal vectors score the same wherever they stand."""
    (ids, x, lists), (qids, q, reads) = vectors, queries
    out_q, out_v, out_s = [], [], []
    reach = np.abs(x).max(0)
    for at in range(0, len(qids), 256):
        rough = q[at : at + 256] @ x.T
        for r in range(len(rough)):
            seen = np.flatnonzero((lists & reads[at + r] != 0) & (ids != qids[at + r]))
            s = rough[r][seen]
            if len(s) > k:
                slack = 1e-9 * (1 + np.abs(q[at + r]) @ reach)
                near = seen[s >= np.partition(s, len(s) - k)[len(s) - k] - slack]
            else:
                near = seen
            exact = (x[near] * q[at + r]).sum(1)
            near, exact = near[exact >= floor[at + r]], exact[exact >= floor[at + r]]
            order = np.lexsort((ids[near], -exact))[:k]
            out_q.append(np.full(len(order), qids[at + r]))
            out_v.append(ids[near][order])
            out_s.append(exact[order])
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})


def true_neighbours(base: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """(query, vec_id) of the ``k`` best for each row of ``q``, by brute force:
    each task keeps its best, so it gives at most ``k`` rows a query."""
    shared = base.sparkSession.sparkContext.broadcast((ids, q))  # MEASURED vectors
    schema = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, q = shared.value
        best_id, best = np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                vec_id = part.column(0).to_numpy(zero_copy_only=False)
                score = q @ np.array(part.column(1).flatten(), float).reshape(-1, q.shape[1]).T
                score[own[:, None] == vec_id[None, :]] = -np.inf
                best_id = np.concatenate([best_id, np.broadcast_to(vec_id, score.shape)], 1)
                best = np.concatenate([best, score], 1)
                if best.shape[1] > k:
                    keep = np.argpartition(-best, k - 1, axis=1)[:, :k]
                    best_id, best = np.take_along_axis(best_id, keep, 1), np.take_along_axis(best, keep, 1)
        r, c = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(best_id[r, c], pa.int64()), pa.array(best[r, c], pa.float64())], names=schema.names)

    return best_of(base.select("id", "vec").mapInArrow(run, schema), k).select("query_id", "vec_id")


def read_ratio(base: DataFrame, asked: DataFrame, index: DataFrame, graph: CentroidGraph, lift, k: int) -> float:
    """The smallest ratio at which the sampled queries find ``RECALL`` of
    their true neighbours in ``index``."""
    sample = asked.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(MEASURED).collect()
    if not sample:
        return READ
    q = np.array([r.vec for r in sample], float)
    true = true_neighbours(base, np.array([r.id for r in sample], np.int64), q, k)  # at most MEASURED * k rows
    places = index.select(F.col("id").alias("vec_id"), F.explode("lists").alias("list")).join(F.broadcast(true), "vec_id")
    # a vector is in REPLICAS lists at most
    rows = places.groupBy("query_id", "vec_id").agg(F.collect_set("list").alias("lists")).collect()
    needed = [graph.ratio_to(lift(q[r.query_id]), np.array(r.lists)) for r in rows]
    return float(np.quantile(needed, RECALL, method="higher")) * (1 + 1e-9) if needed else READ


def search(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, vec_id, score): each query's ``k`` best of ``df`` as found."""
    spark = df.sparkSession
    base = stored(valid(df, id_col, vector), "ann-vectors")
    asked = valid(queries, id_col, vector)
    facts = base.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).collect()
    if not facts:
        return spark.createDataFrame([], FOUND)
    main = max(facts, key=lambda r: (r.n, r.d))
    n, d, m = main.n, main.d, main.m
    base, asked = base.where(F.size("vec") == d), asked.where(F.size("vec") == d)
    share = min(1.0, 1.2 * MAX_SAMPLE / n)
    drawn = base.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = np.array([r.vec for r in drawn.orderBy(F.xxhash64("id"), "id").limit(MAX_SAMPLE).select("vec").collect()], float).reshape(-1, d)

    def lifted(x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(0.0, m - (x**2).sum(1)))[:, None]], 1)

    lists = int(min(MAX_LISTS, max(1, n // LIST_SIZE)))
    centroids = fit_centroids(lifted(sample), lists) if len(sample) else np.zeros((1, d + 1))
    # lists with near centroids get neighbouring numbers, so a bundle's lists are read together
    centroids = centroids[np.argsort(_nearest(centroids, fit_centroids(centroids, -(-len(centroids) // BUNDLE))), kind="stable")]
    graph = CentroidGraph(centroids)
    # at most MAX_LISTS centroids and their links, whatever the table's size
    shared = spark.sparkContext.broadcast(graph)
    placed = StructType(
        [StructField("bundle", IntegerType()), StructField("lists", ArrayType(IntegerType())), StructField("first", BooleanType()),
         StructField("id", LongType()), StructField("vec", ArrayType(DoubleType()))]
    )

    def bundled(lists: list[int]) -> list[tuple[int, list[int]]]:
        out: dict[int, list[int]] = {}
        for x in lists:
            out.setdefault(x // BUNDLE, []).append(x)
        return list(out.items())

    def place(pick):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g = shared.value
            for batch in batches:
                x = np.array(batch.column(1).flatten(), float).reshape(-1, d)
                rows = [(r, *b) for r, row in enumerate(x) for b in pick(g, row)]
                take, bundle, lists, first = zip(*rows) if rows else ((), (), (), ())
                where = pa.array(take, pa.int64())
                columns = [pa.array(bundle, pa.int32()), pa.array(lists, pa.list_(pa.int32())), pa.array(first, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*columns, batch.column(0).take(where), batch.column(1).take(where)], names=placed.names)

        return run

    def by_vector(g, row):  # a vector once in each bundle; ``first`` marks its nearest list's
        lists = g.lists_of(np.append(row, np.sqrt(max(0.0, m - (row**2).sum()))))
        return [(b, x, lists[0] in x) for b, x in bundled(lists)]

    index = stored(base.mapInArrow(place(by_vector), placed), "ann-index")
    # one row per list: at most MAX_LISTS
    held = np.zeros(len(graph.c), np.int64)
    for r in index.where("first").groupBy(F.get("lists", F.lit(0)).alias("list")).agg(F.count(F.lit(1)).alias("n")).collect():
        held[r.list] = r.n

    def asking(row):  # only a query's direction matters; lifted by 0
        return np.append(row * (np.sqrt(m) / max(np.sqrt((row**2).sum()), 1e-300)), 0.0)

    ratio = read_ratio(base, asked, index, graph, asking, k)

    def by_query(g, row):  # ``first`` marks the bundle of the nearest list read
        lists = np.array(g.read_for(asking(row), held, min(k + 1, int(held.sum())), ratio))
        nearest = lists[(g.c[lists] @ asking(row) - g.half[lists]).argmax()] // BUNDLE
        return [(b, x, bool(b == nearest)) for b, x in bundled(lists.tolist())]

    counts = index.groupBy("bundle").agg(F.count(F.lit(1)).alias("n")).collect()  # fewer rows than lists
    sizes = F.broadcast(spark.createDataFrame([(r.bundle, -(-r.n // BLOCK)) for r in counts], "bundle int, blocks int"))
    blocks = index.join(sizes, "bundle").select("bundle", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "lists", "id", "vec")
    wanted = stored(asked.mapInArrow(place(by_query), placed), "ann-queries")

    def compare(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(queries):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        return _best(_part(vectors), _part(queries), queries["floor"].to_numpy(float), k)

    def found(asking: DataFrame) -> DataFrame:
        # one row per bundle: fewer than lists
        many = asking.groupBy("bundle").agg(F.count(F.lit(1)).alias("n")).collect()
        parts = F.broadcast(spark.createDataFrame([(r.bundle, -(-r.n // ASKED)) for r in many], "bundle int, parts int"))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        work = asking.join(sizes, "bundle").join(parts, "bundle")
        work = work.select("bundle", every("blocks").alias("block"), F.pmod(F.xxhash64("id", F.lit(9)), F.col("parts")).cast("int").alias("part"), "lists", "id", "vec", "floor")
        held = blocks.join(parts, "bundle").select("bundle", "block", every("parts").alias("part"), "lists", "id", "vec")
        group = ["bundle", "block", "part"]
        return held.groupBy(*group).cogroup(work.groupBy(*group)).applyInPandas(compare, FOUND)

    lowest = F.lit(float("-inf"))
    near = stored(best_of(found(wanted.where("first").withColumn("floor", lowest)), k), "ann-near").drop("rank")
    full = near.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    rest = wanted.where(~F.col("first")).join(full.select(F.col("query_id").alias("id"), "floor"), "id", "left")
    return best_of(near.union(found(rest.withColumn("floor", F.coalesce("floor", lowest)))), k)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query's findings, each vector once.  A query
    has at most ``k`` findings from each group that it reads."""
    each = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    top = each.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("top")
    )
    return top.select("query_id", F.posexplode("top").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score")
    )


def digest(embeddings: DataFrame, k: int = K) -> DataFrame:
    """The neighbours of each row whose id is divisible by 20."""
    return search(embeddings, embeddings.where("vec_id % 20 = 0"), k=k)

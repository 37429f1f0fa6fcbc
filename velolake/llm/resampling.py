"""Importance resampling towards a target, ranked by regular sampling.

Texts are bags of hashed features (runs of one to three words).  A bucket's
gain is the log of how much likelier the target draws it than the corpus, a
document's weight the sum of its features' gains, and with Gumbel noise from a
hash of its id the documents of the highest scores are a sample without
replacement.

* Weights.  Two passes over the texts: one adds up the counts of all features
  (a vector a task), one looks up gains in an array.
* Ranks, by parallel sorting by regular sampling.  Each task sorts its keys
  into a run.  Keys at regular steps of the runs are gathered, and of these,
  again at regular steps, the splitters are taken.  Segments of the runs
  between splitters are counted; their prefix counts give each range its first
  rank and tell how many ranges hold the rows to draw.  Only segments of these
  are exchanged; a range's sorted segments are merged (numpy's stable sort is
  a timsort, which merges runs), and position plus first rank is the rank.

Keys are (score from the highest, id, row number): the row number makes them
differ, so repeated rows are split like any others, and a range holds about
``STEPS`` steps.  A step is ``STEP`` rows, or more where the driver would get
over ``SAMPLES`` keys.  The sampled keys only say where to cut; ranks come
from counts of all rows.

Defined cases: a null text has no words; texts under ``MIN_WORDS`` words get a
weight and a score but are never drawn; an empty table gives an empty result,
an empty target gains from its smoothing alone; a null id is hashed as empty
text and comes last among equal scores, rows of one id and score stand in any
order, with ranks of their own; input columns named like the added ones give
way; texts of any length are read whole, ``CHUNK`` bytes at a time.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from velolake.llm.common import extended, free_name, slices, stored, task_totals

BUCKETS = 10_000
MIN_WORDS = 20
SEED = 42
CHUNK = 1 << 20
STEP = 1024  # rows of a run from one sampled key to the next
SAMPLES = 1 << 20
STEPS = 8  # sampled keys a range
LAST = 2**63 - 1  # stands for a null id

_WORD, _GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")


# ---------------------------------------------------------------------------
# Features
# ---------------------------------------------------------------------------
def features(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of a text's features, ``CHUNK`` bytes of text at a time.  The
    checksum of a longer run goes on from that of the shorter one."""
    data = (text or "").encode("utf-8").lower()  # of bytes: A-Z alone
    one: list[int] = []  # of the word before, and of the two before
    two: list[int] = []
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + CHUNK)  # a chunk ends where a word does
        end = gap.start() if gap else len(data)
        words = _WORD.findall(data, at, end)
        at = end
        if not words:
            continue
        spaced = [b" " + w for w in words]
        ones = list(map(crc32, words))
        before = one + ones[:-1]
        twos = list(map(crc32, spaced[len(words) - len(before) :], before))
        before = two + twos[:-1]
        threes = list(map(crc32, spaced[len(words) - len(before) :], before))
        one, two = ones[-1:], twos[-1:]
        yield np.array(ones + twos + threes, np.int64) % BUCKETS


def bucket_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total, waiting, size = np.zeros(BUCKETS, np.int64), [], 0
        for batch in slices(batches):
            for x in batch.column(0).to_pylist():
                for found in features(x):
                    waiting.append(found)
                    size += len(found)
                    if size > CHUNK:
                        total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
                        waiting, size = [], 0
        return total + np.bincount(np.concatenate(waiting), minlength=BUCKETS) if waiting else total

    return task_totals(df.select(F.col(f"`{text}`").cast("string")), count, BUCKETS)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, 1000 times the log of the smoothed shares' ratio, down
    to a whole number."""
    all_s, all_t = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(ident: int | None, seed: int = SEED) -> int:
    """Gumbel noise of an id, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORES = StructType([StructField(n, LongType()) for n in ("n_features", "weight", "score")])


def scored(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``df`` with ``n_features``, ``weight`` and ``score``."""
    kept, schema = extended(df, SCORES)
    places = {c: k for k, c in enumerate(df.columns)}
    ident, source, keep = places[id_col], places[text], [places[c] for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for i, x in zip(batch.column(ident).to_pylist(), batch.column(source).to_pylist()):
                n = weight = 0
                for found in features(x):
                    n += len(found)
                    weight += int(gain[found].sum())
                rows.append((n, weight, weight + noise(i, seed)))
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [pa.array(c, pa.int64()) for c in columns], names=schema.names)

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# Ranks
# ---------------------------------------------------------------------------
def encoded(batch: pa.RecordBatch) -> np.ndarray:
    """Keys of three whole numbers as byte strings of the same order."""
    parts = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for k in range(3)]
    return np.stack(parts, 1).astype(">u8").view("S24").ravel()


def sampled_keys(runs: DataFrame, step: int) -> np.ndarray:
    """Keys at regular steps of the sorted runs, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0  # rows of the run before this batch
        for batch in batches:
            n = batch.num_rows
            chosen = np.arange((step // 2 - at) % step, n, step)
            yield pa.RecordBatch.from_arrays([pa.array(encoded(batch)[chosen].tolist(), pa.binary())], names=["key"])
            at += n

    rows = runs.mapInArrow(run, "key binary").collect()  # one a step
    return np.sort(np.array([bytes(r.key) for r in rows], "S24"))


def range_counts(runs: DataFrame, splitters: np.ndarray) -> np.ndarray:
    """Rows of each range: of the segments that the splitters cut."""
    width = len(splitters) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += np.bincount(np.searchsorted(splitters, encoded(batch), side="left"), minlength=width)
        return total

    return task_totals(runs, count, width)


def ranks(keys: DataFrame, rows: int, draw: int, step: int = STEP) -> DataFrame:
    """(last key column, rank) of the ``draw`` smallest of ``rows`` keys, each
    three columns of whole numbers, none twice.  ``keys`` should be stored."""
    spark, last = keys.sparkSession, keys.columns[2]
    schema = StructType([StructField(last, LongType()), StructField("rank", LongType())])
    if not draw:
        return spark.createDataFrame([], schema)
    runs = stored(keys.sortWithinPartitions(*keys.columns), "sorted-runs")
    step = max(step, -(-rows // SAMPLES))
    found = sampled_keys(runs, step)
    # splitters up to where the drawn rows end by the samples, with room; if
    # the exact counts say that was too short, up to the end
    ahead = draw // step * 3 // 2 + 2 * STEPS
    splitters = found[STEPS - 1 : ahead : STEPS]
    counts = range_counts(runs, splitters)
    if counts[:-1].sum() < draw and ahead < len(found):
        splitters = found[STEPS - 1 :: STEPS]
        counts = range_counts(runs, splitters)
    first = np.cumsum(counts) - counts
    ranges = int(np.searchsorted(first, draw, side="left"))  # those that start before the end

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = np.searchsorted(splitters, encoded(batch), side="left")
            on = np.flatnonzero(where < ranges)
            if len(on):
                cut = batch.take(pa.array(on))
                yield pa.RecordBatch.from_arrays([*cut.columns, pa.array(where[on], pa.int32())], names=["a", "b", "c", "part"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = [], []
        for batch in batches:
            held.append(encoded(batch))
            ids.append(batch.column(2).to_numpy(zero_copy_only=False))
        if held:
            key, ident = np.concatenate(held), np.concatenate(ids)
            order = np.argsort(key, kind="stable")
            where = np.searchsorted(splitters, key[order], side="left")
            rank = first[where] + np.arange(len(key)) - np.searchsorted(where, where, side="left") + 1
            on = rank <= draw
            yield pa.RecordBatch.from_arrays([pa.array(ident[order][on], pa.int64()), pa.array(rank[on], pa.int64())], names=schema.names)

    cut = runs.mapInArrow(segments, "a long, b long, c long, part int")
    return cut.repartitionById(ranges, "part").mapInArrow(merge, schema)


def resampled(
    df: DataFrame, target: DataFrame, percent: int = 5, id_col: str = "doc_id", text: str = "text", target_text: str = "text", seed: int = SEED
) -> DataFrame:
    """``df`` with ``n_features``, ``weight``, ``score`` and ``rank``: that of
    the rows drawn, ``percent`` of those with ``MIN_WORDS`` words, else null."""
    gain = gains(bucket_counts(df, text), bucket_counts(target, target_text))
    return drawn(scored(df, gain, id_col, text, seed), percent, id_col)


def drawn(scores: DataFrame, percent: int = 5, id_col: str = "doc_id") -> DataFrame:
    """Rows of :func:`scored` with their ``rank``."""
    row = free_name(scores.columns, "row")
    scores = scores.drop("rank")
    items = stored(scores.withColumn(row, F.monotonically_increasing_id()), "scores")
    able = items.where(F.col("n_features") >= 3 * MIN_WORDS - 3)  # what 20 words have
    rows = able.count()
    keys = able.select((-F.col("score")).alias("a"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("b"), F.col(row))
    return items.join(ranks(keys, rows, rows * percent // 100), row, "left").drop(row)


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: features, weight, score and, if drawn, its rank."""
    gain = gains(bucket_counts(documents), bucket_counts(benchmark))
    # the texts are not needed any more
    return drawn(scored(documents.select("doc_id", "text"), gain).drop("text"))


# crc32 by halves of bytes, from its polynomial
_TABLE = []
for _i in range(16):
    for _ in range(4):
        _i = _i >> 1 ^ (0xEDB88320 if _i & 1 else 0)
    _TABLE.append(_i)


def oracle() -> str:
    """The digest in SQL: features as joined words, their checksums by halves
    of bytes, ranks by a window."""
    table = ", ".join(map(str, _TABLE))

    def bags(name: str, key: str, source: str) -> str:
        return f"""
{name}_words AS (
  SELECT {key} AS k, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM {source}),
{name}_runs AS (
  SELECT k, r, unnest(list_concat(w, list_concat(
    [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))],
    [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]))) AS f
  FROM {name}_words),
{name}_bags AS (SELECT k, r, f, count(*) AS n FROM {name}_runs GROUP BY ALL)"""

    step = f"xor(c >> 4, ([{table}])[((xor(c, x) & 15) + 1)::INT])"
    return f"""
WITH {bags('d', 'doc_id', 'documents')}, {bags('t', 'item_id', 'benchmark')},
hexed AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM (SELECT f FROM d_bags UNION ALL SELECT f FROM t_bags)),
hashed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT],
    [(instr('0123456789ABCDEF', h[i + 2 - 2 * (i % 2)]) - 1)::BIGINT FOR i IN range(0, length(h))]),
    lambda c, x: {step}), 4294967295::BIGINT) % {BUCKETS} AS bucket FROM hexed),
s AS (SELECT bucket, sum(n) AS n FROM d_bags JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM t_bags JOIN hashed USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS})::DOUBLE
    / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS})::DOUBLE)))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM d_bags JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY r),
scores AS (
  SELECT k AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(k::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d_words LEFT JOIN weights USING (r)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS p, (SELECT 5 * count(*) // 100 FROM scores WHERE n_words >= {MIN_WORDS}) AS k
  FROM scores WHERE n_words >= {MIN_WORDS})
SELECT s.doc_id, n_features, weight, score, CASE WHEN p <= k THEN p END AS rank FROM scores s LEFT JOIN ranked USING (doc_id)"""

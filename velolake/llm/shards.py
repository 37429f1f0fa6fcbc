"""Sharding by sampled splitters.

Records are ordered by a key: the 64-bit hash of the text, then the id, so
equal texts are neighbours.  A sample drawn with weights by size gives
quantile boundaries that cut the key space into ranges of about equal bytes.
Counts of every range follow; a range that turns out overfull (a large group
of copies, whose hash no boundary of the sample splits finely enough) is
sampled again by itself and subdivided.  Records are then range-partitioned,
ranked within their range, and put into shards by the exact bytes before
them.  Each shard is one stretch of the key order.

Law: ``bytes``.  A record goes where the middle of its stretch of bytes
falls, so a shard's size is off the mean by one record at most, or by
``GROUP_SHARE`` of a shard where a small group of equal texts is kept whole.

Everything is Spark's own expressions.  The driver sees a bounded sample and
one row per range and per shard.

Defined cases: a null text has no bytes and the checksum of the empty text;
null ids come first in their group; repeated rows are records of their own;
more shards than records leave shards empty; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velolake.llm.common import free_name, stored

OVERHEAD = 16  # bytes that each record has besides its text
RANGES_PER_SHARD = 4
ROWS_PER_RANGE = 4_000_000
MAX_RANGES = 1024
DRAWS_PER_RANGE = 32
OVERFULL = 2  # times the mean range
ROUNDS = 4  # of subdividing
GROUP_SHARE = 0.02  # of a shard: equal texts up to this stay together

Boundary = tuple[int, int | None, int]


def keyed(df: DataFrame, id_col: str = "doc_id", text: str = "text", row: Column | None = None) -> DataFrame:
    """Id, size, checksum, key and number of each record.  The number parts
    rows that are equal in all else; the rows must be stored with it."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return df.select(
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(t) + OVERHEAD).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("crc"),
        F.xxhash64(t).alias("key"),
    )


def _below(b: Boundary) -> Column:
    """Whether a record comes before a boundary."""
    key, ident, row = b
    before, same = F.col("key") < F.lit(key), F.col("key") == F.lit(key)
    none, earlier = F.col("id").isNull(), F.col("row") < F.lit(row)
    if ident is None:
        return before | (same & none & earlier)
    return before | (same & (none | (F.col("id") < F.lit(ident)) | ((F.col("id") == F.lit(ident)) & earlier)))


def range_of(boundaries: list[Boundary], first: int = 0) -> Column:
    """Number of the range a record falls in: a balanced tree of comparisons."""
    if not boundaries:
        return F.lit(first)
    mid = len(boundaries) // 2
    return F.when(_below(boundaries[mid]), range_of(boundaries[:mid], first)).otherwise(range_of(boundaries[mid + 1 :], first + mid + 1))


def _order(b: Boundary) -> tuple:
    return (b[0], b[1] is not None, b[1] or 0, b[2])


def _quantiles(drawn: list, parts: int, least: float) -> list[Boundary]:
    """Boundaries that cut a weighted sample into ``parts`` equal shares.  A
    record drawn for certain weighs its size, the others ``least``."""
    drawn = sorted((((r.key, r.id, r.row), max(r.size, least)) for r in drawn), key=lambda x: _order(x[0]))
    total, upto, out = sum(w for _, w in drawn), 0.0, []
    for at, weight in drawn:
        if upto * parts >= total * (len(out) + 1) and (not out or at != out[-1]):
            out.append(at)
        upto += weight
        if len(out) + 1 >= parts:
            break
    return out


def splitters(records: DataFrame, shards: int) -> tuple[list[Boundary], list]:
    """Boundaries of the ranges, and the rows and bytes of each range."""
    total = records.agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).first()
    if not total.rows:
        return [], []
    ranges = min(MAX_RANGES, max(shards * RANGES_PER_SHARD, -(-total.rows // ROWS_PER_RANGE)))
    uniform = F.pmod(F.xxhash64("key", "id", "row", F.lit(17)), F.lit(1 << 52)) / F.lit(float(1 << 52))

    def draw(rows: DataFrame, size: int, parts: int) -> list[Boundary]:
        each = size / (parts * DRAWS_PER_RANGE)
        return _quantiles(rows.where(uniform * each < F.col("size")).select("key", "id", "row", "size").collect(), parts, each)

    bounds = draw(records, total.size, ranges)
    for turn in range(ROUNDS + 1):
        got = records.groupBy(range_of(bounds).alias("range")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
        over = [r for r in got if r.rows > 1 and (r.size > OVERFULL * total.size / ranges or r.rows > OVERFULL * total.rows / ranges)]
        if not over or turn == ROUNDS:
            return bounds, got
        more: list[Boundary] = []
        for r in over:
            parts = min(MAX_RANGES, 1 + max(r.size * ranges // total.size, r.rows * ranges // total.rows))
            more += draw(records.where(range_of(bounds) == r.range), r.size, parts)
        new = sorted({*bounds, *more}, key=_order)
        if len(new) == len(bounds):
            return bounds, got
        bounds = new
    return bounds, got


def assign(df: DataFrame, shards: int, id_col: str = "doc_id", text: str = "text", row: Column | None = None) -> DataFrame:
    """Per record of ``df``: id, size, crc, key, row, shard, slot."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    records = stored(keyed(df, id_col, text, row), "shard-keys")
    bounds, got = splitters(records, shards)
    total, rows = sum(r.size for r in got), 0
    before: dict[int, tuple[int, int]] = {}
    upto = 0
    for r in sorted(got, key=lambda r: r.range):
        before[r.range] = (upto, rows)
        upto, rows = upto + r.size, rows + r.rows
    spark = df.sparkSession
    # one row per range: at most a few thousand
    offsets = F.broadcast(spark.createDataFrame([(k, a, b) for k, (a, b) in before.items()], "range int, bytes_before long, rows_before long"))
    order = [F.col("key"), F.col("id").asc_nulls_first(), F.col("row")]
    within = Window.partitionBy("range").orderBy(*order)
    group = Window.partitionBy("range", "key")
    ranked = (
        records.withColumn("range", range_of(bounds))
        .withColumn("row", F.row_number().over(within).cast("long"))
        .withColumn("upto", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("group_size", F.sum("size").over(group))
        .withColumn("group_start", F.min(F.col("upto") - F.col("size")).over(group))
        .join(offsets, "range")
    )
    whole = F.col("group_size") <= int(GROUP_SHARE * total / shards)
    twice = F.when(whole, 2 * F.col("group_start") + F.col("group_size")).otherwise(2 * F.col("upto") - F.col("size"))
    middle = 2 * F.col("bytes_before") + twice
    placed = stored(
        ranked.select(
            "id", "size", "crc", "key", "row",
            F.least(F.floor(middle * shards / F.lit(2.0 * max(total, 1))), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("row") - 1).alias("place"),
        ),
        "shard-places",
    )
    # one row per shard
    first = F.broadcast(placed.groupBy("shard").agg(F.min("place").alias("first")))
    return placed.join(first, "shard").select("id", "size", "crc", "key", "row", "shard", (F.col("place") - F.col("first")).alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, id_col: str = "doc_id", text: str = "text") -> str:
    """Write the records of ``df`` to one folder per shard, where ``assign``
    puts them: a row's shard is a comparison with the shards' first records.
    Returns the name of the column that the folders are named by: ``shard``,
    with underscores in front if ``df`` has that."""
    row, shard = (free_name(df.columns, n) for n in ("row", "shard"))
    numbered = stored(df.withColumn(row, F.monotonically_increasing_id()), "shard-rows")
    placed = assign(numbered, shards, id_col, text, F.col(row))
    firsts = sorted(placed.where("slot = 0").select("shard", "key", "id", "row").collect(), key=lambda r: r.shard)  # one row per shard
    bounds = [(r.key, r.id, r.row) for r in firsts][1:]
    numbers = F.array(*[F.lit(r.shard) for r in firsts]) if firsts else F.array(F.lit(0))
    key = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    # the columns are one while the shard is found: no name can clash
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    named = numbered.select(whole.alias("_record"), key.alias("key"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{row}`").alias("row"))
    found = named.select("_record", F.get(numbers, range_of(bounds)).alias("_shard"), F.pmod(F.xxhash64("row"), F.lit(16)).alias("_part"))
    dealt = found.repartition("_shard", "_part")
    dealt.select(*[F.col(f"_record.`{c}`").alias(c) for c in df.columns], F.col("_shard").alias(shard)).write.partitionBy(shard).parquet(path)
    return shard


def digest(documents: DataFrame, shards: int = 40) -> DataFrame:
    """Per document: size, checksum, law, shard, slot."""
    return assign(documents.select("doc_id", "text"), shards).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )

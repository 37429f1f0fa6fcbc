"""A10, A5 and A1 by increments: state per day, stored, merged for any window.

The metrics of a window are computed again and again from days that do not
change.  Here each day is read once and leaves three small tables, written by
day:

* ``pack`` - rows, stations, temperatures and poll slots of each kind and day
  (the grouping sets of the metrics pack, before any of them is decided);
* ``moments`` - per kind, day and null pattern the number of rows, every
  column's mean and the co-moments about these means;
* ``sketch`` - a HyperLogLog sketch of the stations of each kind and day.

A window is merged from the days it holds alone (partition pruning).  Pack
rows are summed and decided; co-moments of several days are brought to their
common mean: ``C = sum(C_d) + sum(n_d (m_d - m)(m_d - m)')``, so neither the
size of a column's mean nor its distance from another group's costs digits.
Sketches are united.  Nothing here grows with the readings: pack rows are
bounded by stations, distinct temperatures and slots of a day.

A day that is written again (a late upsert) overwrites its own partition.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import columns as C
from velolake.operators.correlation import _value
from velolake.operators.dedupe import write_partitions
from velolake.operators.joins import checked_broadcast
from velolake.operators.metrics import clean

DAY = "readingDate"
SKETCH_BITS = 12  # 2^12 registers: a standard error of 1.04 / 64, 1.6 %
TABLES = ("pack", "moments", "sketch")


# ---------------------------------------------------------------------------
# One day's state
# ---------------------------------------------------------------------------
def pack_state(df: DataFrame, by: Sequence[str] = ("kind",), ts: str = "timestamp", slot_minutes: int | None = 10) -> DataFrame:
    """Per group, day and item (``what``: rows, station, temperature, slot)
    the rows and their first time.  Items that are null are left out."""
    keys = [*by, DAY]
    base = df.select(
        *keys, F.col("stationId").alias("station"), F.when(F.col(ts).isNotNull(), clean("Temperature")).alias("temperature"),
        (C.slot_floor(ts, slot_minutes) if slot_minutes else F.col(ts)).alias("slot"), F.col(ts).alias("_t"),
    )
    items = ["station", "temperature", "slot"]
    sets = [keys, *[[*keys, i] for i in items]]
    parts = base.groupingSets(sets, *keys, *items).agg(F.count(F.lit(1)).alias("n"), F.min("_t").alias("firstTime"), F.grouping_id().alias("_g"))
    gid = {i: 0b111 ^ (0b100 >> k) for k, i in enumerate(items)}
    what = F.when(F.col("_g") == 0b111, "rows")
    for i in items:
        what = what.when((F.col("_g") == gid[i]) & F.col(i).isNotNull(), i)
    return parts.withColumn("what", what).where("what IS NOT NULL").select(*keys, "what", *items, "n", "firstTime")


def moment_state(df: DataFrame, columns: Sequence[str] = tuple(S.CORRELATION_COLUMNS), by: Sequence[str] = ("kind",)) -> DataFrame:
    """Per group, day and null pattern: ``n``, means ``m<i>``, co-moments
    ``c<i>_<j>`` and extremes.  Sums are taken of deviations from the group's
    mean of the day (one row a group and day, broadcast once its size is
    known)."""
    keys, k = [*by, DAY], len(columns)
    values = df.selectExpr(*[f"`{b}`" for b in keys], *[f"{_value(c)} AS x{i}" for i, c in enumerate(columns)])
    finite = lambda i: f"CASE WHEN abs(x{i}) < double('infinity') THEN x{i} END"
    means = values.groupBy(*keys).agg(*[F.expr(f"coalesce(avg({finite(i)}), 0D)").alias(f"p{i}") for i in range(k)])
    pilots, _ = checked_broadcast(means)
    same = None
    for b in keys:
        on = F.col(f"v.{b}").eqNullSafe(F.col(f"p.{b}"))
        same = on if same is None else same & on
    joined = values.alias("v").join(pilots.alias("p"), same)
    mask = " + ".join(f"CASE WHEN x{i} IS NULL THEN {1 << i}L ELSE 0L END" for i in range(k))
    rows = joined.selectExpr(*[f"v.`{b}`" for b in keys], *[f"p{i}" for i in range(k)], *[f"x{i} - p{i} AS d{i}" for i in range(k)], *[f"x{i}" for i in range(k)], f"{mask} AS mask")
    sums = ["count(1) AS n"]
    for i in range(k):
        sums += [f"first(p{i}) AS p{i}", f"sum(d{i}) AS s{i}", f"min(x{i}) AS lo{i}", f"max(x{i}) AS hi{i}"]
    sums += [f"sum(d{i} * d{j}) AS q{i}_{j}" for i, j in combinations_with_replacement(range(k), 2)]
    grouped = rows.groupBy(*keys, "mask").agg(*[F.expr(e) for e in sums])
    out = [f"p{i} + s{i} / n AS m{i}" for i in range(k)] + [f"lo{i}" for i in range(k)] + [f"hi{i}" for i in range(k)]
    out += [f"q{i}_{j} - s{i} * s{j} / n AS c{i}_{j}" for i, j in combinations_with_replacement(range(k), 2)]
    return grouped.selectExpr(*[f"`{b}`" for b in keys], "mask", "n", *out)


def sketch_state(df: DataFrame, by: Sequence[str] = ("kind",), station: str = "stationId", bits: int = SKETCH_BITS) -> DataFrame:
    """Per group and day a sketch of its stations."""
    return df.groupBy(*by, DAY).agg(F.hll_sketch_agg(station, F.lit(bits)).alias("sketch"))


def update_state(features: DataFrame, path: str, days: Iterable[dt.date] | None = None, by: Sequence[str] = ("kind",)) -> str:
    """Write the state of ``days`` (all days of ``features`` by default) below
    ``path``; other days stay as they are.  ``features`` has the column
    ``readingDate``; where it is stored by it, only these days are opened."""
    if days is not None:
        features = features.where(F.col(DAY).isin(list(days)))
    states = {"pack": pack_state(features, by), "moments": moment_state(features, by=by), "sketch": sketch_state(features, by)}
    for name in TABLES:
        write_partitions(states[name], f"{path.rstrip('/')}/{name}", [DAY])
    return path


def read_state(spark: SparkSession, path: str, name: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """One of the tables for the days from ``start`` to before ``end``."""
    rows = spark.read.parquet(f"{path.rstrip('/')}/{name}")
    if start is not None:
        rows = rows.where(F.col(DAY) >= F.lit(start))
    return rows if end is None else rows.where(F.col(DAY) < F.lit(end))


# ---------------------------------------------------------------------------
# Merged windows
# ---------------------------------------------------------------------------
def merged_pack(state: DataFrame, by: Sequence[str] = ("kind",)) -> DataFrame:
    """The metrics pack of a window from its days."""
    items = ["station", "temperature", "slot"]
    whole = state.groupBy(*by, "what", *items).agg(F.sum("n").alias("n"), F.min("firstTime").alias("t"))
    on = lambda what: F.col("what") == what
    warm = F.min(F.when(on("temperature"), F.struct((-F.col("temperature")).alias("v"), "t")))
    cold = F.min(F.when(on("temperature"), F.struct(F.col("temperature").alias("v"), "t")))
    busy = F.min(F.when(on("slot"), F.struct((-F.col("n")).alias("v"), "slot")))
    return whole.groupBy(*by).agg(
        F.sum(F.when(on("rows"), F.col("n"))).alias("rows"), F.count_if(on("station")).alias("numStations"),
        F.max(F.when(on("temperature"), F.col("temperature"))).alias("warmestTemperature"), F.min(F.when(on("temperature"), F.col("temperature"))).alias("coldestTemperature"),
        warm.getField("t").alias("warmestDay"), cold.getField("t").alias("coldestDay"), busy.getField("slot").alias("busiestTime"),
    )


def merged_correlation(state: DataFrame, columns: Sequence[str] = tuple(S.CORRELATION_COLUMNS), by: Sequence[str] = ("kind",)) -> DataFrame:
    """``(by..., colA, colB, corr)`` of a window from its days, as
    :func:`correlation.correlation_long` gives it."""
    keys, k = [f"`{b}`" for b in by], len(columns)
    cells = ", ".join(
        f"named_struct('i', {i}, 'j', {j}, 'a', m{i}, 'b', m{j}, 'aa', c{i}_{i}, 'bb', c{j}_{j}, 'ab', c{i}_{j}, 'la', lo{i}, 'ha', hi{i}, 'lb', lo{j}, 'hb', hi{j})"
        for i, j in combinations_with_replacement(range(k), 2)
    )
    both = state.selectExpr(*keys, "mask", "n", f"inline(array({cells}))").where("(mask & (shiftleft(1L, i) | shiftleft(1L, j))) = 0")
    # a pair's rows are the days' patterns with both columns: a few per day
    pair, n = [*by, "i", "j"], F.col("n").cast("double")
    of_pair = Window.partitionBy(*pair)
    # the common mean: the least of the days' means and the weighted distance from it
    both = both.withColumns({"pa": F.min("a").over(of_pair), "pb": F.min("b").over(of_pair), "all": F.sum(n).over(of_pair)})
    shift = {f"d{x}": F.col(x) - F.col(f"p{x}") for x in ("a", "b")}
    both = both.withColumns(shift)
    both = both.withColumns({d: F.col(d) - F.sum(n * F.col(d)).over(of_pair) / F.col("all") for d in shift})
    da, db = F.col("da"), F.col("db")
    total: dict[str, Column] = {"aa": F.col("aa") + n * da * da, "bb": F.col("bb") + n * db * db, "ab": F.col("ab") + n * da * db}
    merged = both.groupBy(*pair).agg(
        F.sum("n").alias("n"), *[F.sum(c).alias(name) for name, c in total.items()],
        F.min("la").alias("la"), F.max("ha").alias("ha"), F.min("lb").alias("lb"), F.max("hb").alias("hb"),
    )
    raw = "try_divide(ab, sqrt(greatest(aa, 0D)) * sqrt(greatest(bb, 0D)))"
    corr = f"CASE WHEN n >= 2 AND la < ha AND lb < hb THEN CASE WHEN i = j THEN 1D ELSE greatest(-1D, least(1D, {raw})) END END AS corr"
    turned = "explode(CASE WHEN i = j THEN array(named_struct('x', i, 'y', j)) ELSE array(named_struct('x', i, 'y', j), named_struct('x', j, 'y', i)) END) AS p"
    names = "array(" + ", ".join(f"'{c}'" for c in columns) + ")"
    ways = merged.selectExpr(*keys, corr, turned)
    return ways.selectExpr(*keys, f"element_at({names}, p.x + 1) AS colA", f"element_at({names}, p.y + 1) AS colB", "corr")


def merged_stations(state: DataFrame, by: Sequence[str] = ("kind",)) -> DataFrame:
    """Stations of a window as its days' sketches estimate them, with the
    estimate's standard error."""
    error = 1.04 / 2 ** (SKETCH_BITS / 2)
    whole = state.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"), F.count(F.lit(1)).alias("days"))
    estimate = F.hll_sketch_estimate("sketch")
    return whole.select(*by, "days", estimate.alias("stations"), (estimate * error).alias("standardError"))

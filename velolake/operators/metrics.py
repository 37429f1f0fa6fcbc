"""Dashboard metrics over the feature table.

Every metric is a hash aggregate keyed by ``by`` (default: the station
``kind``), so Spark combines map-side before the shuffle: a kind or station
that holds a third of all rows is reduced inside each map task and never
reaches one reducer whole.  Tie-breaks that need a composite ordering
(earliest timestamp at the extreme temperature, earliest busiest slot) run
on a pre-aggregated table whose size is bounded by the number of distinct
values, not by the number of readings.

Means are exact: values are quantised to the source precision and summed as
integers (bigint), and the one division happens in double at the end.  The
result therefore does not depend on partitioning or row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import columns as C


def _by(by: Sequence[str] | str | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def clean(col: str | Column) -> Column:
    """NaN -> null, so ``min``/``max``/sums skip it as pandas does."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(~F.isnan(c), c)


INTEGERS = ("tinyint", "smallint", "int", "bigint")


def mean_of(df: DataFrame, col: str) -> Column:
    """Mean of the non-null values of ``df``'s column.  Whole numbers are
    summed exactly and divided once; other types have a plain average."""
    if dict(df.dtypes)[col] in INTEGERS:
        return F.sum(F.col(col).cast("decimal(38,0)")).cast("double") / F.count(col)
    return F.avg(clean(col))


# A1 -------------------------------------------------------------------------
def distinct_stations(df: DataFrame, by=("kind",), station: str = "stationId") -> DataFrame:
    """Number of distinct stations (two-level aggregate: partial by
    ``by`` + station, then count)."""
    return df.groupBy(*_by(by)).agg(F.count_distinct(station).alias("numStations"))


# A2 -------------------------------------------------------------------------
def temperature_extremes(df: DataFrame, by=("kind",), col: str = "Temperature") -> DataFrame:
    return df.groupBy(*_by(by)).agg(
        F.max(clean(col)).alias("warmestTemperature"),
        F.min(clean(col)).alias("coldestTemperature"),
    )


# A3 -------------------------------------------------------------------------
def extreme_days(
    df: DataFrame, by=("kind",), col: str = "Temperature", ts: str = "timestamp"
) -> DataFrame:
    """Timestamp of the warmest and of the coldest reading; among tied
    readings the earliest timestamp wins.

    Step 1 reduces to one row per (group, temperature) with the earliest
    timestamp - a hash aggregate with map-side combine.  Step 2 picks the
    extremes on that small table.
    """
    keys = _by(by)
    per_value = (
        df.where(clean(col).isNotNull() & F.col(ts).isNotNull())
        .groupBy(*keys, F.col(col).alias("_v"))
        .agg(F.min(ts).alias("_t"))
    )
    return per_value.groupBy(*keys).agg(
        F.min(F.struct((-F.col("_v")).alias("v"), F.col("_t").alias("t"))).getField("t").alias("warmestDay"),
        F.min(F.struct(F.col("_v").alias("v"), F.col("_t").alias("t"))).getField("t").alias("coldestDay"),
    )


# A4 -------------------------------------------------------------------------
def busiest(
    df: DataFrame, bucket: Column, by=("kind",), name: str = "busiestTime"
) -> DataFrame:
    """The ``bucket`` value with the most rows (ties: the smallest bucket).

    The count per (group, bucket) is a partial hash aggregate; the arg-max
    runs on the counted table (one row per bucket)."""
    keys = _by(by)
    counted = df.where(bucket.isNotNull()).groupBy(*keys, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("negN"), F.col("_b").alias("b")))
    return counted.groupBy(*keys).agg(
        best.getField("b").alias(name), (-best.getField("negN")).alias("readings")
    )


def busiest_timestamp(df: DataFrame, by=("kind",), ts: str = "timestamp", slot_minutes: int | None = 10) -> DataFrame:
    """The poll time with the most readings.  Readings of one poll share a
    timestamp; with ``slot_minutes`` raw times are first put into their
    poll slot (the poll interval)."""
    bucket = C.slot_floor(ts, slot_minutes) if slot_minutes else F.col(ts)
    return busiest(df, bucket, by, "busiestTime")


def busiest_day(df: DataFrame, by=("kind",), ts: str = "timestamp") -> DataFrame:
    """The calendar day with the most readings."""
    return busiest(df, F.to_date(ts), by, "busiestDay")


# A6 -------------------------------------------------------------------------
def weekend_vs_weekday(
    df: DataFrame, by=("kind",), value: str = "AvailableBikes", flag: str = "IsWeekend"
) -> DataFrame:
    """Mean ``value`` on weekdays and on weekends, labelled."""
    keys = _by(by)
    return df.groupBy(*keys, flag).agg(mean_of(df, value).alias("meanAvailableBikes")).select(
        *keys, C.weekend_label(flag).alias("dayType"), "meanAvailableBikes"
    )


# A7 -------------------------------------------------------------------------
HOURLY_MEANS = ("Humidity", "Wind_Speed", "Temperature")


def hourly_resample(
    df: DataFrame,
    by=("kind",),
    ts: str = "timestamp",
    means: Sequence[str] = HOURLY_MEANS,
    sums: Sequence[str] = (S.LABEL,),
) -> DataFrame:
    """Hourly series per group: mean of ``means``, sum of ``sums``; every
    hour between the group's first and last reading is present (gap hours:
    mean null, sum 0), as a calendar resample emits them.

    One pass: the aggregate is partial/final by (group, hour); gap hours are
    then filled on that aggregated table (one row per hour that has data):
    each hour row also emits the empty hours up to the group's next hour
    with data (``lead`` over the group's hours, bounded by the time span).
    No second scan of the readings, no join.
    """
    keys = _by(by)
    hour = C.hour_floor(ts)
    agg = df.where(F.col(ts).isNotNull()).groupBy(*keys, hour.alias("hour")).agg(
        *[mean_of(df, m).alias(m) for m in means],
        *[F.sum(s).alias(s) for s in sums],
    )
    step = F.expr("INTERVAL 1 HOUR")
    nxt = F.lead("hour").over(Window.partitionBy(*keys).orderBy("hour"))
    upto = F.coalesce(F.col("_next") - step, F.col("hour"))
    filled = agg.withColumn("_next", nxt).withColumn("_h", F.explode(F.sequence(F.col("hour"), upto, step)))
    present = F.col("_h") == F.col("hour")
    return filled.select(
        *keys,
        F.col("_h").alias("hour"),
        *[F.when(present, F.col(m)).alias(m) for m in means],
        *[F.when(present, F.col(s)).otherwise(F.lit(0)).cast("long").alias(s) for s in sums],
    )


# A8 -------------------------------------------------------------------------
def date_range(df: DataFrame, by=("kind",), ts: str = "timestamp") -> DataFrame:
    """F6 + A8: first and last day (``yyyy-MM-dd``) of the rows with a
    timestamp, and the folder name ``{first}-{last}``."""
    keys = _by(by)
    r = df.where(F.col(ts).isNotNull()).groupBy(*keys).agg(
        F.date_format(F.min(ts), "yyyy-MM-dd").alias("minDate"),
        F.date_format(F.max(ts), "yyyy-MM-dd").alias("maxDate"),
    )
    return r.withColumn("rangeName", F.concat("minDate", F.lit("-"), "maxDate"))  # null without rows


def station_positions(df: DataFrame, station: str = "stationId") -> DataFrame:
    """Every distinct position of every station with its readings."""
    return df.groupBy(station, "Lat", "Long").agg(F.count(F.lit(1)).alias("readings"))


# A9 / F7 --------------------------------------------------------------------
def station_profile(
    df: DataFrame,
    station: str = "stationId",
    value: str = S.LABEL,
    only: str | None = None,
) -> DataFrame:
    """Per station: min / max / mean of ``value``, the number of distinct
    positions and their bounding box.  ``only`` restricts to one station
    (F7, pushed into the scan as an equality filter).

    Positions are counted, not collected: a free-floating bike reports a
    new position with every reading, so a position list would grow with
    the data."""
    if only is not None:
        df = df.where(F.col(station) == F.lit(only))
    return df.groupBy(station).agg(
        F.min(value).alias("minBikes"),
        F.max(value).alias("maxBikes"),
        mean_of(df, value).alias("meanBikes"),
        F.count_distinct("Lat", "Long").alias("positions"),
        F.min("Lat").alias("minLat"),
        F.max("Lat").alias("maxLat"),
        F.min("Long").alias("minLong"),
        F.max("Long").alias("maxLong"),
    )


# A11 ------------------------------------------------------------------------
def poll_counts(df: DataFrame, ts: str = "timestamp", slot_minutes: int | None = 10) -> DataFrame:
    """Readings per poll (per poll slot when ``slot_minutes`` is set)."""
    bucket = C.slot_floor(ts, slot_minutes) if slot_minutes else F.col(ts)
    return df.groupBy(bucket.alias("pollTime")).agg(F.count(F.lit(1)).alias("readings"))


# A10 ------------------------------------------------------------------------
def metrics_pack(df: DataFrame, by=("kind",), ts: str = "timestamp", slot_minutes: int | None = 10) -> DataFrame:
    """The scalar dashboard metrics of each group in one row (A1-A4, A10).
    Without ``slot_minutes`` the busiest time is a raw timestamp.

    One scan: a single ``GROUPING SETS`` aggregate (Expand + partial/final
    hash aggregate) counts rows per group, per (group, station), per
    (group, temperature) and per (group, poll slot), keeping the earliest
    timestamp.  Each grouping set is small (stations, distinct temperatures,
    slots); the metrics are then picked from that table in one more
    aggregate keyed by the group.
    """
    keys = _by(by)
    temp = clean("Temperature")
    slot = C.slot_floor(ts, slot_minutes) if slot_minutes else F.col(ts)
    base = df.select(
        *keys,
        F.col("stationId").alias("_st"),
        F.when(F.col(ts).isNotNull(), temp).alias("_v"),
        slot.alias("_b"),
        F.col(ts).alias("_t"),
    )
    sets = [keys, [*keys, "_st"], [*keys, "_v"], [*keys, "_b"]]
    parts = base.groupingSets(sets, *keys, "_st", "_v", "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_t"), F.grouping_id().alias("_g")
    )
    extra = len(["_st", "_v", "_b"])
    gid = {name: ((1 << extra) - 1) ^ (1 << (extra - 1 - i)) for i, name in enumerate(["_st", "_v", "_b"])}
    is_rows = F.col("_g") == (1 << extra) - 1
    is_st = (F.col("_g") == gid["_st"]) & F.col("_st").isNotNull()
    is_v = (F.col("_g") == gid["_v"]) & F.col("_v").isNotNull()
    is_b = (F.col("_g") == gid["_b"]) & F.col("_b").isNotNull()
    warm = F.min(F.when(is_v, F.struct((-F.col("_v")).alias("v"), F.col("_t").alias("t"))))
    cold = F.min(F.when(is_v, F.struct(F.col("_v").alias("v"), F.col("_t").alias("t"))))
    busy = F.min(F.when(is_b, F.struct((-F.col("_n")).alias("negN"), F.col("_b").alias("b"))))
    return parts.groupBy(*keys).agg(
        F.sum(F.when(is_rows, F.col("_n"))).alias("rows"),
        F.count(F.when(is_st, F.lit(1))).alias("numStations"),
        F.max(F.when(is_v, F.col("_v"))).alias("warmestTemperature"),
        F.min(F.when(is_v, F.col("_v"))).alias("coldestTemperature"),
        warm.getField("t").alias("warmestDay"),
        cold.getField("t").alias("coldestDay"),
        busy.getField("b").alias("busiestTime"),
    )

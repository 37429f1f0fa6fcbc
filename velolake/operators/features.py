"""Feature derivation on readings."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import columns as C
from velolake.operators.joins import join_weather

log = logging.getLogger(__name__)


def with_timestamp(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """P3 + P5: ``Time`` -> ``timestamp`` when absent; text is parsed, bad
    text becomes null."""
    if "Time" in df.columns and ts not in df.columns:
        df = df.withColumnRenamed("Time", ts)
    if dict(df.dtypes).get(ts) == "string":
        df = df.withColumn(ts, C.coerce_timestamp(ts))
    return df


def with_calendar(df: DataFrame, ts: str = "timestamp", time_of_day: bool = False) -> DataFrame:
    """Year, Month, Day, Hour, Minute (and Time_of_Day) from ``ts``."""
    cal = C.calendar_columns(ts)
    if not time_of_day:
        cal.pop("Time_of_Day")
    return df.withColumns(cal)


def with_weekend(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """``IsWeekend`` 0/1; passthrough with a warning without ``ts``."""
    if ts not in df.columns:
        log.warning("no %s column: IsWeekend not derived", ts)
        return df
    return df.withColumn("IsWeekend", C.weekend_flag(ts))


def with_bike_count(df: DataFrame, col: str = "BikeIds") -> DataFrame:
    """``TotalAvailableBikes`` = number of ids in the list literal."""
    if col not in df.columns:
        log.warning("no %s column: TotalAvailableBikes not derived", col)
        return df
    return df.withColumn(S.LABEL, C.literal_list_length(col))


def with_kind(df: DataFrame, station: str = "stationId") -> DataFrame:
    """F4 as a column: ``single_bikes`` for ids starting with ``BIKE``."""
    return df.withColumn(
        "kind",
        F.when(F.col(station).startswith(S.SINGLE_BIKE_PREFIX), F.lit(S.KIND_SINGLE)).otherwise(
            F.lit(S.KIND_STATION)
        ),
    )


def single_bikes(df: DataFrame, station: str = "stationId") -> DataFrame:
    """free-floating bikes."""
    return df.where(F.col(station).startswith(S.SINGLE_BIKE_PREFIX))


def stationary(df: DataFrame, station: str = "stationId") -> DataFrame:
    """docked stations (null ids belong to neither side, as in pandas)."""
    return df.where(~F.col(station).startswith(S.SINGLE_BIKE_PREFIX))


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """drop rows with a null (or NaN) in ``subset`` / any column."""
    return df.dropna(how="any", subset=subset)


def impute_visibility(df: DataFrame, value: float = S.VISIBILITY_FILL) -> DataFrame:
    """Missing (null or NaN) Visibility -> ``value``."""
    return df.withColumn("Visibility", F.col("Visibility").cast("double")).fillna({"Visibility": value})


def select_features(df: DataFrame, features: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """P10: the model columns in model order (aliases such as ``Windspeed``
    are accepted); ``keep`` adds row keys in front."""
    features = features or S.MODEL_FEATURES
    cols = []
    for f in features:
        name = S.COLUMN_ALIASES.get(f, f)
        cols.append(F.col(name).alias(name))
    return df.select(*(keep or []), *cols)


def split_target(df: DataFrame, label: str = S.LABEL, key: str = "readingId") -> tuple[DataFrame, DataFrame]:
    """``(target, features)``, both keyed by ``key`` instead of row order."""
    return df.select(key, label), df.drop(label)


def enrich(joined: DataFrame) -> DataFrame:
    """P8 + P7 on the joined table (the order of the preprocessing stage)."""
    return with_weekend(with_bike_count(joined))


def unread_lists(readings: DataFrame) -> DataFrame:
    """P8's set-aside: readings whose list of bikes is missing or does not
    parse, which the feature table drops."""
    return readings.where(C.literal_list_length("BikeIds").isNull())


def build_features(readings: DataFrame, weather: DataFrame, **join_kw) -> DataFrame:
    """J2 -> P9 -> P8 -> P7: the feature table.

    The surveyed stage left-joins and then drops every row with a null;
    unmatched readings have null weather, so that equals an inner join
    followed by the same null drop - written as such, the planner never
    carries unmatched rows.
    """
    r = with_calendar(with_timestamp(readings))
    # the count comes first: a list that does not parse has none, and a null
    # label would fail the fit as a whole
    joined = drop_incomplete(enrich(join_weather(r, weather, how="inner", **join_kw)))
    return joined.select(*S.FEATURE_COLUMNS)


def build_features_left(readings: DataFrame, weather: DataFrame, **join_kw) -> DataFrame:
    """Left join, unmatched readings kept with null weather."""
    r = with_calendar(with_timestamp(readings))
    join_kw.setdefault("null_safe", True)  # as pandas merges: null keys match null keys
    return enrich(join_weather(r, weather, how="left", **join_kw)).select(*S.FEATURE_COLUMNS)

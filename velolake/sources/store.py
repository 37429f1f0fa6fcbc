"""Range scans of the reading store and the geo predicate."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import cells as CELLS
from velolake.functions import columns as C


def _ntz(value: dt.datetime):
    """A ``timestamp_ntz`` literal from ISO text: independent of the Python
    and session time zones (a naive ``datetime`` literal is not)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def time_window(
    df: DataFrame,
    day: dt.date | dt.datetime,
    lower_days: int = 14,
    upper_days: int = 1,
    ts: str = "timestamp",
    text: bool = False,
    date_col: str | None = None,
) -> DataFrame:
    """``date(day) - lower_days <= ts < date(day) + upper_days``.

    Offsets may be negative (F2: ``lower_days=15, upper_days=-1``).  On typed
    timestamps the bounds are ``timestamp_ntz`` literals so the predicate is
    pushed into the parquet scan; ``text=True`` compares ISO text the way the
    keyed store does (same result for ISO-8601 values).  ``date_col`` names
    a day partition column of the stored table (written by
    ``dedupe.write_partitions``): the same range on it prunes whole
    partitions before any file is opened.
    """
    d = day.date() if isinstance(day, dt.datetime) else day
    lo = dt.datetime.combine(d - dt.timedelta(days=lower_days), dt.time())
    hi = dt.datetime.combine(d + dt.timedelta(days=upper_days), dt.time())
    c = F.col(ts)
    if date_col:
        d_lo, d_hi = (F.lit(x.date().isoformat()).cast("date") for x in (lo, hi))
        df = df.where((F.col(date_col) >= d_lo) & (F.col(date_col) <= d_hi))
    if text:
        return df.where((c >= F.lit(lo.date().isoformat())) & (c < F.lit(hi.date().isoformat())))
    return df.where((c >= _ntz(lo)) & (c < _ntz(hi)))


def two_week_scan(df: DataFrame, day: dt.date | dt.datetime, ts: str = "timestamp", date_col: str | None = None) -> DataFrame:
    """The export window ``[day - 14, day + 1)``."""
    return time_window(df, day, 14, 1, ts, date_col=date_col)


def two_week_scan_alt(df: DataFrame, day: dt.date | dt.datetime, ts: str = "timestamp", date_col: str | None = None) -> DataFrame:
    """the variant window ``[day - 15, day - 1)``."""
    return time_window(df, day, 15, -1, ts, date_col=date_col)


def within_radius(
    df: DataFrame,
    lat: str = "Lat",
    lon: str = "Long",
    lat0: float = S.STATION_CENTER_LAT,
    lon0: float = S.STATION_CENTER_LON,
    radius_m: float = S.STATION_RADIUS_M,
    distance_col: str | None = "dist_m",
) -> DataFrame:
    """Rows within ``radius_m`` metres of (``lat0``, ``lon0``).

    A bounding-box pre-filter on the raw columns comes first: it is a plain
    range predicate that parquet can use for row-group skipping; the exact
    haversine test runs only on the survivors.
    """
    import math

    dlat = math.degrees(radius_m / 6371008.8) * 1.001
    dlon = dlat / max(math.cos(math.radians(abs(lat0) + dlat)), 1e-9)
    box = F.col(lat).between(lat0 - dlat, lat0 + dlat)
    if dlon < 180 and abs(lat0) + dlat < 90:  # else every longitude may be near a pole
        near = F.col(lon).between(lon0 - dlon, lon0 + dlon)
        if lon0 - dlon < -180:
            near = near | (F.col(lon) >= lon0 - dlon + 360)
        if lon0 + dlon > 180:
            near = near | (F.col(lon) <= lon0 + dlon - 360)
        box = box & near
    d = C.haversine_m(lat, lon, lat0, lon0)
    out = df.where(box).where(d <= radius_m)
    if distance_col:
        out = out.withColumn(distance_col, d)
    return out


CELL = "cell"


def write_by_cell(df: DataFrame, path: str, lat: str = "Lat", lon: str = "Long", partitions: int | None = None) -> str:
    """S6 on stored data: ``df`` sorted by its cell on the space-filling curve,
    with the number as column ``cell``.  Ranges are cut by (cell, hash of the
    row), so a place that holds much of the table is dealt over many files."""
    if CELL in (c.lower() for c in df.columns):
        raise ValueError(f"a column {CELL} is there already")
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    celled = df.withColumn(CELL, CELLS.cell(lat, lon))
    by = [F.col(CELL), spread]
    ranged = celled.repartitionByRange(partitions, *by) if partitions else celled.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    return path


def within_radius_stored(
    stored: DataFrame,
    lat: str = "Lat",
    lon: str = "Long",
    lat0: float = S.STATION_CENTER_LAT,
    lon0: float = S.STATION_CENTER_LON,
    radius_m: float = S.STATION_RADIUS_M,
    distance_col: str | None = "dist_m",
) -> DataFrame:
    """S6 over a table of :func:`write_by_cell`: the rows of
    :func:`within_radius`.  The circle becomes ranges of cell numbers, which
    the scan tests against each file's and row group's extremes."""
    near = reduce(lambda a, b: a | b, [F.col(CELL).between(a, b) for a, b in CELLS.covering(lat0, lon0, radius_m)])
    return within_radius(stored.where(near), lat, lon, lat0, lon0, radius_m, distance_col).drop(CELL)

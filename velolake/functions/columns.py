"""Scalar column expressions (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from velolake import schemas as S


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# P1 -------------------------------------------------------------------------
def as_text(col: str | Column, dtype: str | None = None) -> Column:
    """Render one value as the text the keyed store keeps.

    Null stays null (never the text ``None``).  Booleans are written as
    ``True``/``False`` and timestamps in ISO-8601 with a ``T``; the
    fractional part is omitted when it is zero, as ISO renderers do.
    """
    c = _c(col)
    if dtype == "boolean":
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if dtype in ("timestamp_ntz", "timestamp"):
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(c, "SSSSSS")
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
        )
    if dtype in ("double", "float"):
        return _double_text(c)
    return c.cast("string")


def _double_text(c: Column) -> Column:
    """A double as Python's ``str`` writes it: plain digits from 1e-4 to
    below 1e16, where Spark's cast has an exponent from 1e7 and below 1e-3."""
    text, size = c.cast("string"), F.abs(c)
    digits = F.rtrim(F.regexp_replace(F.regexp_extract(text, r"^-?([0-9.]+)E", 1), r"\.", ""), F.lit("0"))
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int")
    sign = F.when(c < 0, F.lit("-")).otherwise(F.lit(""))
    whole = F.rpad(digits, F.greatest(power + 1, F.length(digits)), "0")
    large = F.concat(sign, F.substring(whole, F.lit(1), power + 1), F.lit("."), F.coalesce(F.nullif(F.substring(whole, power + 2, F.length(whole)), F.lit("")), F.lit("0")))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    exponent = F.concat(F.regexp_replace(F.regexp_extract(text, r"^(-?[0-9.]+)E", 1), r"\.0$", ""), F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")))
    # most values have no exponent; the others' digits are only then taken apart
    common = c.isNull() | (size == 0) | ((size >= 1e-3) & (size < 1e7))
    plain = power.isNull() | F.isnan(c)
    return F.when(common | plain, text).when(size >= 1e16, exponent).when(size >= 1, large).when(size < 1e-4, exponent).otherwise(small)


# P2 -------------------------------------------------------------------------
def station_key(name: str | Column = "Name", station_id: str | Column = "StationId") -> Column:
    """``Name`` when it is a non-empty text, else ``StationId``."""
    return F.coalesce(F.nullif(_c(name), F.lit("")), _c(station_id))


# P5 -------------------------------------------------------------------------
# Compact ISO-8601 (basic format), which the extended-format cast rejects.
COMPACT_ISO = "yyyyMMdd'T'HHmmss"


def coerce_timestamp(col: str | Column) -> Column:
    """ISO-8601 text -> ``timestamp_ntz``; text that does not parse -> null.

    ``try_cast`` / ``try_to_timestamp`` never raise under ANSI mode
    (``to_timestamp`` would).  The compact form ``20230925T145034`` is
    accepted as a second pattern.
    """
    c = _c(col)
    compact = F.try_to_timestamp(c, F.lit(COMPACT_ISO)).cast("timestamp_ntz")
    return F.coalesce(c.try_cast("timestamp_ntz"), F.when(F.length(c) == 15, compact))


def hour_floor(ts: str | Column) -> Column:
    """Start of the hour as ``timestamp_ntz`` (independent of session zone)."""
    t = _c(ts)
    return F.make_timestamp_ntz(
        F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0)
    )


def slot_floor(ts: str | Column, minutes: int = 10) -> Column:
    """Start of the ``minutes``-long slot (the poll interval) as ``timestamp_ntz``."""
    t = _c(ts)
    return F.make_timestamp_ntz(
        F.year(t),
        F.month(t),
        F.dayofmonth(t),
        F.hour(t),
        (F.floor(F.minute(t) / minutes) * minutes).cast("int"),
        F.lit(0),
    )


# P6 -------------------------------------------------------------------------
def calendar_columns(ts: str | Column = "timestamp") -> dict[str, Column]:
    t = _c(ts)
    return {
        "Year": F.year(t),
        "Month": F.month(t),
        "Day": F.dayofmonth(t),
        "Hour": F.hour(t),
        "Minute": F.minute(t),
        "Time_of_Day": F.date_format(t, "HH:mm:ss"),
    }


# P7 -------------------------------------------------------------------------
def weekend_flag(ts: str | Column = "timestamp") -> Column:
    """1 on Saturday and Sunday, else 0 (``weekday`` is Monday = 0)."""
    return (F.weekday(_c(ts)) >= 5).cast("int")


# P8 -------------------------------------------------------------------------
def literal_list_length(col: str | Column) -> Column:
    """Number of elements of a list literal kept as text, e.g. ``['1', '2']``.

    Python literals ``None``/``True``/``False`` are rewritten to JSON before
    ``from_json``; single quotes are accepted by the JSON reader.  Text that
    is not a list gives null.  Rewriting inside quoted elements cannot change
    the element count, which is all that is returned.
    """
    # Only the element count is returned, so every Python literal can become
    # JSON null: one regex pass instead of one per literal.
    text = F.regexp_replace(_c(col), r"\b(None|True|False)\b", "null")
    return F.array_size(F.from_json(text, "array<string>")).cast("int")  # null for null, ANSI or not


def list_literal(n: str | Column, style: str | Column | None = None) -> Column:
    """Render a list of ``n`` bike ids (``[]`` for 0) as the store keeps it.

    ``style`` picks the text form: ``single`` (``['1', '2']``, the default),
    ``double`` (``["1", "2"]``), ``none_last`` (``['1', None]``: the last id
    unknown) or ``bare`` (``[1, 2]``).  A column may choose per row.
    """
    n = _c(n)
    ids = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))

    def render(quote: str, last_none: bool = False) -> Column:
        items = F.transform(
            ids,
            lambda x: F.when(F.lit(last_none) & (x == n), F.lit("None")).otherwise(
                F.concat(F.lit(quote), x.cast("string"), F.lit(quote))
            ),
        )
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))

    forms = {
        "single": render("'"),
        "double": render('"'),
        "none_last": render("'", last_none=True),
        "bare": render(""),
    }
    if style is None or isinstance(style, str):
        body = forms[style or "single"]
    else:
        body = forms["single"]
        for name, form in forms.items():
            body = F.when(style == name, form).otherwise(body)
    return F.when(n <= 0, F.lit("[]")).otherwise(body)


LIST_STYLES = ("single", "double", "none_last", "bare")


def _list_text(k: int, style: str) -> str:
    if k <= 0:
        return "[]"
    q = {"single": "'", "double": '"', "none_last": "'", "bare": ""}[style]
    items = [f"{q}{i}{q}" for i in range(1, k + 1)]
    if style == "none_last":
        items[-1] = "None"
    return "[" + ", ".join(items) + "]"


def list_literal_bounded(n: str, style: str, max_n: int) -> Column:
    """:func:`list_literal` for counts known to lie in ``0 .. max_n`` (``n``
    and ``style`` are column names): the texts are generated here and picked
    per row from literal arrays - one SQL expression, no per-row
    higher-order function.  A count outside the range is an error."""

    def sql_str(t: str) -> str:
        return "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"

    arrays = {
        st: "array(" + ", ".join(sql_str(_list_text(k, st)) for k in range(max_n + 1)) + ")"
        for st in LIST_STYLES
    }
    pick = " ".join(f"WHEN `{style}` = '{st}' THEN element_at({arr}, `{n}` + 1)" for st, arr in arrays.items())
    outside = f"raise_error(concat('list of ', `{n}`, ' elements; the bound is {max_n}'))"
    return F.expr(f"CASE WHEN `{n}` BETWEEN 0 AND {max_n} THEN CASE {pick} END WHEN `{n}` IS NOT NULL THEN {outside} END")


# P13 ------------------------------------------------------------------------
def weekend_label(code: str | Column = "IsWeekend") -> Column:
    c = _c(code)
    out = None
    for k, label in S.WEEKEND_LABELS.items():
        out = (F.when(c == k, F.lit(label))) if out is None else out.when(c == k, F.lit(label))
    return out


# P14 ------------------------------------------------------------------------
def timestamp_text(ts: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]`` (fraction only when non-zero)."""
    t = _c(ts)
    whole = F.date_format(t, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(t, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


# P17 ------------------------------------------------------------------------
def whole_bikes(prediction: str | Column) -> Column:
    """Round half to even, as Python's ``round``."""
    return F.bround(_c(prediction), 0).cast("long")


# P18 ------------------------------------------------------------------------
def local_wall_clock(ts_utc: str | Column, tz: str = S.LOCAL_TZ) -> Column:
    """UTC wall-clock ``timestamp_ntz`` -> wall-clock in ``tz`` (zone dropped)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts_utc))


# P19 ------------------------------------------------------------------------
def trailing_range_start(day: str | Column, days: int = S.WINDOW_DAYS) -> Column:
    """First day of the inclusive ``days``-day range ending on ``day``."""
    return F.date_sub(_c(day), days - 1)


def yesterday(now_utc: str | Column, tz: str = S.LOCAL_TZ) -> Column:
    """Yesterday's date on the wall clock of ``tz``."""
    return F.date_sub(F.to_date(local_wall_clock(now_utc, tz)), 1)


def yesterday_range(now_utc: str | Column, tz: str = S.LOCAL_TZ, days: int = S.WINDOW_DAYS) -> Column:
    """(yesterday, first day of the ``days``-day range ending on it)."""
    end = yesterday(now_utc, tz)
    return F.struct(end.alias("end"), trailing_range_start(end, days).alias("start"))


def trailing_range_text(day: str | Column, days: int = S.WINDOW_DAYS) -> Column:
    """``yyyy-MM-dd-yyyy-MM-dd``: the end day first, then the start day."""
    d = _c(day)
    return F.concat_ws(
        "-",
        F.date_format(d, "yyyy-MM-dd"),
        F.date_format(trailing_range_start(d, days), "yyyy-MM-dd"),
    )


# S6 -------------------------------------------------------------------------
EARTH_RADIUS_M = 6371008.8


def haversine_m(
    lat: str | Column, lon: str | Column, lat0: float, lon0: float
) -> Column:
    """Great-circle distance in metres from (``lat0``, ``lon0``)."""
    la, lo = F.radians(_c(lat)), F.radians(_c(lon))
    la0, lo0 = F.radians(F.lit(lat0)), F.radians(F.lit(lon0))
    a = F.pow(F.sin((la - la0) / 2), 2) + F.cos(la) * F.cos(la0) * F.pow(
        F.sin((lo - lo0) / 2), 2
    )
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))

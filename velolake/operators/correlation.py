"""A5: pairwise-complete Pearson correlation matrix, in long form.

Three aggregates, all with map-side combine and all of Spark's own
expressions:

1. the mean of every column over the whole table, one row: the pilot values;
2. rows are grouped by (group, null pattern) - the set of columns that are
   null in the row - and reduced to ``n, sum x, sum x*y, min x, max x`` of
   the values shifted by their pilot, so the sums hold deviations and not
   offsets.  There are few patterns, so any number of rows becomes a handful;
3. per (group, pair) the patterns where both columns are present are added
   up and the coefficient is formed.

A column is constant over a pair's rows if its smallest value is its
largest, whatever the number of rows; the coefficient is then null (Spark's
``corr`` raises under ANSI mode).  Values are taken as they are: no rounding,
no bound on their size.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velolake import schemas as S


def _value(col: str) -> str:
    """SQL for the value as a double; NaN counts as missing."""
    return f"nanvl(CAST(`{col}` AS DOUBLE), CAST(NULL AS DOUBLE))"


def pattern_sums(df: DataFrame, cols: Sequence[str], by: Sequence[str], pilots: Sequence[float]) -> DataFrame:
    """Step 2: one row per (group, null pattern)."""
    k = len(cols)
    xs = [f"{_value(c)} - ({p!r}D) AS _x{i}" for i, (c, p) in enumerate(zip(cols, pilots))]
    mask = " + ".join(f"CASE WHEN _x{i} IS NULL THEN {1 << i}L ELSE 0L END" for i in range(k))
    rows = df.selectExpr(*[f"`{b}`" for b in by], *xs).selectExpr("*", f"{mask} AS _mask")
    sums = ["count(1) AS _n"]
    for i in range(k):
        sums += [f"sum(_x{i}) AS _s{i}", f"min(_x{i}) AS _lo{i}", f"max(_x{i}) AS _hi{i}"]
    sums += [f"sum(_x{i} * _x{j}) AS _p{i}_{j}" for i, j in combinations_with_replacement(range(k), 2)]
    return rows.groupBy(*by, "_mask").agg(*[F.expr(e) for e in sums])


def pair_coefficients(patterns: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    """Step 3: ``(by..., i, j, corr)`` with i <= j."""
    keys = [f"`{b}`" for b in by]
    cells = ", ".join(
        f"named_struct('i', {i}, 'j', {j}, 'a', _s{i}, 'b', _s{j}, 'aa', _p{i}_{i}, 'bb', _p{j}_{j}, 'ab', _p{i}_{j}, "
        f"'la', _lo{i}, 'ha', _hi{i}, 'lb', _lo{j}, 'hb', _hi{j})"
        for i, j in combinations_with_replacement(range(k), 2)
    )
    per_pattern = patterns.selectExpr(*keys, "_mask", "_n", f"inline(array({cells}))")
    per_pair = per_pattern.where("(_mask & (shiftleft(1L, i) | shiftleft(1L, j))) = 0").groupBy(*by, "i", "j").agg(
        F.sum("_n").cast("double").alias("n"),
        *[F.sum(c).alias(c) for c in ("a", "b", "aa", "bb", "ab")],
        *[F.min(c).alias(c) for c in ("la", "lb")],
        *[F.max(c).alias(c) for c in ("ha", "hb")],
    )
    # sqrt of each variance by itself: their product could overflow
    raw = "try_divide(ab - a * b / n, sqrt(greatest(aa - a * a / n, 0D)) * sqrt(greatest(bb - b * b / n, 0D)))"
    corr = f"CASE WHEN n >= 2 AND la < ha AND lb < hb THEN CASE WHEN i = j THEN 1D ELSE greatest(-1D, least(1D, {raw})) END END"
    return per_pair.selectExpr(*keys, "i", "j", f"{corr} AS corr")


def correlation_long(
    df: DataFrame,
    columns: Sequence[str] = tuple(S.CORRELATION_COLUMNS),
    by: Sequence[str] = ("kind",),
) -> DataFrame:
    """``(by..., colA, colB, corr)`` for every ordered pair of ``columns``.

    ``corr`` is null where fewer than two complete pairs exist or a column
    is constant over them; the diagonal is exactly 1.0 otherwise.
    """
    by, cols = list(by), list(columns)
    means = df.selectExpr(*[f"avg({_value(c)}) AS _m{i}" for i, c in enumerate(cols)]).first()
    pilots = [float(m) if m is not None and abs(m) < float("inf") else 0.0 for m in means]
    scored = pair_coefficients(pattern_sums(df, cols, by, pilots), len(cols), by)
    names = "array(" + ", ".join(f"'{c}'" for c in cols) + ")"
    # both orientations of every off-diagonal pair
    return scored.selectExpr(
        *[f"`{b}`" for b in by],
        "explode(CASE WHEN i = j THEN array(named_struct('x', i, 'y', j)) "
        "ELSE array(named_struct('x', i, 'y', j), named_struct('x', j, 'y', i)) END) AS p",
        "corr",
    ).selectExpr(
        *[f"`{b}`" for b in by],
        f"element_at({names}, p.x + 1) AS colA",
        f"element_at({names}, p.y + 1) AS colB",
        "corr",
    )


def correlation_wide(long: DataFrame, columns: Sequence[str] = tuple(S.CORRELATION_COLUMNS), by: Sequence[str] = ("kind",)) -> DataFrame:
    """The matrix as one row per (group, colA) with one column per colB
    (pivot over the fixed column list: no discovery pass)."""
    return long.groupBy(*by, "colA").pivot("colB", list(columns)).agg(F.first("corr"))

"""Nothing is lost or rounded: outputs, upserts, CSV, windows, statistics."""

import datetime as dt
import math
import os
import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import columns as C
from velolake.ml import forest as ML
from velolake.operators import correlation as CORR
from velolake.operators import dedupe as DD
from velolake.operators import joins as J
from velolake.operators import metrics as M
from velolake.plans import binding as B
from velolake.plans import stages as ST
from velolake.sources import csv as CSV
from velolake.sources import store

SMALL = "/root/testdata/sf0.001"


def test_empty_join_leaves_earlier_ranges(spark, scratch):
    base = scratch("prepare")
    kept = f"{base}/features/2023-01-01-2023-01-14"
    spark.range(3).write.parquet(kept)
    readings, weather = B.readings(spark, SMALL), B.weather(spark, SMALL)
    none = weather.withColumn("Time", F.col("Time") - F.expr("INTERVAL 3000 DAYS"))
    with pytest.raises(ValueError):
        ST.prepare(spark, readings, none, base, B.REPORT_DAY)
    assert spark.read.parquet(kept).count() == 3


@pytest.mark.parametrize("parts", [("", "x"), ("features", ""), ("features", "/"), ("features", None)])
def test_object_path_refuses_empty_parts(parts):
    with pytest.raises(ValueError):
        CSV.object_path("s3://base", *parts)


def persisted(spark):
    return {k for k in spark.sparkContext._jsc.getPersistentRDDs()}


def test_rewritten_weather_shows(spark, scratch):
    before = persisted(spark)
    path = scratch("weather")
    hour = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' AS Time, " + ", ".join(f"5.0D AS {m}" for m in S.WEATHER_MEASURES))
    reading = spark.createDataFrame([(2024, 1, 1, 10)], S.HOUR_KEYS)
    for value in (5.0, 9.0):
        hour.withColumn("Temperature", F.lit(value)).write.mode("overwrite").parquet(path)
        got = J.join_weather(reading, spark.read.parquet(path)).first()
        assert got.Temperature == value
    assert persisted(spark) == before  # nothing is cached on the way


def test_null_day_rows_survive_an_upsert(spark, scratch):
    path = scratch("upsert")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, seq int, v int, d date")
    day = dt.date(2024, 1, 1)
    DD.upsert_into(spark, path, rows(("a", 1, 1, None), ("b", 1, 2, day)), ["k"], "seq", "d")
    DD.upsert_into(spark, path, rows(("c", 1, 3, None), ("b", 2, 4, day)), ["k"], "seq", "d")
    assert {(r.k, r.v) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 4), ("c", 3)}
    other = rows(("x", 1, 1, day)).withColumnRenamed("d", "other")
    with pytest.raises(ValueError):
        DD.upsert_into(spark, path, other, ["k"], "seq", "other")


def test_csv_by_name(spark, scratch):
    path = scratch("csv")
    rows = spark.createDataFrame([("3", "  edge  "), ("4", "two\nlines"), ("5", 'a "quote", comma')], "AvailableBikes string, stationId string")
    CSV.write_csv(rows, path, max_records=2)
    schema = "stationId string, AvailableBikes int"
    back = CSV.read_csv(spark, path, spark.createDataFrame([], schema).schema, multi_line=True)
    assert {tuple(r) for r in back.collect()} == {("  edge  ", 3), ("two\nlines", 4), ('a "quote", comma', 5)}
    with pytest.raises(ValueError):
        CSV.read_csv(spark, path, spark.createDataFrame([], "stationId string, missing int").schema)


def test_radius_across_the_date_line_and_a_pole(spark):
    df = spark.createDataFrame([(1, 0.0, -179.99), (2, 0.0, 179.98), (3, 0.0, 0.0), (4, 89.9, 100.0)], "id int, Lat double, Long double")
    ids = lambda **k: {r.id for r in store.within_radius(df, radius_m=30_000, **k).collect()}
    assert ids(lat0=0.0, lon0=179.99) == {1, 2} and ids(lat0=0.0, lon0=-179.995) == {1, 2}
    assert ids(lat0=89.95, lon0=-80.0) == {4}


def test_busiest_skips_null_times(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', NULL), ('a', NULL), ('a', timestamp_ntz'2024-01-01 10:00:00') AS t(kind, timestamp)")
    assert M.busiest_timestamp(df).first().busiestTime == dt.datetime(2024, 1, 1, 10)
    assert M.busiest_day(df).first().readings == 1


def test_means_are_not_rounded(spark):
    df = spark.createDataFrame([("a", 0, 1.4), ("a", 0, 1.4)], "kind string, IsWeekend int, AvailableBikes double")
    assert M.weekend_vs_weekday(df).first().meanAvailableBikes == pytest.approx(1.4)
    hours = spark.sql("SELECT 'a' AS kind, timestamp_ntz'2024-01-01 10:00:00' AS timestamp, 0.1234D AS Humidity, 1D AS Wind_Speed, 1D AS Temperature, 3 AS TotalAvailableBikes")
    assert M.hourly_resample(hours).first().Humidity == pytest.approx(0.1234)


def test_date_range_of_nothing_is_null(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' AS timestamp").limit(0)
    assert M.date_range(df, by=None).first().rangeName is None


@pytest.mark.parametrize("value", [0.0, 1.0, -2.5, 12345678.5, 0.0001, 0.00012345, 123456789012345.6, 1e15, 1e16, 1.5e22, 1e-5, 2.25e-7, 57.7, 9999999.0, 10000000.0, -0.001, 100.0])
def test_double_text(spark, value):
    assert spark.createDataFrame([(value,)], "v double").select(C.as_text("v", "double")).first()[0] == str(value)


def test_list_length_without_ansi(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("not a list",), (None,), ("['1', None]",), ("[]",)], "t string")
        assert [r[0] for r in df.select(C.literal_list_length("t")).collect()] == [None, None, 2, 0]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_baseline_scores_hours_it_has_not_seen(spark):
    train = spark.createDataFrame([(1, 4), (2, 8)], f"Hour int, {S.LABEL} int")
    got = ML.score_baseline(ML.hour_baseline(train), spark.createDataFrame([(1, 4), (9, 6)], f"Hour int, {S.LABEL} int"))
    assert {(r.Hour, r.prediction) for r in got.collect()} == {(1, 4), (9, 6)}


def test_yesterday(spark):
    df = spark.sql("SELECT timestamp_ntz'2023-10-14 22:30:00' AS t")  # after midnight in Stockholm
    r = df.select(C.yesterday("t").alias("y"), C.yesterday_range("t").alias("p")).first()
    assert r.y == dt.date(2023, 10, 14) and (r.p.end, r.p.start) == (dt.date(2023, 10, 14), dt.date(2023, 10, 1))


def exact_corr(x, y):
    pairs = [(Fraction(a), Fraction(b)) for a, b in zip(x, y) if a is not None and b is not None]
    if len(pairs) < 2:
        return None
    mx, my = sum(a for a, _ in pairs) / len(pairs), sum(b for _, b in pairs) / len(pairs)
    cov, va, vb = sum((a - mx) * (b - my) for a, b in pairs), sum((a - mx) ** 2 for a, _ in pairs), sum((b - my) ** 2 for _, b in pairs)
    return None if not va or not vb else float(cov) / math.sqrt(float(va) * float(vb))


def test_correlation_equals_exact_fractions(spark):
    r = random.Random(1)
    n, cols = 400, {}
    for d in range(0, 9, 2):
        offset = r.choice([0, 1e4, 1e8])
        cols[f"c{d}"] = [None if r.random() < 0.1 else round(offset + r.uniform(-50, 50), d) for _ in range(n)]
    cols["k"] = [57.708901] * n
    cols["nan"] = [float("nan") if i % 7 == 0 else float(i) for i in range(n)]
    df = spark.createDataFrame([tuple(v[i] for v in cols.values()) for i in range(n)], ", ".join(f"{c} double" for c in cols)).withColumn("kind", F.lit("a"))
    got = {(x.colA, x.colB): x["corr"] for x in CORR.correlation_long(df, list(cols)).collect()}
    cols["nan"] = [None if v != v else v for v in cols["nan"]]
    for a in cols:
        for b in cols:
            want = exact_corr(cols[a], cols[b])
            assert (got[a, b] is None) == (want is None), (a, b)
            assert want is None or got[a, b] == pytest.approx(want, abs=1e-9), (a, b)
    frame = pd.DataFrame({c: [np.nan if v is None else v for v in x] for c, x in cols.items() if c != "k"})
    for (a, b), v in frame.corr().stack().items():
        assert got[a, b] == pytest.approx(v, abs=1e-6)


def test_constant_column_in_large_partials(spark):
    rows = spark.range(2).selectExpr("'a' AS kind", "57.708901D AS x", "CAST(id AS DOUBLE) AS y")
    parts = CORR.pattern_sums(rows, ["x", "y"], ["kind"], [57.7, 0.5])
    huge = parts.selectExpr("kind", "_mask", "CAST(1000000000003 AS BIGINT) AS _n", *[f"{c} * 5e11 AS {c}" for c in parts.columns if c[:2] in ("_s", "_p")], *[c for c in parts.columns if c[:3] in ("_lo", "_hi")])
    got = {(r.i, r.j): r["corr"] for r in CORR.pair_coefficients(huge, 2, ["kind"]).collect()}
    assert got[0, 0] is None and got[0, 1] is None and got[1, 1] == 1.0


def test_no_round_robin_in_any_plan(spark):
    import __spark_entry__ as E

    for key in ("two_week_scan", "weather_join", "metrics_pack", "hourly_resample"):
        assert "RoundRobin" not in E.queries()[key](spark, SMALL)._jdf.queryExecution().executedPlan().toString(), key


def test_counts_outside_the_bound_raise(spark):
    df = spark.createDataFrame([(25, "bare")], "n int, st string")
    with pytest.raises(Exception, match="the bound is 24"):
        df.select(C.list_literal_bounded("n", "st", 24)).collect()
    assert os.path.exists(SMALL)

"""Features, join, metrics, correlation, sampling and splits on literal rows
(FIXTURES.md §6) plus properties."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.operators import correlation as CORR
from velolake.operators import features as FE
from velolake.operators import joins as J
from velolake.operators import metrics as M
from velolake.operators import sampling as SA

T0 = dt.datetime(2024, 1, 6, 10, 5)  # a Saturday


def readings(spark):
    rows = [
        (1, "BIKE 1", T0, 2, "['1', '2']", True, 11.97, 57.70, 10.0),
        (2, "BIKE 1", T0 + dt.timedelta(minutes=10), 1, "['1']", True, 11.98, 57.70, 11.0),
        (3, "Central", T0 + dt.timedelta(days=2), 5, "[1, 2, 3, 4, 5]", False, 11.99, 57.71, 50.0),
        (4, "Central", T0 + dt.timedelta(days=2, hours=3), 4, "['1', None, '3', '4']", True, 11.99, 57.71, 50.0),
        (5, "Harbour", T0 + dt.timedelta(hours=5), 0, "[]", True, 12.0, 57.72, 70.0),
    ]
    return spark.createDataFrame(
        rows,
        "readingId long, stationId string, timestamp timestamp_ntz, AvailableBikes int, BikeIds string, IsOpen boolean, Long double, Lat double, Distance double",
    )


def weather(spark, missing_hour=None):
    rows = []
    for h in range(0, 24 * 3):
        t = dt.datetime(2024, 1, 6) + dt.timedelta(hours=h)
        if missing_hour is not None and t == missing_hour:
            continue
        vis = None if h == 15 else 20000.0
        rows.append((t, float(h % 7), 80.0, 3.5, 0.0, vis, 0.0))
    return spark.createDataFrame(rows, "Time timestamp_ntz, Temperature double, Humidity double, Wind_Speed double, Precipitation double, Visibility double, Snowfall double")


def test_feature_table(spark):
    f = FE.build_features(readings(spark), weather(spark, missing_hour=dt.datetime(2024, 1, 8, 13)))
    assert f.columns == S.FEATURE_COLUMNS
    got = {r.readingId: r for r in f.collect()}
    # reading 4 (2024-01-08 13:05) has no weather hour; reading 5 (15:05) has null Visibility
    assert set(got) == {1, 2, 3}
    assert got[1].IsWeekend == 1 and got[3].IsWeekend == 0  # Saturday / Monday
    assert got[3].TotalAvailableBikes == 5 and got[1].TotalAvailableBikes == 2
    assert (got[1].Year, got[1].Month, got[1].Day, got[1].Hour, got[1].Minute) == (2024, 1, 6, 10, 5)
    left = FE.build_features_left(readings(spark), weather(spark, missing_hour=dt.datetime(2024, 1, 8, 13)))
    assert left.count() == 5
    assert FE.drop_incomplete(left).count() == 3  # left join + dropna == inner join + dropna


def test_null_safe_join(spark):
    r = spark.createDataFrame([(1, None, None, None, None)], "id int, Year int, Month int, Day int, Hour int")
    w = spark.createDataFrame([(None, 1.0)], "Time timestamp_ntz, Temperature double")
    for m in S.WEATHER_MEASURES[1:]:
        w = w.withColumn(m, F.lit(1.0))
    assert J.join_weather(r, w, how="inner").count() == 0
    assert J.join_weather(r, w, how="inner", null_safe=True).count() == 1


def persisted(spark):
    return {k for k in spark.sparkContext._jsc.getPersistentRDDs()}


def test_checked_broadcast_bound(spark):
    before = persisted(spark)
    small, ok = J.checked_broadcast(spark.range(10))
    assert ok and small.count() == 10
    _, ok = J.checked_broadcast(spark.range(100_000), max_bytes=1000)
    assert not ok
    assert persisted(spark) == before  # nothing is cached on the way


def test_kind_split_is_a_partition(spark):
    f = FE.with_kind(readings(spark))
    a, b = FE.single_bikes(f).count(), FE.stationary(f).count()
    assert a == 2 and a + b == f.count()


def test_impute_and_select(spark):
    w = FE.impute_visibility(weather(spark))
    assert w.where(F.col("Visibility") == S.VISIBILITY_FILL).count() == 1
    nan = spark.createDataFrame([(float("nan"),)], "Visibility double")
    assert FE.impute_visibility(nan).first().Visibility == S.VISIBILITY_FILL
    f = FE.build_features(readings(spark), weather(spark))
    x = FE.select_features(f.withColumnRenamed("Wind_Speed", "Wind_Speed"), S.MODEL_FEATURES_NO_MINUTE)
    assert x.columns == S.MODEL_FEATURES_NO_MINUTE
    y, rest = FE.split_target(f)
    assert y.columns == ["readingId", S.LABEL] and S.LABEL not in rest.columns


def metric_rows(spark):
    rows = [
        ("station_bikes", "s1", dt.datetime(2024, 1, 6, 10, 0), 9.0, 3, 1),
        ("station_bikes", "s2", dt.datetime(2024, 1, 6, 9, 0), 9.0, 5, 1),  # tie on the warmest: earliest wins
        ("station_bikes", "s1", dt.datetime(2024, 1, 6, 12, 1), -2.0, 1, 1),
        ("station_bikes", "s3", dt.datetime(2024, 1, 6, 12, 2), -2.0, 2, 1),
        ("station_bikes", "s3", dt.datetime(2024, 1, 8, 12, 3), float("nan"), 4, 0),
        ("single_bikes", "b1", dt.datetime(2024, 1, 8, 1, 0), 1.0, 1, 0),
        ("single_bikes", "b1", dt.datetime(2024, 1, 8, 4, 0), 3.0, 1, 0),
    ]
    return spark.createDataFrame(rows, "kind string, stationId string, timestamp timestamp_ntz, Temperature double, AvailableBikes int, IsWeekend int")


def test_scalar_metrics(spark):
    df = metric_rows(spark)
    st = {r.kind: r.numStations for r in M.distinct_stations(df).collect()}
    assert st == {"station_bikes": 3, "single_bikes": 1}
    ex = {r.kind: (r.warmestTemperature, r.coldestTemperature) for r in M.temperature_extremes(df).collect()}
    assert ex["station_bikes"] == (9.0, -2.0)  # NaN ignored
    days = {r.kind: (r.warmestDay, r.coldestDay) for r in M.extreme_days(df).collect()}
    assert days["station_bikes"] == (dt.datetime(2024, 1, 6, 9, 0), dt.datetime(2024, 1, 6, 12, 1))
    busy = {r.kind: (r.busiestTime, r.readings) for r in M.busiest_timestamp(df).collect()}
    assert busy["station_bikes"] == (dt.datetime(2024, 1, 6, 12, 0), 2)
    assert {r.kind: r.busiestDay for r in M.busiest_day(df).collect()}["station_bikes"] == dt.date(2024, 1, 6)
    rng = {r.kind: r.rangeName for r in M.date_range(df).collect()}
    assert rng["station_bikes"] == "2024-01-06-2024-01-08"
    pack = {r.kind: r for r in M.metrics_pack(df).collect()}
    assert pack["station_bikes"].rows == 5 and pack["station_bikes"].numStations == 3
    assert pack["single_bikes"].warmestDay == dt.datetime(2024, 1, 8, 4, 0)


def test_weekend_vs_weekday(spark):
    got = {(r.kind, r.dayType): r.meanAvailableBikes for r in M.weekend_vs_weekday(metric_rows(spark)).collect()}
    assert got[("station_bikes", "Weekend")] == pytest.approx(11 / 4)
    assert got[("station_bikes", "Weekdays")] == 4.0


def test_hourly_resample_emits_gap_hours(spark):
    df = metric_rows(spark).where("kind = 'single_bikes'").withColumn("Humidity", F.lit(50.0)).withColumn("Wind_Speed", F.lit(1.25)).withColumn(S.LABEL, F.lit(2))
    out = M.hourly_resample(df).orderBy("hour").collect()
    assert [r.hour.hour for r in out] == [1, 2, 3, 4]
    assert [r[S.LABEL] for r in out] == [2, 0, 0, 2]
    assert out[1].Temperature is None and out[0].Wind_Speed == 1.25


def test_station_profile(spark):
    df = metric_rows(spark).withColumn(S.LABEL, F.col("AvailableBikes")).withColumn("Lat", F.lit(57.7)).withColumn("Long", F.when(F.col("AvailableBikes") > 2, 12.0).otherwise(11.9))
    prof = {r.stationId: r for r in M.station_profile(df).collect()}
    assert (prof["s1"].minBikes, prof["s1"].maxBikes, prof["s1"].meanBikes) == (1, 3, 2.0)
    assert prof["s3"].positions == 2
    assert M.station_profile(df, only="s2").count() == 1


def test_correlation_matches_pairwise_pandas(spark):
    rows = [
        ("a", 1.0, 2.0, 5.0, 3.0),
        ("a", 2.0, 4.5, 5.0, None),
        ("a", 3.0, 5.5, 5.0, 1.0),
        ("a", 4.0, 9.25, 5.0, 0.5),
        ("a", None, 1.0, 5.0, 2.0),
        ("a", 6.0, 11.0, 5.0, float("nan")),
    ]
    cols = ["x", "y", "c", "z"]
    df = spark.createDataFrame(rows, "kind string, x double, y double, c double, z double")
    got = {(r.colA, r.colB): r.corr for r in CORR.correlation_long(df, cols).collect()}
    pdf = pd.DataFrame(rows, columns=["kind", *cols])[cols]
    want = pdf.corr()
    for a in cols:
        for b in cols:
            w = want.loc[a, b]
            if a == "c" or b == "c":
                assert got[(a, b)] is None  # constant column: no coefficient
            else:
                assert got[(a, b)] == pytest.approx(w, rel=1e-12), (a, b)
    assert got[("x", "x")] == 1.0
    assert len(got) == 16


def test_hash_split_properties(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "readingId")
    train, test = SA.split_by_hash(df, 0.2)
    a, b = {r.readingId for r in train.collect()}, {r.readingId for r in test.collect()}
    assert not (a & b) and len(a | b) == 5000
    assert 800 < len(b) < 1200
    again = {r.readingId for r in SA.split_by_hash(df.repartition(7), 0.2)[1].collect()}
    assert again == b  # independent of partitioning


def test_sample_and_head(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "readingId")
    s1 = [r.readingId for r in SA.sample_n(df, 50).collect()]
    s2 = [r.readingId for r in SA.sample_n(df.repartition(5), 50).collect()]
    assert len(s1) == 50 and sorted(s1) == sorted(s2)
    assert SA.sample_n(df, 5000).count() == 1000
    assert [r.readingId for r in SA.head(df.repartition(4), 5).collect()] == [0, 1, 2, 3, 4]


def test_empty_inputs(spark):
    from velolake.ml import forest as ML
    from velolake.operators import dedupe as DD

    empty = metric_rows(spark).limit(0)
    assert M.metrics_pack(empty).count() == 0
    assert M.extreme_days(empty).count() == 0
    assert M.busiest_timestamp(empty).count() == 0
    assert M.hourly_resample(empty.withColumn("Humidity", F.lit(1.0)).withColumn("Wind_Speed", F.lit(1.0)).withColumn(S.LABEL, F.lit(1)).limit(0)).count() == 0
    cols = ["Temperature", "AvailableBikes"]
    assert CORR.correlation_long(empty, cols).count() == 0
    ids = spark.range(0).withColumnRenamed("id", "readingId")
    assert SA.sample_n(ids, 10).count() == 0
    assert DD.latest_per_key(empty, ["stationId"], "timestamp").count() == 0
    m = ML.regression_metrics(spark.createDataFrame([], "TotalAvailableBikes int, prediction int")).first()
    assert m.n == 0 and m.MAE is None and m.R2 is None


def test_metrics_pack_by_raw_timestamp(spark):
    t = [dt.datetime(2024, 1, 1, 0, m) for m in (1, 1, 2, 3, 4)]
    df = spark.createDataFrame([("k", "a", x, 1.0) for x in t], "kind string, stationId string, timestamp timestamp_ntz, Temperature double")
    assert M.metrics_pack(df, slot_minutes=None).first().busiestTime == t[0]
    assert M.metrics_pack(df).first().busiestTime == dt.datetime(2024, 1, 1)

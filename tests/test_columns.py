"""Scalar functions: golden vectors of the surveyed unit tests and the
edge cases of FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from velolake.functions import columns as C


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_stockholm_wall_clock(spark):
    # 2023-10-14 00:00 UTC is 02:00 in Stockholm (summer time)
    got = one(spark, C.local_wall_clock("t"), [(dt.datetime(2023, 10, 14),)], "t timestamp_ntz")
    assert got == [dt.datetime(2023, 10, 14, 2, 0)]


def test_trailing_range(spark):
    df = spark.createDataFrame([(dt.date(2023, 10, 14),)], "d date")
    r = df.select(C.trailing_range_text("d").alias("s"), C.trailing_range_start("d").alias("start")).first()
    assert r.s == "2023-10-14-2023-10-01"
    assert r.start == dt.date(2023, 10, 1)


def test_station_key(spark):
    rows = [(None, "s1"), ("", "s2"), ("Hornsgatan", "s3")]
    got = one(spark, C.station_key("Name", "StationId"), rows, "Name string, StationId string")
    assert got == ["s1", "s2", "Hornsgatan"]


def test_coerce_timestamp(spark):
    rows = [("2023-09-25T14:50:34.453006",), ("garbage",), ("",), (None,), ("2023-10-19",), ("20230925T145034",), ("2023-13-45",)]
    got = one(spark, C.coerce_timestamp("t"), rows, "t string")
    assert got == [dt.datetime(2023, 9, 25, 14, 50, 34, 453006), None, None, None, dt.datetime(2023, 10, 19),
                   dt.datetime(2023, 9, 25, 14, 50, 34), None]


def test_weekend_flag(spark):
    rows = [(dt.datetime(2024, 1, 6, 12),), (dt.datetime(2024, 1, 7, 12),), (dt.datetime(2024, 1, 8, 12),)]
    assert one(spark, C.weekend_flag("t"), rows, "t timestamp_ntz") == [1, 1, 0]


def test_literal_list_length(spark):
    rows = [("[]",), ("['1', '2']",), ("['1', None]",), (None,), ("[1, 2, 3]",), ('["a"]',), ("not a list",), ("[True, False]",)]
    got = one(spark, C.literal_list_length("b"), rows, "b string")
    assert got == [0, 2, 2, None, 3, 1, None, 2]


def test_list_literal_styles_round_trip(spark):
    df = spark.range(0, 6).select(F.col("id").cast("int").alias("n"))
    for style in ("single", "double", "none_last", "bare"):
        out = df.select("n", C.literal_list_length(C.list_literal("n", style)).alias("m")).collect()
        assert all(r.n == r.m for r in out), style


def test_as_text(spark):
    schema = T.StructType([T.StructField("b", T.BooleanType()), T.StructField("t", T.TimestampNTZType()), T.StructField("x", T.DoubleType())])
    rows = [(True, dt.datetime(2023, 9, 25, 14, 50, 34, 453006), 1.5), (None, dt.datetime(2023, 10, 19), None)]
    df = spark.createDataFrame(rows, schema)
    got = df.select(C.as_text("b", "boolean"), C.as_text("t", "timestamp_ntz"), C.as_text("x")).collect()
    assert tuple(got[0]) == ("True", "2023-09-25T14:50:34.453006", "1.5")
    assert tuple(got[1]) == (None, "2023-10-19T00:00:00", None)  # null stays null, never "None"


def test_whole_bikes_rounds_half_to_even(spark):
    got = one(spark, C.whole_bikes("p"), [(0.5,), (1.5,), (2.5,), (2.6,)], "p double")
    assert got == [0, 2, 2, 3]


def test_slot_and_hour_floor(spark):
    t = dt.datetime(2024, 1, 1, 13, 47, 12, 5)
    r = spark.createDataFrame([(t,)], "t timestamp_ntz").select(C.slot_floor("t").alias("s"), C.hour_floor("t").alias("h")).first()
    assert r.s == dt.datetime(2024, 1, 1, 13, 40)
    assert r.h == dt.datetime(2024, 1, 1, 13, 0)


def test_haversine(spark):
    got = one(spark, C.haversine_m("lat", "lon", 57.7089, 11.9746), [(57.7089, 11.9746), (57.7179, 11.9746)], "lat double, lon double")
    assert got[0] == 0.0
    assert abs(got[1] - 1000.8) < 1.0  # 0.009 degrees of latitude


def test_list_literal_bounded_equals_general(spark):
    styles = F.array(*[F.lit(s) for s in C.LIST_STYLES])
    df = spark.range(0, 25).select(F.col("id").cast("int").alias("n"), F.explode(styles).alias("st"))
    out = df.select(
        "n", C.list_literal_bounded("n", "st", 24).alias("a"), C.list_literal("n", F.col("st")).alias("b")
    ).collect()
    assert all(r.a == r.b for r in out)


def test_window_literals_ignore_session_zone(spark):
    from velolake.sources import store as ST

    rows = [(dt.datetime(2024, 1, 6, 0, 0),), (dt.datetime(2024, 1, 5, 23, 59),), (dt.datetime(2024, 1, 20, 23, 0),)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert ST.two_week_scan(df, dt.date(2024, 1, 20)).count() == 2, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)

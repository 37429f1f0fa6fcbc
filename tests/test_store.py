"""Reading store: range scans (golden vectors of the surveyed store test),
keyed upsert, geo predicate."""

import datetime as dt

from pyspark.sql import functions as F

from velolake.functions import columns as C
from velolake.operators import dedupe as DD
from velolake.sources import store as ST

ITEMS = [
    ("station1", "2023-09-25T14:50:34.453006", "1"),
    ("station2", "2023-10-05T15:00:34.581457", "2"),
    ("station3", "2023-10-12T15:10:35.982498", "3"),
    ("station4", "2023-10-18T15:10:35.982498", "4"),
    ("station5", "2023-10-18T23:59:59.999999", "5"),
    ("station6", "2023-10-19T00:00:00.000000", "6"),
]


def items(spark):
    df = spark.createDataFrame(ITEMS, "stationId string, timestamp string, AvailableBikes string")
    return df.withColumn("timestamp", C.coerce_timestamp("timestamp"))


def test_two_week_window_golden(spark):
    got = ST.two_week_scan(items(spark), dt.date(2023, 10, 20)).orderBy("timestamp").collect()
    assert [r.stationId for r in got] == ["station3", "station4", "station5", "station6"]
    assert got[0].AvailableBikes == "3"
    got = ST.two_week_scan(items(spark), dt.datetime(2023, 9, 26, 12)).collect()
    assert [r.AvailableBikes for r in got] == ["1"]


def test_text_comparison_matches_typed(spark):
    raw = spark.createDataFrame(ITEMS, "stationId string, timestamp string, AvailableBikes string")
    for d in (dt.date(2023, 10, 20), dt.date(2023, 9, 26), dt.date(2023, 10, 5)):
        a = {r.stationId for r in ST.time_window(raw, d, text=True).collect()}
        b = {r.stationId for r in ST.two_week_scan(items(spark), d).collect()}
        assert a == b


def test_window_bounds(spark):
    rows = [("a", dt.datetime(2023, 10, 6)), ("b", dt.datetime(2023, 10, 21)), ("c", dt.datetime(2023, 10, 20, 23, 59, 59))]
    df = spark.createDataFrame(rows, "stationId string, timestamp timestamp_ntz")
    got = {r.stationId for r in ST.two_week_scan(df, dt.date(2023, 10, 20)).collect()}
    assert got == {"a", "c"}  # lower bound kept, upper bound dropped
    assert ST.two_week_scan(df, dt.date(2020, 1, 1)).count() == 0
    alt = {r.stationId for r in ST.two_week_scan_alt(df, dt.date(2023, 10, 22)).collect()}
    assert alt == {"c"}  # [D-15, D-1)


def test_upsert_last_write_wins_and_idempotent(spark):
    rows = [("s1", 1, 5, 1), ("s1", 1, 7, 3), ("s1", 1, 6, 2), ("s2", 1, 1, 1), ("s1", 2, 9, 4)]
    df = spark.createDataFrame(rows, "stationId string, ts int, bikes int, seq int")
    latest = DD.latest_per_key(df, ["stationId", "ts"], "seq")
    got = {(r.stationId, r.ts): (r.bikes, r.seq) for r in latest.collect()}
    assert got == {("s1", 1): (7, 3), ("s2", 1): (1, 1), ("s1", 2): (9, 4)}
    again = DD.latest_per_key(latest, ["stationId", "ts"], "seq")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, latest.collect()))
    merged = DD.merge_latest(latest, spark.createDataFrame([("s2", 1, 0, 9)], df.schema), ["stationId", "ts"], "seq")
    assert {(r.stationId, r.ts): r.bikes for r in merged.collect()}[("s2", 1)] == 0


def test_upsert_partition_overwrite(spark, scratch):
    path = scratch("upsert")
    day = F.to_date("ts")
    a = spark.createDataFrame([("s1", dt.datetime(2024, 1, 1, 1), 1), ("s1", dt.datetime(2024, 1, 2, 1), 2)], "stationId string, ts timestamp_ntz, bikes int")
    DD.write_partitions(a.withColumn("day", day), path, ["day"])
    b = spark.createDataFrame([("s1", dt.datetime(2024, 1, 2, 1), 5)], a.schema)
    DD.write_partitions(b.withColumn("day", day), path, ["day"])
    got = {r.bikes for r in spark.read.parquet(path).collect()}
    assert got == {1, 5}  # day 1 untouched, day 2 rewritten


def test_within_radius(spark):
    rows = [("near", 57.7089, 11.9746), ("3km", 57.7359, 11.9746), ("far", 58.5, 12.0)]
    df = spark.createDataFrame(rows, "stationId string, Lat double, Long double")
    got = {r.stationId for r in ST.within_radius(df, radius_m=3100.0).collect()}
    assert got == {"near", "3km"}
    assert {r.stationId for r in ST.within_radius(df).collect()} == {"near", "3km"}  # 30 km


def test_window_prunes_day_partitions(spark, scratch):
    path = scratch("store")
    rows = [("s", dt.datetime(2023, 10, d, 12), d) for d in range(1, 31)]
    df = spark.createDataFrame(rows, "stationId string, timestamp timestamp_ntz, AvailableBikes int")
    DD.write_partitions(df.withColumn("readingDate", F.to_date("timestamp")), path, ["readingDate"])
    scan = ST.two_week_scan(spark.read.parquet(path), dt.date(2023, 10, 20), date_col="readingDate")
    assert sorted(r.AvailableBikes for r in scan.collect()) == list(range(6, 21))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(readingDate" in plan


def test_upsert_into_partitioned_store(spark, scratch):
    path = scratch("kv")
    schema = "stationId string, timestamp timestamp_ntz, AvailableBikes int, seq long"

    def batch(rows):
        return spark.createDataFrame(rows, schema).withColumn("readingDate", F.to_date("timestamp"))

    t1, t2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2, 10)
    DD.upsert_into(spark, path, batch([("s1", t1, 1, 1), ("s2", t1, 2, 1), ("s1", t2, 3, 1)]), ["stationId", "timestamp"], "seq", "readingDate")
    DD.upsert_into(spark, path, batch([("s1", t2, 9, 2), ("s3", t2, 4, 2), ("s1", t2, 7, 1)]), ["stationId", "timestamp"], "seq", "readingDate")
    got = {(r.stationId, r.timestamp): r.AvailableBikes for r in spark.read.parquet(path).collect()}
    assert got == {("s1", t1): 1, ("s2", t1): 2, ("s1", t2): 9, ("s3", t2): 4}


def test_upsert_unique_seq_form_agrees(spark):
    rows = [("s1", 1, 5, 1, "a"), ("s1", 1, 7, 3, "b"), ("s1", 1, 6, 2, "c"), ("s2", 1, 1, 4, "d"), ("s1", 2, 9, 5, "e")]
    df = spark.createDataFrame(rows, "stationId string, ts int, bikes int, seq int, tag string")
    a = sorted(map(tuple, DD.latest_per_key(df, ["stationId", "ts"], "seq").collect()))
    b = sorted(map(tuple, DD.latest_per_key(df, ["stationId", "ts"], "seq", unique_seq=True).collect()))
    assert a == b
    fixed = df.drop("tag")
    plan = DD.latest_per_key(fixed, ["stationId", "ts"], "seq", unique_seq=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan

"""Cells on the space-filling curve, landed weather, files set aside."""

import datetime as dt
import json
import math
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import cells as CELLS
from velolake.sources import quarantine as QU
from velolake.sources import store as ST
from velolake.sources import weather_source as WS

LAT = st.floats(-90, 90, allow_nan=False)
LONG = st.floats(-180, 180, allow_nan=False)


def plain_cell(lat, long):
    return CELLS.interleaved(CELLS.step(lat, -90.0, 180.0), CELLS.step(long, -180.0, 360.0))


def distance(lat, long, lat0, long0):
    a = math.sin(math.radians(lat - lat0) / 2) ** 2 + math.cos(math.radians(lat)) * math.cos(math.radians(lat0)) * math.sin(math.radians(long - long0) / 2) ** 2
    return 2 * CELLS.EARTH_M * math.asin(min(1.0, math.sqrt(a)))


@settings(max_examples=300, deadline=None)
@given(LAT, LONG, st.floats(1, 3e7), st.floats(0, 2 * math.pi), st.floats(0, 0.999999))
def test_ranges_hold_every_place_of_the_circle(lat0, long0, radius, bearing, share):
    d = min(radius, math.pi * CELLS.EARTH_M) * share / CELLS.EARTH_M
    a = math.radians(lat0)
    lat = math.asin(max(-1.0, min(1.0, math.sin(a) * math.cos(d) + math.cos(a) * math.sin(d) * math.cos(bearing))))
    long = math.radians(long0) + math.atan2(math.sin(bearing) * math.sin(d) * math.cos(a), math.cos(d) - math.sin(a) * math.sin(lat))
    lat, long = math.degrees(lat), (math.degrees(long) + 180) % 360 - 180
    if distance(lat, long, lat0, long0) > radius:
        return  # rounding at the rim
    ranges = CELLS.covering(lat0, long0, radius)
    assert len(ranges) <= CELLS.RANGES and any(lo <= plain_cell(lat, long) <= hi for lo, hi in ranges)


def test_small_circles_cover_little():
    for lat, long in ((57.7, 11.97), (0.0, 179.999), (-33.0, -180.0), (89.0, 10.0)):
        held = sum(hi - lo + 1 for lo, hi in CELLS.covering(lat, long, 5000))
        assert held / 4**CELLS.BITS < 2e-5


def test_cells_in_spark_equal_plain_ones(spark):
    r = random.Random(1)
    places = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(300)] + [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (95.0, 200.0)]
    got = spark.createDataFrame(places, "Lat double, Long double").select(CELLS.cell().alias("c")).collect()
    assert [x.c for x in got] == [plain_cell(*p) for p in places]
    odd = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0), (1.0, None)], "Lat double, Long double").select(CELLS.cell().alias("c")).collect()
    assert [x.c for x in odd] == [None] * 3


@pytest.mark.parametrize("lat0, long0, radius", [(57.7, 11.97, 20_000.0), (0.0, 179.95, 30_000.0), (89.9, 0.0, 60_000.0), (10.0, 20.0, 2e7)])
def test_stored_radius_equals_plain_radius(spark, scratch, lat0, long0, radius):
    r = random.Random(2)
    rows = [(k, max(-90.0, min(90.0, lat0 + r.gauss(0, 0.3))), (long0 + r.gauss(0, 0.5) + 180) % 360 - 180) for k in range(2000)]
    rows += [(k, r.uniform(-90, 90), r.uniform(-180, 180)) for k in range(2000, 3000)] + [(3000, None, 1.0), (3001, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id int, Lat double, Long double")
    stored = spark.read.parquet(ST.write_by_cell(df, scratch("cells"), partitions=6))
    near = ST.within_radius_stored(stored, lat0=lat0, lon0=long0, radius_m=radius)
    want = ST.within_radius(df, lat0=lat0, lon0=long0, radius_m=radius)
    assert sorted(x.id for x in near.collect()) == sorted(x.id for x in want.collect())
    assert near.columns == want.columns
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = near.select("id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "GreaterThanOrEqual(cell," in pushed and "LessThanOrEqual(cell," in pushed


def test_a_hot_place_is_dealt_over_files(spark, scratch):
    df = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 57.7D, 50 + id / 9000D) AS Lat", "11.9D AS Long").repartition(4)
    stored = spark.read.parquet(ST.write_by_cell(df, scratch("hot"), partitions=9))
    per_file = [x["count"] for x in stored.groupBy(F.input_file_name()).count().collect()]
    assert len(per_file) == 9 and max(per_file) < 2 * 1000
    with pytest.raises(ValueError):
        ST.write_by_cell(stored, scratch("again"))


# -- landed weather ---------------------------------------------------------
def land(root, days):
    for day, lines in days.items():
        os.makedirs(f"{root}/day={day}")
        with open(f"{root}/day={day}/part-0.json", "w") as f:
            f.write("\n".join(x if isinstance(x, str) else json.dumps({"hourly": x}) for x in lines))
    return root


def hours(day, *values):
    return {"time": [f"{day}T{h:02}:00" for h in range(len(values))], "temperature_2m": list(values), "snowfall": [0.5]}


def test_days_outside_the_range_are_never_opened(spark, scratch):
    root = scratch("weather").removeprefix("file:")
    land(root, {"2024-01-01": ["not json at all"], "2024-01-02": [hours("2024-01-02", 1.0, 2.0, None)], "2024-01-03": [hours("2024-01-03", 4.0)], "2024-01-04": ["{"]})
    os.makedirs(f"{root}/_temporary")
    second, third = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    rows = WS.read_landed_weather(spark, root, second, third, ["temperature_2m"])
    assert rows.columns == ["day", "time", "temperature_2m"]
    got = sorted(map(tuple, rows.collect()), key=str)
    hour = lambda day, h: dt.datetime.combine(day, dt.time(h))
    assert got == [(second, hour(second, 0), 1.0), (second, hour(second, 1), 2.0), (second, hour(second, 2), None), (third, hour(third, 0), 4.0)]
    # one frame, several filters: each plan reads for itself
    assert [rows.where(f).count() for f in ("day = date'2024-01-03'", "day = date'2024-01-02'", "hour(time) > 0", "true")] == [1, 3, 2, 4]
    assert WS.read_landed_weather(spark, root, dt.date(2024, 2, 1)).count() == 0
    with pytest.raises(Exception, match="JSON|Expecting"):
        WS.read_landed_weather(spark, root).collect()  # the whole range holds the broken days


def test_fields_are_chosen_and_padded(spark, scratch):
    root = land(scratch("weather").removeprefix("file:"), {"2024-01-02": [hours("2024-01-02", 1.0, 2.0), "", {"time": ["bad", None], "snowfall": [1, 2, 3]}]})
    got = WS.read_landed_weather(spark, root, fields=["snowfall", "temperature_2m"]).collect()
    assert [(x.time and x.time.hour, x.snowfall, x.temperature_2m) for x in got] == [(0, 0.5, 1.0), (1, None, 2.0), (None, 1.0, None), (None, 2.0, None), (None, 3.0, None)]
    assert len(WS.read_landed_weather(spark, root).columns) == 1 + len(S.WEATHER_SOURCE_FIELDS)
    with pytest.raises(Exception, match="Unknown weather fields"):
        WS.read_landed_weather(spark, root, fields=["nothing"]).collect()


# -- quarantine -------------------------------------------------------------
def put(root, files):
    os.makedirs(root)
    for name, text in files.items():
        with open(f"{root}/{name}", "wb") as f:
            f.write(text if isinstance(text, bytes) else text.encode())
    return root


def by_name(rows, *columns):
    return sorted((r.file.rsplit("/", 1)[1], *(r[c] for c in columns)) for r in rows.collect())


def test_json_files_set_aside(spark, scratch):
    good = '[\n {"StationId": "a",\n  "AvailableBikes": 3},\n {"StationId": "b"},\n {"Name": null}\n]'
    files = {"good.json": good, "cut.json": good[:40], "none.json": "", "text.json": "hello", "broken.json.gz": b"\x1f\x8b\x08\x00 no gzip", "one.json": '{"StationId": "c"}'}
    root = put(scratch("json").removeprefix("file:"), files)
    got = QU.read_json_quarantined(spark, root, S.STATION_SCHEMA, required=("StationId", "Name"))
    assert sorted(r.StationId for r in got.kept.collect()) == ["a", "b", "c"]
    assert by_name(got.aside, "reason") == [("broken.json.gz", "no records"), ("cut.json", "malformed"), ("good.json", "no record"), ("text.json", "malformed")]
    assert by_name(got.files, "kept", "aside") == [("broken.json.gz", 0, 0), ("cut.json", 0, 1), ("good.json", 2, 1), ("one.json", 1, 0), ("text.json", 0, 1)]
    assert {r.record for r in got.aside.where("reason = 'malformed'").collect()} == {"hello", good[:40]}


def test_csv_rows_set_aside(spark, scratch):
    text = 'id,name,n,open\n1,a,5,true\n2,"b,c",x,false\n3,c\n4,d,6,maybe,more\n5,NA,,TRUE\n6,f,7,maybe\n'
    root = put(scratch("csv").removeprefix("file:"), {"one.csv": text, "two.csv": "id,name,n,open\n", "three.csv": "id,name,n,open\n9,z,1,true\n"})
    schema = spark.createDataFrame([], "id int, name string, n int, open boolean").schema
    got = QU.read_csv_quarantined(spark, root, schema)
    assert sorted(map(tuple, got.kept.drop("_file").collect())) == [(1, "a", 5, True), (5, None, None, True), (9, "z", 1, True)]
    malformed = [("one.csv", "malformed", "3,c"), ("one.csv", "malformed", "4,d,6,maybe,more")]
    bad = [("one.csv", "bad n", '2,"b,c",x,false'), ("one.csv", "bad open", "6,f,7,maybe")]
    assert by_name(got.aside.where("record IS NOT NULL"), "reason", "record") == bad + malformed
    assert by_name(got.aside.where("record IS NULL"), "reason") == [("two.csv", "no records")]
    assert by_name(got.files, "kept", "aside") == [("one.csv", 2, 4), ("three.csv", 1, 0), ("two.csv", 0, 0)]
    put(f"{root}/more", {"other.csv": "name,id,n,open\nx,1,2,true\n"})
    again = QU.read_csv_quarantined(spark, root, schema)
    assert again.kept.count() == 3 and ("other.csv", "no records") in by_name(again.aside, "reason")

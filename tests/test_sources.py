"""Sources and sinks: CSV, snapshots, weather responses."""

import datetime as dt
import glob
import json

import pytest

from velolake import schemas as S
from velolake.sources import csv as CSV
from velolake.sources import snapshots as SN
from velolake.sources import weather as WX


def test_csv_rendering(spark, scratch):
    path = scratch("csv1")
    CSV.write_csv(spark.createDataFrame([("1",)], "stationId string"), path)
    local = path.replace("file://", "").replace("file:", "")
    text = "".join(open(f).read() for f in sorted(glob.glob(f"{local}/part-*.csv")))
    lines = text.replace("\r\n", "\n").splitlines()
    # one header per part file; the rows are what must match
    assert lines[0] == "stationId"
    assert [x for x in lines if x != "stationId"] == ["1"]


def test_csv_round_trip_quotes_and_na_tokens(spark, scratch):
    path = scratch("csv2")
    rows = [("a", "['1', '2']", "3"), ("b", 'say "hi", ok', "NaN"), ("c", "None", "")]
    CSV.write_csv(spark.createDataFrame(rows, "k string, txt string, n string"), path)
    schema = "k string, txt string, n int"
    back = {r.k: (r.txt, r.n) for r in CSV.read_csv(spark, path, schema=S_schema(schema)).collect()}
    assert back == {"a": ("['1', '2']", 3), "b": ('say "hi", ok', None), "c": (None, None)}


def S_schema(ddl):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(ddl)


def test_csv_column_subset_and_guards(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert CSV.select_columns(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError):
        CSV.select_columns(df, ["a", "zzz"])
    with pytest.raises(ValueError):
        CSV.require_rows(df.limit(0), "empty table")
    assert CSV.require_rows(df) is df
    assert CSV.object_path("s3://b/base/", "single_bikes", "2024-01-01-2024-01-14", "data.csv") == (
        "s3://b/base/single_bikes/2024-01-01-2024-01-14/data.csv"
    )


def test_snapshot_flatten_and_items(spark, scratch):
    stations = [
        {"StationId": "A1", "Name": "Hornsgatan", "Lat": 57.7, "Long": 11.97, "IsOpen": True, "AvailableBikes": 2, "Distance": 10.5, "BikeIds": ["1", "2"]},
        {"StationId": "BIKE 7", "Name": "", "Lat": 57.71, "Long": 11.98, "IsOpen": False, "AvailableBikes": 0, "Distance": 3.0, "BikeIds": []},
        {"StationId": "A3", "Lat": 57.72, "Long": 11.99, "IsOpen": True, "AvailableBikes": 1, "Distance": 1.0, "BikeIds": None},
        {"StationId": "A4", "Name": None, "Lat": 57.72, "Long": 11.99, "IsOpen": True, "AvailableBikes": 2, "Distance": 1.0, "BikeIds": ["1", None]},
    ]
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0), json.dumps(stations)), (2, dt.datetime(2024, 1, 1, 10, 10), "not json")], "pollId long, polledAt timestamp_ntz, payload string")
    flat = SN.flatten_snapshot_text(df)
    assert flat.count() == 4  # unparsable snapshot yields no rows
    items = {r.stationId: r for r in SN.snapshot_to_items(flat).collect()}
    assert set(items) == {"Hornsgatan", "BIKE 7", "A3", "A4"}
    assert items["Hornsgatan"].BikeIds == "['1', '2']"
    assert items["Hornsgatan"].timestamp == "2024-01-01T10:00:00"
    assert items["BIKE 7"].BikeIds == "[]" and items["BIKE 7"].IsOpen == "False"
    assert items["A3"].BikeIds is None and items["A3"].Name is None
    assert items["A4"].BikeIds == "['1', None]"
    # files landed as the API returns them
    path = scratch("snap")
    local = path.replace("file://", "").replace("file:", "")
    import os

    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local + ".json", "w") as fh:
        json.dump(stations, fh)
    assert SN.read_snapshot_files(spark, path + ".json").count() == 4


def _responses(spark):
    hourly = {
        "time": ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00"],
        "temperature_2m": [1.5, None, 2.5],
        "relativehumidity_2m": [80.0, 81.0, 82.0],
        "windspeed_10m": [3.0, 4.0, 5.0],
        "precipitation": [0.0, 0.1, 0.2],
        "visibility": [24000.0, None, 20000.0],
        "snowfall": [0.0, 0.0],  # one value missing at the end
    }
    return spark.createDataFrame([({"hourly": hourly},)], f"r {S.WEATHER_RESPONSE_SCHEMA.simpleString()}").select("r.*")


def test_weather_explode_and_rename(spark):
    flat = WX.rename_weather(WX.explode_hourly(_responses(spark)))
    assert flat.columns == ["timestamp", *S.WEATHER_MEASURES]
    rows = flat.orderBy("timestamp").collect()
    assert [r.timestamp for r in rows] == [dt.datetime(2024, 1, 1, h) for h in range(3)]
    assert rows[1].Temperature is None and rows[0].Temperature == 1.5  # null stays in its hour
    assert rows[2].Snowfall is None  # short array padded, later hours not shifted
    assert rows[1].Visibility is None


def test_weather_rename_keeps_existing_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "2024-01-01T05:00", 1.0)], "timestamp timestamp_ntz, time string, temperature_2m double")
    out = WX.rename_weather(df)
    assert "Time" in out.columns and "timestamp" in out.columns  # only renamed when absent


def test_current_weather(spark):
    cur = WX.current_weather(_responses(spark)).first()
    assert cur.Temperature == 1.5 and cur.Visibility == 24000.0
    empty = spark.createDataFrame([({"time": [], "temperature_2m": []},)], "h struct<time:array<string>,temperature_2m:array<double>,relativehumidity_2m:array<double>,windspeed_10m:array<double>,precipitation:array<double>,visibility:array<double>,snowfall:array<double>>")
    assert WX.current_weather(empty, hourly="h").first().Temperature is None


def test_daily_responses_inverse(spark):
    flat = WX.rename_weather(WX.explode_hourly(_responses(spark))).withColumnRenamed("timestamp", "Time")
    again = WX.rename_weather(WX.explode_hourly(WX.to_daily_responses(flat)))
    a = sorted(map(tuple, flat.collect()))
    b = sorted(map(tuple, again.collect()))
    assert a == b


def test_weather_windows(spark):
    rows = [(dt.datetime(2024, 1, d, 12), float(d)) for d in range(1, 31)]
    w = spark.createDataFrame(rows, "Time timestamp_ntz, Temperature double")
    got = WX.weather_window_for_day(w, dt.date(2024, 1, 20))
    assert got.count() == 15  # [today-14, today]
    readings = spark.createDataFrame([(dt.datetime(2024, 1, 5, 3),), (dt.datetime(2024, 1, 9, 23),)], "timestamp timestamp_ntz")
    days = sorted(r.Time.day for r in WX.weather_window_of_readings(w, readings).collect())
    assert days == [5, 6, 7, 8, 9]


def test_read_landed_weather_responses(spark, scratch):
    import os

    path = scratch("weather").replace("file://", "").replace("file:", "")
    os.makedirs(path, exist_ok=True)
    body = {"latitude": 57.7, "hourly": {
        "time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.0, 2.0],
        "relativehumidity_2m": [90.0, 91.0], "windspeed_10m": [3.0, 4.0], "precipitation": [0.0, 0.5],
        "visibility": [24140.0, None], "snowfall": [0.0, 0.0]}}
    with open(f"{path}/day1.json", "w") as fh:
        json.dump(body, fh, indent=2)  # pretty-printed, as an HTTP body lands
    flat = WX.rename_weather(WX.explode_hourly(WX.read_weather_responses(spark, path)))
    rows = flat.orderBy("timestamp").collect()
    assert [r.Temperature for r in rows] == [1.0, 2.0] and rows[1].Visibility is None


def test_csv_inferred_types(spark, scratch):
    path = scratch("csv3")
    CSV.write_csv(spark.createDataFrame([("a", 1, 2.5), ("b", None, None)], "k string, n int, x double"), path)
    df = CSV.read_csv(spark, path, infer=True)
    assert dict(df.dtypes) == {"k": "string", "n": "int", "x": "double"}
    assert {r.k: (r.n, r.x) for r in df.collect()} == {"a": (1, 2.5), "b": (None, None)}

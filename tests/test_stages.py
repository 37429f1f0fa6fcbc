"""The batch stages end to end on the driver tables."""

import datetime as dt
import json

from velolake.plans import binding as B
from velolake.plans import stages as P

SF = "/root/testdata/sf0.01"


def test_stages_end_to_end(spark, scratch):
    base = scratch("stages")
    out = P.run(spark, B.readings(spark, SF), B.weather(spark, SF), base, dt.date(2024, 1, 20), numTrees=5, maxDepth=4)
    feats = P.read_features(spark, out["features"])
    assert feats.count() > 0
    assert {r.kind for r in feats.select("kind").distinct().collect()} == {"single_bikes", "station_bikes"}
    docs = [spark.read.text(out[f"document_{k}"]).collect() for k in ("station_bikes", "single_bikes")]
    assert [len(d) for d in docs] == [1, 1]
    doc = json.loads(docs[0][0].value)
    assert list(doc) == [
        "number_of_bikes_available", "warmest_temperature", "coldest_temperature", "coldest_day",
        "warmest_day", "day_with_most_used_bikes", "correlation_matrix", "weekend_vs_weekday",
        "weather_over_timestamp",
    ]
    assert len(doc["correlation_matrix"]) == 15 and list(doc["correlation_matrix"][0])[0] == "AvailableBikes"
    assert doc["correlation_matrix"][0]["AvailableBikes"] == 1.0
    assert [r["IsWeekend"] for r in doc["weekend_vs_weekday"]] == ["Weekdays", "Weekend"]
    hours = [r["timestamp"] for r in doc["weather_over_timestamp"]]
    assert hours == sorted(hours) and set(doc["weather_over_timestamp"][0]) == {
        "timestamp", "Humidity", "Wind_Speed", "Temperature", "TotalAvailableBikes"}
    m = spark.read.option("header", "true").csv(out["metrics"]).first()
    assert float(m.MSE) >= 0
    for t in ("correlation", "weekend", "hourly"):
        assert spark.read.option("header", "true").csv(out[t]).count() > 0


def test_splits_written_and_read_back(spark, scratch):
    base = scratch("splits")
    f = B.features(spark, "/root/testdata/sf0.001")
    path = P.write_splits(f, base, "r")
    x_train = P.read_split(spark, path, "train", "features")
    y_train = P.read_split(spark, path, "train", "target")
    x_test = P.read_split(spark, path, "test", "features")
    y_test = P.read_split(spark, path, "test", "target")
    assert x_train.count() + x_test.count() == f.count()
    assert x_train.join(y_train, "readingId").count() == x_train.count()
    assert x_test.join(x_train, "readingId").count() == 0
    assert y_test.columns == ["readingId", "TotalAvailableBikes"]
    assert x_test.columns[1:] == [c for c in __import__("velolake.schemas", fromlist=["x"]).MODEL_FEATURES]


def test_exact_splits(spark, scratch):
    f = B.features(spark, "/root/testdata/sf0.001")
    path = P.write_splits(f, scratch("splits"), "r", test_share=0.01, exact=True)
    counts = [P.read_split(spark, path, s, "target").count() for s in P.SPLITS]
    assert counts[1] == -(-f.count() // 100) and sum(counts) == f.count()

"""ML stage (FIXTURES.md §7) and Structured Streaming ingest."""


import pytest
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.ml import forest as ML
from velolake.plans import binding as B
from velolake.sources import tables as TB
from velolake.streaming import ingest as ING

from conftest import SF_SMALL


def test_scoring_row(spark):
    row = ML.scoring_row(spark, IsOpen=True, Long=11.97, Lat=57.7, Year=2024, Month=1, Day=8, Hour=10, Minute=5,
                         Temperature=3.5, Humidity=80.0, Windspeed=4.0, Precipitation=0.0, Visibility=None,
                         Snowfall=0.0, IsWeekend=0)
    assert row.columns == S.MODEL_FEATURES
    r = row.first()
    assert r.Wind_Speed == 4.0 and r.Visibility is None


def test_regression_metrics_exact_and_evaluator(spark):
    df = spark.createDataFrame([(1, 3, 2), (2, 5, 5), (3, 0, 1), (4, 7, 4)], "readingId long, TotalAvailableBikes int, prediction int")
    m = ML.regression_metrics(df).first()
    # errors -1, 0, 1, -3 ; y mean 3.75
    assert m.n == 4 and m.MAE == 5 / 4 and m.MSE == 11 / 4
    sst = sum((y - 3.75) ** 2 for y in (3, 5, 0, 7))
    assert m.R2 == pytest.approx(1 - 11 / sst, rel=1e-15)
    ev = ML.evaluator_metrics(df)
    assert ev["mae"] == pytest.approx(m.MAE) and ev["mse"] == pytest.approx(m.MSE) and ev["r2"] == pytest.approx(m.R2)


def test_forest_fit_score_save_load(spark, scratch):
    f = B.features(spark, SF_SMALL)
    from velolake.operators import sampling as SA

    train, test = SA.split_by_hash(f, 0.2)
    model = ML.fit(train, numTrees=10, maxDepth=5)
    scored = ML.score(model, test)
    assert scored.count() == test.count()
    assert scored.where(F.col("predictedBikes") != F.bround("prediction", 0).cast("long")).count() == 0
    path = ML.save(model, scratch("model"))
    again = ML.score(ML.load(path), test)
    a = sorted((r.readingId, r.prediction) for r in scored.collect())
    b = sorted((r.readingId, r.prediction) for r in again.collect())
    assert a == b
    # P15 + M3: one row built from named values, scored by the loaded model
    row = ML.scoring_row(spark, IsOpen=True, Long=11.97, Lat=57.7, Year=2024, Month=1, Day=8, Hour=10,
                         Minute=5, Temperature=3.0, Humidity=80.0, Wind_Speed=4.0, Precipitation=0.0,
                         Visibility=None, Snowfall=0.0, IsWeekend=0)
    one = ML.score(ML.load(path), row, keep=()).first()
    assert one.prediction >= 0 and one.predictedBikes == round(one.prediction)


def test_forest_learns_a_signal(spark):
    # the bound label is noise; give it a signal the features carry (Hour)
    f = B.features(spark, "/root/testdata/sf0.01").withColumn(S.LABEL, ((F.col("Hour") % 6) * 3).cast("int"))
    from velolake.operators import sampling as SA

    train, test = SA.split_by_hash(f, 0.2)
    scored = ML.score(ML.fit(train, numTrees=10, maxDepth=6), test)
    mean = train.agg(F.avg(S.LABEL)).first()[0]
    base = ML.regression_metrics(test.select(S.LABEL, F.lit(mean).alias("prediction"))).first()
    got = ML.regression_metrics(scored).first()
    assert got.R2 > 0.5 and got.MSE < 0.5 * base.MSE


def _landing(spark, scratch, name):
    root = scratch(name)
    return f"{root}/landing", f"{root}/sink", f"{root}/ckpt"


def test_stream_ingest_keeps_late_rows_once(spark, scratch):
    landing, sink, ckpt = _landing(spark, scratch, "s1")
    snaps = TB.snapshot_text_from_events(B.events(spark, SF_SMALL))
    newer = "polledAt >= timestamp_ntz'2024-01-16'"
    for seq, half in enumerate((newer, f"NOT {newer}", newer)):  # newer half first, then again
        ING.land_snapshots(snaps.where(half), landing, seq)
        ING.start_ingest(spark, landing, sink, ckpt).awaitTermination()
    out = ING.read_latest(spark, sink)
    assert out.count() == snaps.count()
    assert out.select("stationId", "timestamp").distinct().count() == out.count()


def test_stream_hourly_equals_batch_in_any_order(spark, scratch):
    landing, sink, ckpt = _landing(spark, scratch, "s2")
    ev = B.events(spark, SF_SMALL)
    for half in ("ts >= timestamp_ntz'2024-01-16'", "NOT ts >= timestamp_ntz'2024-01-16'"):
        ING.land_snapshots(TB.snapshot_text_from_events(ev.where(half)), landing)
        ING.start_hourly(spark, landing, sink, ckpt).awaitTermination()
    stream = {r.hour: (r.readings, r.availableBikes) for r in ING.read_hourly(spark, sink).collect()}
    r = B.readings(spark, SF_SMALL)
    from velolake.functions import columns as C

    batch = {
        x.hour: (x.n, x.b)
        for x in r.groupBy(C.hour_floor("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("n"), F.sum("AvailableBikes").alias("b")).collect()
    }
    last = max(batch)
    assert stream == batch
    closed = ING.read_hourly(spark, sink, before=last.isoformat(sep=" "))
    assert {r.hour for r in closed.collect()} == {h for h in batch if h < last}


def test_stream_upsert_last_delivery_wins(spark, scratch):
    landing, sink, ckpt = _landing(spark, scratch, "s3")
    ev = B.events(spark, SF_SMALL)
    ING.land_snapshots(TB.snapshot_text_from_events(ev), landing, 0)
    ING.start_upsert(spark, landing, sink, ckpt).awaitTermination()
    # a later micro-batch with corrections
    ING.land_snapshots(TB.snapshot_text_from_events(ev.withColumn("value", F.col("value") + 1)), landing, 1)
    ING.start_upsert(spark, landing, sink, ckpt).awaitTermination()
    out = ING.read_latest(spark, sink)
    want = TB.readings_from_events(ev.withColumn("value", F.col("value") + 1))
    assert out.count() == ev.count()
    got = sorted(int(r.AvailableBikes) for r in out.collect())
    assert got == sorted(r.AvailableBikes for r in want.collect())


def test_task_memory_sizing(spark):
    assert ML._mb("1g") == 1024 and ML._mb("512m") == 512 and ML._mb("2048") == 2048 and ML._mb("4gb") == 4096
    mb = ML.task_memory_mb(spark)
    assert 16 <= mb <= 256


def test_forest_deterministic_per_seed(spark):
    from velolake.operators import sampling as SA

    train, test = SA.split_by_hash(B.features(spark, SF_SMALL), 0.2)
    a = ML.score(ML.fit(train, numTrees=8, maxDepth=5, seed=7), test)
    b = ML.score(ML.fit(train, numTrees=8, maxDepth=5, seed=7), test)
    assert sorted((r.readingId, r.prediction) for r in a.collect()) == sorted((r.readingId, r.prediction) for r in b.collect())


def test_scoring_rows_of_a_batch(spark):
    df = spark.createDataFrame([(1, 57.7, 3.5, None, True), (2, None, None, 4.0, False)], "id int, Lat double, Windspeed double, Wind_Speed double, IsOpen boolean")
    rows = ML.scoring_rows(df, keep=["id"])
    assert rows.columns == ["id", *S.MODEL_FEATURES]
    got = [(r.id, r.Lat, r.Wind_Speed, r.Visibility) for r in rows.orderBy("id").collect()]
    assert got == [(1, 57.7, 3.5, None), (2, None, 4.0, None)]  # the name comes before its alias


def test_forest_rows_meet_all_cores(spark, monkeypatch):
    """Rows of one split are dealt over the cores for MLlib's passes, all of
    them, and arrive in the same order each time."""

    class Stages:
        def fit(self, data):
            return data

    monkeypatch.setattr(ML, "forest_stages", lambda **_: Stages())
    row = ML.scoring_rows(spark.range(20_000, numPartitions=1).withColumn("Hour", F.col("id") % 24).withColumn("Lat", F.col("id") / 7), keep=["id"])
    train = row.withColumn(S.LABEL, (F.col("id") % 25).cast("int"))
    data = ML.fit(train)
    parts = [[tuple(r) for r in p] for p in data.rdd.glom().collect()]
    cores = spark.sparkContext.defaultParallelism
    assert train.rdd.getNumPartitions() == 1 and len(parts) == min(cores, 20_000 // ML.LEAST_ROWS + 1)
    assert max(map(len, parts)) <= 1.01 * min(map(len, parts)) + 1 and "id" not in data.columns
    names = [c for c in data.columns]
    assert sorted(map(str, train.withColumn(S.LABEL, F.col(S.LABEL).cast("double")).select(names).collect())) == sorted(map(str, data.collect()))
    assert [[tuple(r) for r in p] for p in ML.fit(train).rdd.glom().collect()] == parts

"""State per day merged for any window, against the direct operators."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from velolake.operators import correlation as CORR
from velolake.operators import daily_state as DS
from velolake.operators import metrics as M
from velolake.plans import binding as B


@pytest.fixture(scope="module")
def state(spark):
    """(features, path of their state)."""
    from velolake.session import scratch_path

    root = scratch_path(spark, "daily-state")
    B.features(spark, "/root/testdata/sf0.01").withColumn(DS.DAY, F.to_date("timestamp")).write.partitionBy(DS.DAY).parquet(f"{root}/features")
    features = spark.read.parquet(f"{root}/features")
    return features, DS.update_state(features, f"{root}/state")


WINDOWS = [(None, None), (dt.date(2024, 1, 5), dt.date(2024, 1, 19)), (dt.date(2024, 1, 9), dt.date(2024, 1, 10))]


def within(features, start, end):
    f = features if start is None else features.where(F.col(DS.DAY) >= F.lit(start))
    return f if end is None else f.where(F.col(DS.DAY) < F.lit(end))


@pytest.mark.parametrize("start, end", WINDOWS)
def test_merged_pack_equals_direct(spark, state, start, end):
    features, path = state
    got = DS.merged_pack(DS.read_state(spark, path, "pack", start, end)).collect()
    want = M.metrics_pack(within(features, start, end)).select(got[0].__fields__ if got else "*").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 2


@pytest.mark.parametrize("start, end", WINDOWS)
def test_merged_correlation_equals_direct(spark, state, start, end):
    features, path = state
    key = lambda r: (r.kind, r.colA, r.colB)
    got = {key(r): r["corr"] for r in DS.merged_correlation(DS.read_state(spark, path, "moments", start, end)).collect()}
    want = {key(r): r["corr"] for r in CORR.correlation_long(within(features, start, end)).collect()}
    assert set(got) == set(want)
    assert all((got[k] is None) == (want[k] is None) and (got[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)


def test_a_group_far_from_the_mean_keeps_its_digits(spark, scratch):
    # a group near 1e9 with a spread of 1 beside one near 0: deviations from
    # the whole table's mean would lose them
    r = np.random.default_rng(1)
    x, e = r.normal(size=400), r.normal(size=400)
    rows = [("far", dt.date(2024, 1, 1 + k % 4), 1e9 + float(x[k]), 1e9 + float(x[k] + e[k])) for k in range(400)]
    rows += [("near", dt.date(2024, 1, 1 + k % 4), float(k), None if k % 3 else float(k * k)) for k in range(400)]
    df = spark.createDataFrame(rows, "kind string, readingDate date, a double, b double")
    state = DS.moment_state(df, ("a", "b"))
    got = {r.kind: r["corr"] for r in DS.merged_correlation(state, ("a", "b")).where("colA = 'a' AND colB = 'b'").collect()}
    xs = np.array([q[2] for q in rows[:400]]) - 1e9
    ys = np.array([q[3] for q in rows[:400]]) - 1e9
    assert abs(got["far"] - np.corrcoef(xs, ys)[0, 1]) < 1e-6
    k = np.arange(0, 400, 3.0)
    assert abs(got["near"] - np.corrcoef(k, k * k)[0, 1]) < 1e-9


def test_constant_columns_and_missing_groups(spark):
    rows = [(None, dt.date(2024, 1, 1), 5.0, 1.0), (None, dt.date(2024, 1, 2), 5.0, 2.0), ("x", dt.date(2024, 1, 1), 1.0, float("nan"))]
    state = DS.moment_state(spark.createDataFrame(rows, "kind string, readingDate date, a double, b double"), ("a", "b"))
    got = {(r.colA, r.colB): r["corr"] for r in DS.merged_correlation(state, ("a", "b")).where("kind IS NULL").collect()}
    assert got == {("a", "a"): None, ("a", "b"): None, ("b", "a"): None, ("b", "b"): 1.0}


def test_only_new_days_are_read(spark, state, scratch):
    features, path = state
    day = dt.date(2024, 1, 9)
    one = features.where(F.col(DS.DAY).isin([day]))
    assert len(one.inputFiles()) == len(features.inputFiles())  # the plan prunes, not the list
    plan = DS.pack_state(one)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "readingDate" in plan.split("PartitionFilters")[1][:120]
    other = scratch("state")
    DS.update_state(features, other, [day])
    DS.update_state(features, other, [dt.date(2024, 1, 10)])
    DS.update_state(features, other, [day])  # again: overwrites itself
    days = {r[0] for r in DS.read_state(spark, other, "pack").select(DS.DAY).distinct().collect()}
    assert days == {day, dt.date(2024, 1, 10)}
    rows = DS.read_state(spark, other, "pack").where("what = 'rows'").agg(F.sum("n")).first()[0]
    assert rows == features.where(F.col(DS.DAY).isin(sorted(days))).count()


def test_sketch_is_within_its_error(spark):
    rows = spark.range(60_000).selectExpr("'k' AS kind", "date_add(date'2024-01-01', cast(id % 7 as int)) AS readingDate", "concat('s', id % 20011) AS stationId")
    got = DS.merged_stations(DS.sketch_state(rows)).first()
    assert got.days == 7 and abs(got.stations - 20011) <= 3 * got.standardError and got.standardError < 0.02 * got.stations
    small = DS.merged_stations(DS.sketch_state(B.features(spark, SF_SMALL).withColumn(DS.DAY, F.to_date("timestamp"))))
    exact = {r.kind: r.n for r in B.features(spark, SF_SMALL).groupBy("kind").agg(F.count_distinct("stationId").alias("n")).collect()}
    assert {r.kind: r.stations for r in small.collect()} == exact  # few: counted exactly

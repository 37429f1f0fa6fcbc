"""Property tests: operators against brute-force pandas on random rows."""

import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from velolake.operators import dedupe as DD
from velolake.operators import metrics as M

T0 = dt.datetime(2024, 1, 1)

row = st.tuples(
    st.sampled_from(["single_bikes", "station_bikes"]),
    st.sampled_from(["a", "b", "c", "d"]),
    st.integers(min_value=0, max_value=60 * 30),  # minutes after T0
    st.integers(min_value=-20, max_value=30),  # temperature in whole degrees
    st.integers(min_value=0, max_value=20),
)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    data = [(k, s, T0 + dt.timedelta(minutes=m), float(t), b, i) for i, (k, s, m, t, b) in enumerate(rows)]
    sdf = spark.createDataFrame(data, "kind string, stationId string, timestamp timestamp_ntz, Temperature double, AvailableBikes int, seq int")
    pdf = pd.DataFrame(data, columns=["kind", "stationId", "timestamp", "Temperature", "AvailableBikes", "seq"])
    return sdf, pdf


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_metrics_pack_matches_pandas(spark, rows):
    sdf, pdf = frame(spark, rows)
    got = {r.kind: r for r in M.metrics_pack(sdf).collect()}
    for kind, g in pdf.groupby("kind"):
        r = got[kind]
        assert r.rows == len(g) and r.numStations == g.stationId.nunique()
        assert r.warmestTemperature == g.Temperature.max() and r.coldestTemperature == g.Temperature.min()
        # ties: the earliest timestamp
        assert r.warmestDay == g[g.Temperature == g.Temperature.max()].timestamp.min()
        assert r.coldestDay == g[g.Temperature == g.Temperature.min()].timestamp.min()
        slots = g.timestamp.dt.floor("10min").value_counts()
        assert r.busiestTime == min(slots[slots == slots.max()].index)


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_hourly_resample_matches_pandas(spark, rows):
    sdf, pdf = frame(spark, rows)
    sdf = sdf.withColumnRenamed("AvailableBikes", "TotalAvailableBikes")
    got = {(r.kind, r.hour): (r.Temperature, r.TotalAvailableBikes) for r in M.hourly_resample(sdf, means=("Temperature",)).collect()}
    want = {}
    for kind, g in pdf.groupby("kind"):
        res = g.resample("h", on="timestamp").agg({"Temperature": "mean", "AvailableBikes": "sum"})
        for hour, v in res.iterrows():
            want[(kind, hour.to_pydatetime())] = (None if pd.isna(v.Temperature) else v.Temperature, int(v.AvailableBikes))
    assert set(got) == set(want)
    for k, (t, b) in want.items():
        assert got[k][1] == b
        assert (got[k][0] is None and t is None) or got[k][0] == pytest.approx(t, rel=1e-12)


@SETTINGS
@given(st.lists(row, min_size=1, max_size=40))
def test_latest_per_key_matches_pandas(spark, rows):
    sdf, pdf = frame(spark, rows)
    sdf = sdf.withColumn("hour", sdf.timestamp.cast("date"))
    pdf["hour"] = pdf.timestamp.dt.date
    got = {(r.stationId, r.hour): r.seq for r in DD.latest_per_key(sdf, ["stationId", "hour"], "seq").collect()}
    want = {k: int(g.seq.max()) for k, g in pdf.groupby(["stationId", "hour"])}
    assert got == want

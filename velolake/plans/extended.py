"""Registered queries of streams with state, exact splits and stored state,
each with an independent SQL formulation (see :mod:`velolake.plans.registry`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velolake import schemas as S
from velolake.functions import columns as C
from velolake.ml import forest as ML
from velolake.operators import daily_state as DS
from velolake.operators import sampling as SA
from velolake.plans import binding as B
from velolake.plans import oracle as O
from velolake.session import at_once, scratch_path
from velolake.sinks import documents as DOC
from velolake.sources import csv as CSV
from velolake.sources import quarantine as QU
from velolake.sources import store as ST
from velolake.sources import tables as TB
from velolake.sources import weather_source as WS
from velolake.streaming import event_time as EV
from velolake.streaming import ingest as ING
from velolake.streaming import scoring as SC

TEST_SHARE = 0.2
HALF = "2024-01-16"


def stored_features(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    B.features(spark, sf, dealt=True).write.parquet(path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------------------
# Streams in event time
# ---------------------------------------------------------------------------
def _routed_and_settled(spark: SparkSession, sf: str, name: str) -> dict[str, str]:
    """Readings in two runs of the streams.  First the newer half, with a
    corrected second delivery of the even readings that lands before the
    first one; then the older half, all of it late, every third reading
    delivered again with a correction."""
    root = scratch_path(spark, name)
    at = {k: f"{root}/{k}" for k in ("landing", "routed", "settled", "hours")}
    events = B.events(spark, sf)
    corrected = events.withColumn("value", F.col("value") + 1)
    newer = f"ts >= timestamp_ntz'{HALF}'"
    for half, nth in ((newer, 2), (f"NOT {newer}", 3)):
        ING.land_snapshots(TB.snapshot_text_from_events(corrected.where(half).where(F.col("event_id") % nth == 0)), at["landing"], 1)
        ING.land_snapshots(TB.snapshot_text_from_events(events.where(half)), at["landing"], 0)
        EV.start_routing(spark, at["landing"], at["routed"], f"{root}/c1").awaitTermination()
        EV.start_settling(spark, at["routed"], at["settled"], f"{root}/c2").awaitTermination()
        EV.start_hours(spark, at["settled"], at["hours"], f"{root}/c3").awaitTermination()
    return at


_DELIVERED = f"""
r AS (SELECT COALESCE(NULLIF({O.NAME}, ''), {O.SID}) AS stationId, ts, ts < TIMESTAMP '{HALF} 00:00:00' AS late, event_id,
             event_id % CASE WHEN ts < TIMESTAMP '{HALF} 00:00:00' THEN 3 ELSE 2 END = 0 AS corrected,
             CAST(floor(value + CASE WHEN event_id % CASE WHEN ts < TIMESTAMP '{HALF} 00:00:00' THEN 3 ELSE 2 END = 0 THEN 1 ELSE 0 END) AS BIGINT) % 25 AS bikes
      FROM events),
w AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 30 MINUTE AS mark FROM r WHERE NOT late),
known AS (SELECT * FROM r WHERE late OR ts <= (SELECT mark FROM w))"""


def stream_settled(spark, sf):
    """T-1: the last delivery of every reading that has settled in the state
    store, or came too late for it."""
    at = _routed_and_settled(spark, sf, "stream_settled")
    out = EV.read_corrected(spark, at["settled"], at["routed"])
    return out.select("stationId", F.col("eventTime").cast("timestamp_ntz").alias("timestamp"), "landedSeq", "AvailableBikes", "late")


SQL_STREAM_SETTLED = f"""WITH {_DELIVERED}
SELECT stationId, ts AS timestamp, CAST(corrected AS INTEGER) AS landedSeq, bikes AS AvailableBikes, late FROM known"""


def stream_event_hours(spark, sf):
    """A7 in event time: closed hours with what late readings change."""
    at = _routed_and_settled(spark, sf, "stream_event_hours")
    hours = EV.read_hours(spark, at["hours"], at["settled"], at["routed"])
    return hours.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


SQL_STREAM_EVENT_HOURS = f"""WITH {_DELIVERED}
SELECT date_trunc('hour', ts) AS hour, count(*) AS readings, CAST(sum(bikes) AS BIGINT) AS availableBikes,
       CAST(sum(CASE WHEN late THEN 1 + CAST(corrected AS INTEGER) ELSE 0 END) AS BIGINT) AS lateReadings
FROM known WHERE ts < (SELECT date_trunc('hour', max(ts)) FROM known WHERE NOT late)
GROUP BY date_trunc('hour', ts)"""


# ---------------------------------------------------------------------------
# Scores in a stream
# ---------------------------------------------------------------------------
STREAM_FOREST = {"numTrees": 10, "maxDepth": 6}


def stream_scores(spark, sf):
    """M3 + K8: snapshots scored as they land by a saved model, against the
    batch scores of the same readings."""
    root = scratch_path(spark, "stream_scores")
    features = stored_features(spark, sf, "stream-scores-features")
    model = ML.fit(SA.split_by_hash(features, TEST_SHARE)[0], **STREAM_FOREST)
    path = ML.save(model, f"{root}/model")
    ING.land_snapshots(TB.snapshot_text_from_events(B.events(spark, sf)), f"{root}/landing")
    SC.start_live_scoring(spark, f"{root}/landing", lambda: B.weather(spark, sf), path, f"{root}/scores", f"{root}/checkpoint").awaitTermination()
    live = spark.read.parquet(f"{root}/scores").select("readingId", F.col("prediction").alias("live"), F.col("predictedBikes").alias("liveBikes"))
    batch = SC.score_complete(model, B.features_left(spark, sf), label=None)
    both = live.join(batch, "readingId", "full")
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("prediction").alias("scored"),
        F.count_if(~F.col("live").eqNullSafe(F.col("prediction")) | ~F.col("liveBikes").eqNullSafe(F.col("predictedBikes"))).alias("differing"),
    )


SQL_STREAM_SCORES = O.BASE + """
SELECT count(*) AS n, count(Temperature) AS scored, 0::BIGINT AS differing FROM joined_left"""


# ---------------------------------------------------------------------------
# Splits of an exact size
# ---------------------------------------------------------------------------
def exact_split(spark, sf):
    """M1: exactly ceil(0.2 * rows) test rows."""
    train, test = SA.split_exact(stored_features(spark, sf, "exact-split"), TEST_SHARE)
    side = lambda df, name: df.select("readingId", S.LABEL, F.lit(name).alias("split"))
    return side(train, "train").unionByName(side(test, "test"))


SQL_EXACT_SPLIT = O.BASE + f""", ranked AS (
  SELECT readingId, TotalAvailableBikes, row_number() OVER (ORDER BY md5(CAST(readingId AS VARCHAR))) AS k, count(*) OVER () AS n FROM features)
SELECT readingId, TotalAvailableBikes, CASE WHEN k <= ceil(CAST({TEST_SHARE} AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split FROM ranked"""


# ---------------------------------------------------------------------------
# State per day
# ---------------------------------------------------------------------------
SINCE, UNTIL = dt.date(2024, 1, 7), dt.date(2024, 1, 21)
IN_WINDOW = f"timestamp >= TIMESTAMP '{SINCE} 00:00:00' AND timestamp < TIMESTAMP '{UNTIL} 00:00:00'"


def _daily_state(spark: SparkSession, sf: str, name: str) -> str:
    """State of all days in two increments; the second one writes a day of
    the first again."""
    root = scratch_path(spark, name)
    dated = B.features(spark, sf).withColumn(DS.DAY, F.to_date("timestamp"))
    dated.write.partitionBy(DS.DAY).parquet(f"{root}/features")
    features = spark.read.parquet(f"{root}/features")
    days = sorted(r[0] for r in features.select(DS.DAY).distinct().collect())  # the calendar
    half = len(days) // 2
    for part in (days[: half + 1], days[half:]):
        DS.update_state(features, f"{root}/state", part)
    return f"{root}/state"


def pack_by_days(spark, sf):
    """A10 by increments: the metrics pack of two weeks from its days."""
    path = _daily_state(spark, sf, "pack_by_days")
    return DS.merged_pack(DS.read_state(spark, path, "pack", SINCE, UNTIL))


SQL_PACK_BY_DAYS = O.BASE + f""", f AS (SELECT * FROM features WHERE {IN_WINDOW}),
slots AS (SELECT kind, {O.SLOT} AS slot, count(*) AS n FROM f GROUP BY ALL)
SELECT kind, count(*) AS rows, count(DISTINCT stationId) AS numStations,
       max(Temperature) AS warmestTemperature, min(Temperature) AS coldestTemperature,
       (SELECT min(timestamp) FROM f g WHERE g.kind = f.kind AND g.Temperature = max(f.Temperature)) AS warmestDay,
       (SELECT min(timestamp) FROM f g WHERE g.kind = f.kind AND g.Temperature = min(f.Temperature)) AS coldestDay,
       (SELECT slot FROM slots s WHERE s.kind = f.kind ORDER BY n DESC, slot LIMIT 1) AS busiestTime
FROM f GROUP BY kind"""


def correlation_by_days(spark, sf):
    """A5 by increments: the correlation matrix of two weeks from the
    co-moments of its days."""
    path = _daily_state(spark, sf, "correlation_by_days")
    merged = DS.merged_correlation(DS.read_state(spark, path, "moments", SINCE, UNTIL))
    return merged.withColumn("corr", F.round("corr", 6) + F.lit(0.0))


SQL_CORRELATION_BY_DAYS = O.correlation_sql().replace("FROM features WHERE", f"FROM features WHERE {IN_WINDOW} AND")


def stations_by_days(spark, sf):
    """A1: the stations of two weeks as sketches of its days estimate them;
    the estimate is given as whether it lies within three standard errors of
    the exact number, which the stored state has as well."""
    path = _daily_state(spark, sf, "stations_by_days")
    sketch = DS.merged_stations(DS.read_state(spark, path, "sketch", SINCE, UNTIL))
    exact = DS.merged_pack(DS.read_state(spark, path, "pack", SINCE, UNTIL)).select("kind", "numStations")
    near = F.abs(F.col("stations") - F.col("numStations")) <= F.greatest(3 * F.col("standardError"), F.lit(1.0))
    return exact.join(sketch, "kind").select("kind", "numStations", "days", near.alias("estimateNear"))


SQL_STATIONS_BY_DAYS = O.BASE + f"""
SELECT kind, count(DISTINCT stationId) AS numStations, count(DISTINCT CAST(timestamp AS DATE)) AS days, TRUE AS estimateNear
FROM features WHERE {IN_WINDOW} GROUP BY kind"""


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------
RADIUS_M = 2500.0


def geo_radius_stored(spark, sf):
    """S6 on stored data: the circle as ranges of cells."""
    path = ST.write_by_cell(B.readings(spark, sf), scratch_path(spark, "geo_radius_stored"))
    near = ST.within_radius_stored(spark.read.parquet(path), radius_m=RADIUS_M, distance_col=None)
    return near.select("readingId", "stationId")


SQL_GEO_RADIUS_STORED = O.BASE + f"""
SELECT readingId, stationId FROM readings
WHERE {O.haversine_sql('Lat', 'Long', S.STATION_CENTER_LAT, S.STATION_CENTER_LON)} <= {RADIUS_M}"""


def weather_source(spark, sf):
    """S5 as a data source: landed days, the range and two fields taken by
    the source."""
    path = WS.land_weather(B.weather(spark, sf), scratch_path(spark, "weather_source"))
    rows = WS.read_landed_weather(spark, path, SINCE, UNTIL - dt.timedelta(days=1), S.WEATHER_SOURCE_FIELDS[1:3])
    return rows.toDF("day", "Time", "Temperature", "Humidity")


SQL_WEATHER_SOURCE = O.BASE + f"""
SELECT CAST(Time AS DATE) AS day, Time, Temperature, Humidity FROM weather
WHERE Time >= TIMESTAMP '{SINCE} 00:00:00' AND Time < TIMESTAMP '{UNTIL} 00:00:00'"""


PER_FILE = 500  # stations of a landed file


def json_quarantine(spark, sf):
    """Multi-line snapshot files, some cut off; per outcome the files
    and their records."""
    root = scratch_path(spark, "json_quarantine")
    snaps = TB.snapshot_text_from_events(B.events(spark, sf)).withColumn("chunk", F.floor(F.col("pollId") / PER_FILE))
    station = F.regexp_replace(F.substring("payload", 2, 1 << 20), r"\]$", "")
    text = snaps.groupBy("chunk").agg(F.array_join(F.sort_array(F.collect_list(station)), ",\n  ").alias("t"))
    whole = F.concat(F.lit("[\n  "), F.col("t"), F.lit("\n]"))
    landed = text.select(F.when(F.col("chunk") % 7 == 3, F.substring(whole, 1, 300)).otherwise(whole).alias("value"))
    landed.write.option("maxRecordsPerFile", 1).text(root)
    got = QU.read_json_quarantined(spark, root, S.STATION_SCHEMA, required=("StationId", "Name"))
    outcome = F.when(F.col("aside") > 0, "set aside").otherwise("kept")
    return got.files.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("files"), F.sum("kept").alias("records"))


SQL_JSON_QUARANTINE = f"""
WITH c AS (SELECT event_id // {PER_FILE} AS chunk, count(*) AS n FROM events GROUP BY 1)
SELECT CASE WHEN chunk % 7 = 3 THEN 'set aside' ELSE 'kept' END AS outcome, count(*) AS files,
       CAST(sum(CASE WHEN chunk % 7 = 3 THEN 0 ELSE n END) AS BIGINT) AS records
FROM c GROUP BY 1"""


def csv_quarantine(spark, sf):
    """S3: rows with a field too many, counts that are no numbers and times
    that do not parse, set aside by reason; the kept ones are summed."""
    path = scratch_path(spark, "csv_quarantine")
    rows = B.readings(spark, sf).select("readingId", "stationId", C.as_text("timestamp", "timestamp_ntz").alias("timestamp"), F.col("AvailableBikes").cast("string").alias("AvailableBikes"))
    k = F.col("readingId")
    rows = rows.withColumn("AvailableBikes", F.when(k % 17 == 0, "many").otherwise(F.col("AvailableBikes")))
    rows = rows.withColumn("timestamp", F.when(k % 19 == 0, "soon").otherwise(F.col("timestamp")))
    line = F.concat_ws(",", "readingId", "stationId", "timestamp", "AvailableBikes", F.when(k % 13 == 0, "more"))
    # the header stands first in each file, as the writer of landed files puts it
    head = F.lit("readingId,stationId,timestamp,AvailableBikes")
    files = rows.select(line.alias("l"), F.floor(k / PER_FILE).alias("file")).groupBy("file").agg(F.array_join(F.collect_list("l"), "\n").alias("t"))
    files.select(F.concat_ws("\n", head, "t").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    schema = "readingId long, stationId string, timestamp timestamp_ntz, AvailableBikes int"
    got = QU.read_csv_quarantined(spark, path, spark.createDataFrame([], schema).schema)
    kept = got.kept.agg(F.lit("kept").alias("outcome"), F.count(F.lit(1)).alias("n"), F.sum("AvailableBikes").cast("long").alias("bikes"))
    return kept.unionByName(got.aside.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("bikes")))


SQL_CSV_QUARANTINE = O.BASE + """, o AS (
  SELECT *, CASE WHEN readingId % 13 = 0 THEN 'malformed' WHEN readingId % 19 = 0 THEN 'bad timestamp'
                 WHEN readingId % 17 = 0 THEN 'bad AvailableBikes' ELSE 'kept' END AS outcome FROM readings)
SELECT outcome, count(*) AS n, CASE WHEN outcome = 'kept' THEN CAST(sum(AvailableBikes) AS BIGINT) END AS bikes FROM o GROUP BY outcome"""


# ---------------------------------------------------------------------------
# The dashboard's files
# ---------------------------------------------------------------------------
_SCALARS = ("number_of_bikes_available", "warmest_temperature", "coldest_temperature", "warmest_day", "coldest_day", "day_with_most_used_bikes")
_HOUR_FIELDS = ("Humidity", "Wind_Speed", "Temperature", S.LABEL)
DOCUMENT_SCHEMA = ", ".join(
    [f"{n} string" for n in _SCALARS]
    + [f"correlation_matrix array<struct<{', '.join(f'{c}: double' for c in S.CORRELATION_COLUMNS)}>>", "weekend_vs_weekday array<struct<IsWeekend: string, AvailableBikes: double>>"]
    + [f"weather_over_timestamp array<struct<timestamp: string, {', '.join(f'{c}: double' for c in _HOUR_FIELDS)}>>"]
)


def document_rows(spark, sf):
    """K5 + P14: the documents written, read back and taken apart: ``kind,
    part, item`` (its place), ``name, text, number``."""
    base = scratch_path(spark, "document_rows")
    paths = DOC.write_documents(DOC.metrics_document(parts=DOC.stored_parts(B.features(spark, sf))), base, "all")
    read = None
    for kind, path in paths.items():
        one = spark.read.text(path).select(F.lit(kind).alias("kind"), F.from_json("value", DOCUMENT_SCHEMA).alias("d"))
        read = one if read is None else read.unionByName(one)
    nothing, row = F.lit(None).cast("double"), lambda name, text, number: F.struct(F.lit(name).alias("name"), text.alias("text"), number.alias("number"))
    number = lambda c: F.round(c, 6) + F.lit(0.0)
    scalars = read.select("kind", F.lit("scalar").alias("part"), F.lit(0).alias("item"), F.inline(F.array(*[row(n, F.col(f"d.{n}"), nothing) for n in _SCALARS])))
    parts = {
        "correlation": ("correlation_matrix", [row(c, F.lit(None).cast("string"), number(F.col(f"col.{c}"))) for c in S.CORRELATION_COLUMNS]),
        "weekend": ("weekend_vs_weekday", [row("AvailableBikes", F.col("col.IsWeekend"), number(F.col("col.AvailableBikes")))]),
        "hours": ("weather_over_timestamp", [row(c, F.col("col.timestamp"), number(F.col(f"col.{c}"))) for c in _HOUR_FIELDS]),
    }
    out = scalars
    for part, (field, rows) in parts.items():
        items = read.select("kind", F.posexplode(f"d.{field}"))
        out = out.unionByName(items.select("kind", F.lit(part).alias("part"), (F.col("pos") + 1).alias("item"), F.inline(F.array(*rows))))
    return out


def _text(ts: str) -> str:
    return f"(strftime({ts}, '%Y-%m-%d %H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' ELSE strftime({ts}, '.%f') END)"


def document_rows_sql(pack: str, correlation: str, weekend: str, hours: str) -> str:
    """From the SQL of the four metrics, each a query of its own."""
    values = {
        "number_of_bikes_available": "CAST(numStations AS VARCHAR)", "warmest_temperature": "CAST(warmestTemperature AS VARCHAR)", "coldest_temperature": "CAST(coldestTemperature AS VARCHAR)",
        "warmest_day": _text("warmestDay"), "coldest_day": _text("coldestDay"), "day_with_most_used_bikes": _text("busiestTime"),
    }
    scalars = " UNION ALL ".join(f"SELECT kind, 'scalar' AS part, 0 AS item, '{n}' AS name, {v} AS text, NULL::DOUBLE AS number FROM pack" for n, v in values.items())
    places = ", ".join(f"'{c}'" for c in S.CORRELATION_COLUMNS)
    fields = " UNION ALL ".join(
        f"SELECT kind, 'hours', CAST(row_number() OVER (PARTITION BY kind ORDER BY hour) AS INTEGER), '{c}', {_text('hour')}, round(CAST({c} AS DOUBLE), 6) + 0.0 FROM hours" for c in _HOUR_FIELDS
    )
    return f"""WITH pack AS ({pack}), corr AS ({correlation}), week AS ({weekend}), hours AS ({hours})
{scalars}
UNION ALL SELECT kind, 'correlation', CAST(list_position([{places}], colA) AS INTEGER), colB, NULL, corr FROM corr
UNION ALL SELECT kind, 'weekend', CAST(row_number() OVER (PARTITION BY kind ORDER BY dayType) AS INTEGER), 'AvailableBikes', dayType, round(meanAvailableBikes, 6) + 0.0 FROM week
UNION ALL {fields}"""


def side_table_rows(spark, sf):
    """K7: all three side tables written as CSV, read back by their names."""
    paths = DOC.write_side_tables(None, scratch_path(spark, "side_table_rows"), "all", DOC.stored_parts(B.features(spark, sf)))
    read = lambda name, schema: CSV.read_csv(spark, paths[name], spark.createDataFrame([], schema).schema)
    number = lambda c: (F.round(c, 6) + F.lit(0.0)).alias("number")
    table = lambda df, part, a, b, value: df.select("kind", F.lit(part).alias("part"), a.cast("string").alias("a"), b.alias("b"), number(value))
    out = table(read("correlation", "kind string, colA string, colB string, corr double"), "correlation", F.col("colA"), F.col("colB"), F.col("corr"))
    out = out.unionByName(table(read("weekend", "kind string, dayType string, meanAvailableBikes double"), "weekend", F.col("dayType"), F.lit(None).cast("string"), F.col("meanAvailableBikes")))
    hours = read("hourly", "kind string, hour string, " + ", ".join(f"{c} double" for c in _HOUR_FIELDS))
    for c in _HOUR_FIELDS:
        out = out.unionByName(table(hours, "hours", F.col("hour"), F.lit(c), F.col(c)))
    return out


def side_table_rows_sql(correlation: str, weekend: str, hours: str) -> str:
    fields = " UNION ALL ".join(f"SELECT kind, 'hours', {_text('hour')}, '{c}', round(CAST({c} AS DOUBLE), 6) + 0.0 FROM hours" for c in _HOUR_FIELDS)
    return f"""WITH corr AS ({correlation}), week AS ({weekend}), hours AS ({hours})
SELECT kind, 'correlation' AS part, colA AS a, colB AS b, corr AS number FROM corr
UNION ALL SELECT kind, 'weekend', dayType, NULL, round(meanAvailableBikes, 6) + 0.0 FROM week
UNION ALL {fields}"""


# ---------------------------------------------------------------------------
# The forest as it is used
# ---------------------------------------------------------------------------
def forest_checked(spark, sf):
    """M2 + M3 + K8: the forest with its defaults (100 trees, full depth),
    taught a label that hour, weekend and place explain.  Test rows; rows that
    a second fit or the saved and reloaded model scores otherwise; rows scored
    outside of the label's range; whether its squared error is over a tenth of
    that of the hours' means."""
    features = stored_features(spark, sf, "forest-checked")
    taught = features.withColumn(S.LABEL, ((F.col("Hour") % 6) * 2 + F.col("IsWeekend") * 6 + F.when(F.col("Lat") > 57.725, 4).otherwise(0)).cast("int"))
    train, test = SA.split_exact(taught, TEST_SHARE)

    def scores(model, name):
        return ML.score(model, test, label=None).select("readingId", F.col("prediction").alias(name))

    def scored_and_reloaded():
        model = ML.fit(train)
        path = ML.save(model, scratch_path(spark, "forest-checked-model"))
        return ML.score(model, test), scores(ML.load(path), "reloaded")

    # side by side: a fit is many short jobs, that leave cores idle between them
    (scored, reloaded), again, means = at_once(
        spark, scored_and_reloaded, lambda: scores(ML.fit(train), "again"), lambda: ML.score_baseline(ML.hour_baseline(train), test)
    )
    for other in (again, reloaded):
        scored = scored.join(other, "readingId", "left")
    baseline = means.select("readingId", F.col("prediction").alias("mean"))
    error = lambda c: F.sum((F.col(c) - F.col(S.LABEL)) ** 2)
    same = F.col("prediction").eqNullSafe(F.col("again")) & F.col("prediction").eqNullSafe(F.col("reloaded"))
    return scored.join(baseline, "readingId").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("differing"), F.count_if(~F.col("prediction").between(0, 20)).alias("outside"),
        (error("prediction") > 0.1 * error("mean")).alias("worse"),
    )


SQL_FOREST_CHECKED = O.BASE + f"""
SELECT CAST(ceil(CAST({TEST_SHARE} AS DOUBLE) * count(*)) AS BIGINT) AS n, 0::BIGINT AS differing, 0::BIGINT AS outside, FALSE AS worse FROM features"""


def scoring_batch(spark, sf):
    """P15 for a batch: rows with the source's name for the wind and without
    Visibility as rows of the model."""
    named = B.features(spark, sf).withColumnRenamed("Wind_Speed", "Windspeed").drop("Visibility")
    return ML.scoring_rows(named, keep=["readingId"])


SQL_SCORING_BATCH = O.BASE + f"""
SELECT readingId, {", ".join("NULL::DOUBLE AS Visibility" if c == "Visibility" else c for c in S.MODEL_FEATURES)} FROM features"""


QUERIES = {
    "stream_settled": (stream_settled, SQL_STREAM_SETTLED),
    "stream_event_hours": (stream_event_hours, SQL_STREAM_EVENT_HOURS),
    "stream_scores": (stream_scores, SQL_STREAM_SCORES),
    "exact_split": (exact_split, SQL_EXACT_SPLIT),
    "forest_checked": (forest_checked, SQL_FOREST_CHECKED),
    "scoring_batch": (scoring_batch, SQL_SCORING_BATCH),
    "pack_by_days": (pack_by_days, SQL_PACK_BY_DAYS),
    "correlation_by_days": (correlation_by_days, SQL_CORRELATION_BY_DAYS),
    "stations_by_days": (stations_by_days, SQL_STATIONS_BY_DAYS),
    "geo_radius_stored": (geo_radius_stored, SQL_GEO_RADIUS_STORED),
    "weather_source": (weather_source, SQL_WEATHER_SOURCE),
    "json_quarantine": (json_quarantine, SQL_JSON_QUARANTINE),
    "csv_quarantine": (csv_quarantine, SQL_CSV_QUARANTINE),
}

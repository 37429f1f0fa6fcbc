"""What the repeated passages send: compressed, and each piece once."""

import numpy as np
from pyspark.sql import functions as F

from rows import documents, prose
from velolake.llm import suffix_dedup as SD


def keyed(df):
    return df.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("key"))


def test_texts_are_sent_compressed_and_whole(spark):
    docs = keyed(documents(spark))
    sent = {(bytes(r.key), r.id): SD.unsqueezed(bytes(r.text)).decode() for r in SD.sent_texts(docs).collect()}
    long_enough = [r for r in docs.collect() if len(r.text.encode()) >= SD.LENGTH]
    assert sent == {(bytes(r.key), r.id): r.text for r in long_enough} and len(sent) > 8
    text = prose(1, 900)
    assert len(SD.squeezed(text.encode())) < 0.6 * len(text)


def test_grams_are_packed_in_less_and_come_back():
    r = np.random.default_rng(1)
    grams = np.sort(r.integers(0, 1 << 48, 500, dtype=np.uint64))
    groups = r.integers(0, 1 << 64, 6, dtype=np.uint64)[r.integers(0, 6, 500)]
    for n in (1, 500):
        pairs = np.stack([grams[:n], groups[:n]], 1)
        sent = SD.packed_grams(pairs)
        back = SD.unpacked_grams(sent)
        assert back[0].tolist() == grams[:n].tolist() and back[1].tolist() == groups[:n].tolist()
    assert len(sent) < 0.6 * pairs.nbytes


def test_pieces_meet_in_one_shuffle(spark):
    rows = [(b"k%d" % i, i, i % 3, 0, b"piece%d" % (i % 4)) for i in range(1, 200)]
    found = spark.createDataFrame(rows, SD.PIECES).repartition(5)
    distinct = SD.distinct_pieces(found).sortWithinPartitions("group")
    want = {}
    for _, ident, group, _, piece in rows:
        want[group, piece] = min(ident, want.get((group, piece), ident))
    assert {(r.group, bytes(r.piece)): r.lo for r in distinct.collect()} == want and distinct.count() == len(want)
    places = distinct.select("group", F.spark_partition_id().alias("part")).collect()
    assert len({(r.group, r.part) for r in places}) == len({r.group for r in places}) == 3
    shuffles = [x for x in distinct._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].splitlines() if "Exchange hashpartitioning" in x]
    assert len(shuffles) == 1

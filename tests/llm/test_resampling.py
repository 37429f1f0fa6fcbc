"""Importance resampling, clustering and web archives against brute force."""

import base64
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rows import clashing, documents, prose

from velolake.llm import clustering, resampling, warc
from velolake.llm.common import task_totals


# -- importance resampling --------------------------------------------------
def plain_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return len(w), [zlib.crc32(r.encode()) % 10000 for r in runs]


def plain_resampling(rows, targets):
    bags = [plain_features(t) for _, t in rows]
    s, t = Counter(b for _, f in bags for b in f), Counter(b for x in targets for b in plain_features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in s}
    out = []
    for (i, _), (n, f) in zip(rows, bags):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    return out, able[: len(able) * 5 // 100]


def test_resampling_equals_brute_force(spark):
    r = random.Random(3)
    rows = [(i, prose(i, r.randint(0, 60))) for i in range(700)] + [(None, "ÄÖ Straße " * 30), (None, None), (900, ""), (901, prose(9, 9000))]
    rows += [(902, prose(5, 40))] * 40  # repeated rows
    target = [prose(1000, 50), "lamps of the RIVER " * 9, None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = resampling.digest(docs, spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")).collect()
    want, drawn = plain_resampling(rows, target)
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(((g.doc_id, g.n_features, g.weight, g.score) for g in got), key=key) == sorted(((w[0], *w[2:]) for w in want), key=key)
    ranked = sorted((g.rank, g.doc_id, g.score) for g in got if g.rank is not None)
    assert [x[0] for x in ranked] == list(range(1, len(drawn) + 1))
    assert [(x[1], x[2]) for x in ranked] == [(w[0], w[4]) for w in drawn]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aZ9 é-\n", max_size=80), st.integers(1, 12))
def test_features_of_any_chunk_size(text, chunk):
    old, resampling.CHUNK = resampling.CHUNK, chunk
    try:
        got = Counter(b for x in resampling.features(text) for b in x.tolist())
    finally:
        resampling.CHUNK = old
    assert got == Counter(plain_features(text)[1])


@pytest.mark.parametrize("draw", [0, 1, 37, 400, 3999, 4000])
def test_ranks_are_exact_with_many_ranges(spark, draw):
    r = random.Random(draw)
    keys = [(r.choice([0, r.randint(-(10**12), 10**12)]), r.randint(0, 3), i) for i in range(4000)]
    df = spark.createDataFrame(keys, "a long, b long, row long").repartition(7)
    got = {x.row: x["rank"] for x in resampling.ranks(df, len(keys), draw, step=8).collect()}
    assert got == {k[2]: n for n, k in enumerate(sorted(keys)[:draw], 1)}


def test_ranks_when_samples_mislead(spark):
    # runs so short that hardly any key is sampled: the counts decide
    df = spark.range(300).selectExpr("-id AS a", "0L AS b", "id AS row").repartition(60)
    got = {x.row: x["rank"] for x in resampling.ranks(df, 300, 250, step=1000).collect()}
    assert got == {299 - k: k + 1 for k in range(250)}


def test_resampling_of_defined_cases(spark):
    docs = clashing(documents(spark))
    out = resampling.resampled(docs, docs.limit(0))
    assert out.count() == docs.count() and [f.name for f in out.schema][-4:] == ["n_features", "weight", "score", "rank"]
    assert {r.ids for r in out.select("ids").collect()} == {"mine"}
    empty = resampling.digest(docs.limit(0), docs)
    assert empty.columns == ["doc_id", "n_features", "weight", "score", "rank"] and empty.count() == 0


def test_task_totals(spark):
    count = lambda batches: np.array([sum(b.num_rows for b in batches), 1])
    assert task_totals(spark.range(1000).repartition(40), count, 2).tolist() == [1000, 40]


# -- clustering -------------------------------------------------------------
def plain_nearest(x, c):
    d = ((x[:, None] - c[None]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 24), st.sampled_from([1, 2, 40]))
def test_orchard_search_equals_all_distances(seed, k, spread):
    r = np.random.default_rng(seed)
    c, x = r.integers(-spread, spread + 1, (k, 3)), r.integers(-spread, spread + 1, (200, 3))  # many ties
    cluster, distance, measured = clustering.nearest(x, c, *clustering.neighbour_lists(c))
    want = plain_nearest(x, c)
    assert (cluster == want[0]).all() and (distance == want[1]).all() and measured <= 200 * k


def test_orchard_search_skips_far_centroids():
    r = np.random.default_rng(1)
    c = r.integers(-(10**6), 10**6, (200, 8))
    x = c[r.integers(0, 200, 3000)] + r.integers(-50, 50, (3000, 8))
    cluster, _, measured = clustering.nearest(x, c, *clustering.neighbour_lists(c))
    assert (cluster == plain_nearest(x, c)[0]).all() and measured < 0.5 * 3000 * 200


def plain_clusters(rows):
    kept = [(i, [math.floor(64 * np.float64(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and None not in v and np.isfinite(v).all()]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:16]
    c, x = np.array([v for _, v in first]), np.array([v for _, v in kept])
    for _ in range(3):
        a = plain_nearest(x, c)[0]
        c = np.array([[sum(col) // n for col in x[a == k].T.tolist()] if (n := int((a == k).sum())) else c[k].tolist() for k in range(len(c))])
    a, d = plain_nearest(x, c)
    return [(i, int(k), int(z), int(d[a == k].sum()), int(d.sum()), hashlib.sha256(",".join(map(str, c[k].tolist())).encode()).hexdigest()) for (i, _), k, z in zip(kept, a, d)]


def test_clusters_equal_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(np.float32(z)) for z in r.normal(size=64) * 3]) for i in range(600)]
    rows += [(600, rows[0][1])] * 30 + [(None, rows[1][1]), (601, None), (602, [1.0] * 63), (603, [1.0] * 63 + [None]), (604, [1.0] * 63 + [float("nan")]), (605, [float("inf")] * 64), (606, [])]
    got = clustering.digest(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain_clusters(rows), key=str)


def test_clusters_of_defined_cases(spark):
    schema = "vec_id long, embedding array<float>, cluster string, inertia string, whole_vector string, other string"
    few = [(k, [float(k)] * 64, "x", "y", "z", "o") for k in (1, 1, 2)]
    rows = clustering.with_inertia(*clustering.clustered(spark.createDataFrame(few, schema))).collect()
    # ids hash in the order 2, 1, 1; of two equal centroids the larger number stays empty
    assert sorted((r.vec_id, r.cluster, r.other, r.whole_vector) for r in rows) == [(1, 1, "o", "z"), (1, 1, "o", "z"), (2, 0, "o", "z")]
    assert {(r.distance, r.inertia, r.cluster_inertia) for r in rows} == {(0, 0, 0)}
    assert clustering.digest(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(Exception, match="a component of"):
        clustering.digest(spark.createDataFrame([(1, [1e30] * 64, "", "", "", "")], schema)).collect()


# -- web archives -----------------------------------------------------------
def b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_pages_come_back_whole(spark, scratch):
    r = random.Random(2)
    texts = ["", None, "short", "WARC/1.1\r\n\r\n0\r\n\r\n" * 40, "日本語 \r\n" * 3000, "x" * 100_000, "same page"]
    rows = [(i, f"http://h/{i}?a=%0D\n", r.choice(texts)) for i in range(120)] + [(200, None, "same page")] * 3 + [(None, "u", "same page"), (None, "u", "own")]
    schema = "page_id long, url string, html string, payload string, row string"
    pages = spark.createDataFrame([(*x, "p", "r") for x in rows], schema).repartition(4)
    folder = warc.write_pages(pages, scratch("warc"), segment=1000, archive=50_000)
    records = warc.read_records(spark, folder).collect()
    assert all(x.problem is None for x in records) and len(records) == len(rows)
    got = Counter((x.page_id, x.url, x.kind) for x in records)
    assert sum(got.values()) == len(rows) and {x.url for x in records} == {u for _, u, _ in rows}
    by_text = {x.payload.decode(): x for x in records if x.kind == "response"}
    assert set(by_text) == {t or "" for _, _, t in rows}
    for text, x in by_text.items():
        ids = [i for i, _, t in rows if (t or "") == text]
        assert x.page_id == max((i for i in ids if i is not None), default=None) and x.digest == b32(text.encode())
        assert sum(y.refers_to == x.record_id for y in records) == len(ids) - 1
    slim = Counter((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in warc.resolved(warc.read_records(spark, folder)).collect())
    want = Counter()
    for text in by_text:
        ids = sorted((i for i, _, t in rows if (t or "") == text), key=lambda i: -1 if i is None else i)
        for k, i in enumerate(ids):
            last = k == len(ids) - 1
            want[i, len(text.encode()), b32(text.encode()), "response" if last else "revisit", None if last else ids[-1]] += 1
    assert slim == want


def test_archives_are_plain_warc(spark, scratch):
    folder = warc.write_pages(spark.createDataFrame([(1, "http://h/é", "ä" * 900), (2, "http://h/", "")], "page_id long, url string, html string").coalesce(1), scratch("warc"), segment=700)
    content = [bytes(r.content) for r in spark.read.format("binaryFile").load(folder).collect()]
    text = b"".join(gzip.decompress(c) for c in content)
    assert text.endswith(b"\r\n\r\n") and text.count(b"WARC/1.1\r\n") == 4  # three segments and one record
    found = [f for f, _ in warc.archive_records(text)]
    assert [f.get("warc-segment-number") for f in found if f.get("x-page-id") != "2"] == ["1", "2", "3"]
    assert [f["warc-type"] for f in found if "warc-segment-origin-id" in f] == ["continuation"] * 2


def test_damaged_records_stay_and_say_so(spark, scratch):
    def segments(text, segment=300):
        return list(warc.written(1, 1, "u", text.encode(), b32(text.encode()), None, segment))

    whole = segments("a" * 1000)
    cases = {
        "last segment missing": whole[:-1], "segment missing or repeated": [whole[0], *whole[2:]], "first segment missing": whole[1:],
        "total length": [*whole[:-1], whole[-1].replace(b"Segment-Total-Length: 1", b"Segment-Total-Length: 2")],
        "digest": [x.replace(b"aaa", b"aab") for x in whole], "chunk size": [segments("abc", 999)[0].replace(b"\r\n3\r\n", b"\r\nz\r\n")],
        None: [whole[0], b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\nabc", *reversed(whole[1:])], "unreadable": [b"no archive at all"],
    }
    for problem, records in cases.items():
        path = scratch("damaged")
        text = b"\r\n\r\n".join(records)
        frame = spark.createDataFrame([(text,)], "t binary").selectExpr("CAST(t AS STRING) AS t")
        frame.write.option("lineSep", "\r\n\r\n").text(path)
        got = warc.read_records(spark, path).collect()
        assert [r.problem for r in got] == [problem]
        assert (got[0].payload == b"a" * 1000) == (problem is None)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 40))
def test_chunk_framing(data, size):
    assert warc.unchunked(warc.chunked(data, size)) == data
    assert warc.unchunked(warc.chunked(data, size)[:-5] + b"000;x=1\r\nA: b\r\n\r\n") == data
    with pytest.raises(ValueError):
        warc.unchunked(warc.chunked(data, size)[:-1])


def test_archives_of_no_pages(spark):
    assert warc.digest(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_hot_keys_are_joined_without_shuffle(spark):
    left = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE cast(id AS string) END AS k", "id")
    right = spark.createDataFrame([("hot", 1), ("2", 2), ("none", 3)], "k string, v int")
    got = {r.id: r.v for r in warc.joined_one(left, right, "k", ["v"]).collect()}
    assert len(got) == 9000 and got == {i: 1 if i % 3 == 0 else 2 if i == 2 else None for i in range(9000)}

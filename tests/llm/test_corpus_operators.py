"""Operators over the whole corpus against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rows import clashing, documents, prose

from velolake.llm import common, minhash, neighbours, packing, shards, suffix_dedup
from velolake.llm.queries import WORD_MODEL


@pytest.fixture(scope="module")
def docs(spark):
    frame = documents(spark).cache()
    yield frame
    frame.unpersist(blocking=True)


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


# -- sharding ---------------------------------------------------------------
def check_shards(rows, count):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert all(0 <= s < count for s in by)
    assert all(sorted(r.slot for r in x) == list(range(len(x))) for x in by.values())
    return {s: sum(r["size"] for r in x) for s, x in by.items()}


def test_shards_of_small_table(docs, texts):
    rows = shards.digest(docs).collect()
    check_shards(rows, 40)
    want = [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in texts]
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=str) == sorted(want, key=str)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert shards.digest(docs.limit(0)).count() == 0
    plan = shards.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_shards_are_even_despite_a_hot_group(spark):
    r = random.Random(1)
    rows = [(i, "same text " * 5 if i % 3 == 0 else "y" * r.randint(0, 400)) for i in range(6000)]
    rows += [(10_000 + i, f"pair {i // 2}") for i in range(400)]
    got = shards.assign(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    size = check_shards(got, 8)
    mean = sum(size.values()) / 8
    assert len(size) == 8 and max(size.values()) - min(size.values()) < 0.08 * mean
    homes = defaultdict(set)
    for x in got:
        if x.id >= 10_000:
            homes[(x.id - 10_000) // 2].add(x.shard)
    assert all(len(h) == 1 for h in homes.values())  # small groups stay whole


def brute_bytes(rows, count):
    """Shard of each record in a plain sorted order: that of the middle of its
    bytes (every text its own group of one)."""
    total, upto, out = sum(n for _, n in rows), 0, []
    for _, n in rows:
        out.append(min(count - 1, (2 * upto + n) * count // (2 * total)))
        upto += n
    return out


def test_shards_equal_a_plain_sorted_cut(spark):
    r = random.Random(7)
    rows = [(i, f"{i} " + "z" * r.randint(0, 500)) for i in range(3000)]
    got = shards.assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 13).collect()
    order = sorted(got, key=lambda x: (x.key, x.id))
    assert [x.shard for x in order] == brute_bytes([(x.id, x["size"]) for x in order], 13)
    check_shards(got, 13)


def test_rows_equal_in_everything_are_dealt_out(spark):
    # a third of all rows are one row, id included; another third has no id
    rows = [(5, "same row")] * 2000 + [(None, "no id " * 3)] * 2000 + [(i, f"own {i} " * 4) for i in range(10, 2010)]
    records = shards.assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 12)
    size = check_shards(records.collect(), 12)
    mean = sum(size.values()) / 12
    assert len(size) == 12 and max(size.values()) - min(size.values()) < 0.02 * mean + 100
    _, ranges = shards.splitters(records.select("row", "id", "size", "crc", "key"), 12)
    assert max(r.rows for r in ranges) <= shards.OVERFULL * len(rows) / 48 + 1


def test_written_shards(docs, scratch):
    path = scratch("shards")
    named = clashing(docs)
    column = shards.write_shards(named, path, 4)
    back = docs.sparkSession.read.parquet(path)
    assert column.endswith("shard") and column not in named.columns
    assert {*back.columns} == {*named.columns, column} and back.count() == docs.count()
    assert {r.shard for r in back.select("shard").collect()} == {"mine"}
    want = Counter(r.shard for r in shards.assign(docs, 4).collect())
    got = Counter(r[0] for r in back.select(column).collect())
    assert got == want and set(want) <= set(range(4))


# -- neighbours -------------------------------------------------------------
def brute_neighbours(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and len(v) == 4 and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in ok:
        if q % 20 == 0:
            s = sorted((-float((v * x).sum()), i) for i, v in ok if i != q)
            out[q] = [(i, -y) for y, i in s[:k]]
    return out


def test_neighbours_equal_brute_force(spark):
    r = np.random.default_rng(2)
    rows = [(i, (r.normal(size=4) * r.uniform(0.2, 3)).tolist()) for i in range(300)]
    rows += [(300 + i, [1.0, 2.0, 0.5, -1.0]) for i in range(100)]  # a list of copies
    rows += [(500, None), (501, [0.0] * 4), (502, [1.0, None, 1.0, 1.0]), (503, [1.0, float("nan"), 0.0, 0.0]), (504, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (520, [1.0] * 3), (540, [])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).drop("rank", "score")
    got = defaultdict(list)
    for x in neighbours.digest(df).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.vec_id, x.score))
    want = brute_neighbours(rows, 20)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        np.testing.assert_allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in neighbours.digest(few).orderBy("rank").collect()] == [(0, 1, 1, 1.0), (0, 2, 2, 0.0)]
    assert neighbours.digest(few.limit(0)).count() == 0
    assert neighbours.digest(few.where("vec_id = 0")).count() == 0


def test_recall_over_many_lists(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(6000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for row in neighbours.digest(df).select("query_id", "vec_id").collect():
        found[row.query_id].add(row.vec_id)
    hit = 0
    for q in range(0, 6000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    assert hit >= 0.9 * 20 * 300


def recall(spark, x, every=20):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for row in neighbours.search(df, df.where(f"vec_id % {every} = 0")).select("query_id", "vec_id").collect():
        found[row.query_id].add(row.vec_id)
    hit = 0
    for q in range(0, len(x), every):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(found[q] & set(np.argsort(-s)[:20].tolist()))
    return hit / 20 / len(range(0, len(x), every))


def test_recall_over_a_thousand_fine_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_SIZE", 16)
    r = np.random.default_rng(4)
    x = r.normal(size=(17_000, 24))
    x /= np.sqrt((x**2).sum(1))[:, None]
    assert len(x) // neighbours.LIST_SIZE >= 1000
    assert recall(spark, x, 50) >= 0.97


@pytest.mark.parametrize("clusters, most", [(400, 0.25), (None, 0.75)])
def test_lists_are_pruned_and_neighbours_found(spark, monkeypatch, clusters, most):
    """Share of the lists that queries read, beside the recall, at a thousand
    lists: vectors in clear clusters and vectors in none."""
    monkeypatch.setattr(neighbours, "LIST_SIZE", 12)
    monkeypatch.setattr(neighbours, "ASKED", 60)  # queries are dealt over blocks
    r = np.random.default_rng(8)
    x = r.normal(size=(12_500, 24))
    if clusters:
        x = r.normal(size=(clusters, 24))[r.integers(0, clusters, len(x))] + 0.15 * x
    x /= np.sqrt((x**2).sum(1))[:, None]
    seen, keep = {}, neighbours.stored

    def kept(df, name):
        seen[name] = keep(df, name)
        return seen[name]

    monkeypatch.setattr(neighbours, "stored", kept)
    assert recall(spark, x, 50) >= 0.93
    lists = len(x) // 12
    read = [len(q.lists) for q in seen["ann-queries"].collect()]
    assert lists >= 1000 and sum(read) / len(range(0, len(x), 50)) <= most * lists


def test_unclustered_vectors_have_replicas():
    x = np.random.default_rng(6).normal(size=(4000, 64)) / 8
    graph = neighbours.CentroidGraph(neighbours.fit_centroids(x, 100))
    lists = [graph.lists_of(v) for v in x[:500]]
    assert all(1 <= len(set(a)) == len(a) <= neighbours.REPLICAS for a in lists)
    assert np.mean([len(a) for a in lists]) >= 2
    for v, a in zip(x, lists):
        far = np.sqrt(((graph.c - v) ** 2).sum(1))
        assert far[a[0]] <= far.min() * 1.01 and far[a].max() <= far[a[0]] * neighbours.BOUNDARY + 1e-9


# -- repeated passages ------------------------------------------------------
def brute_repeats(rows):
    first, out, n = {}, [], suffix_dedup.LENGTH
    rows = [(suffix_dedup.LAST_ID if d is None else d, (t or "").encode(), d) for d, t in rows]
    for d, b, _ in rows:
        for s in range(len(b) - n + 1):
            first[b[s : s + n]] = min(first.get(b[s : s + n], d), d)
    for d, b, original in rows:
        gone = np.zeros(len(b), np.int8)
        for s in range(len(b) - n + 1):
            if first[b[s : s + n]] < d:
                gone[s : s + n] = 1
        rest = bytes(x for x, y in zip(b, gone) if not y)
        out.append((original, len(b), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def test_repeats_equal_brute_force(docs, texts):
    got = sorted((tuple(r) for r in suffix_dedup.digest(docs).collect()), key=str)
    assert got == brute_repeats(texts)
    assert suffix_dedup.digest(docs.limit(0)).count() == 0


def test_random_repeats_equal_brute_force(spark):
    r = random.Random(4)
    parts = ["".join(r.choice("abcdé ") for _ in range(200)) for _ in range(4)]
    rows = [
        (r.choice([None, *range(40)]), parts[r.randint(0, 3)][r.randint(0, 60) : r.randint(60, 200)] + "xyz"[: r.randint(0, 3)] + r.choice(["", parts[0][50:120], "a" * 120]))
        for _ in range(60)
    ]
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    assert sorted((tuple(x) for x in suffix_dedup.digest(df).collect()), key=str) == brute_repeats(rows + rows[:5])


def test_hot_grams_are_told_once_a_block(spark):
    # copies of one text, and a line that a third of all texts share
    r = random.Random(5)
    line = prose(40, 25)
    rows = [(i, prose(1, 60)) for i in range(1000)]
    rows += [(i, prose(i, 12) + " " + line + " " + prose(i + 1, 12)) for i in range(1000, 2000)]
    rows += [(i, prose(3 * i, 30)) for i in range(2000, 2600)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {x.doc_id: x for x in suffix_dedup.digest(df).collect()}
    assert {d: tuple(found[d])[1:] for d, _ in rows} == {w[0]: tuple(w)[1:] for w in brute_repeats(rows)}
    sent = suffix_dedup.anchors(df.select("text"), 0).collect()
    blocks = {x.block for x in sent}
    grams = [g for x in sent if x.bucket >= 0 for g in np.frombuffer(x.grams, np.uint8).reshape(-1, 6).tolist()]
    assert max(Counter(map(tuple, grams)).values()) <= len(blocks) <= 8


def test_texts_without_repeats(docs):
    wide = clashing(docs)
    out = suffix_dedup.deduplicated(wide)
    assert out.schema.simpleString() == wide.schema.simpleString() and out.count() == docs.count()
    assert out.where("doc_id = 2").first().text == "" and out.where("text IS NULL").count() == 1


@pytest.mark.parametrize("turns", [3, 50])
def test_merged_transforms(turns):
    r = random.Random(turns)
    for _ in range(40):
        parts = [["".join(r.choice("ab") for _ in range(r.randint(0, 12))) * r.choice([1, 6]) for _ in range(r.randint(1, 4))] for _ in range(r.randint(1, 4))]
        made = [suffix_dedup.transform([x.encode() for x in p]) for p in parts]
        order, interval, settled = suffix_dedup.merge(made, turns)
        suffixes = [x[i:] + "$" for p in parts for x in p for i in range(len(x) + 1)]
        base = np.cumsum([0] + [len(m[0]) for m in made])
        place = np.concatenate([m[0] + b for m, b in zip(made, base)])[order]
        starts = Counter(x[:turns] for x in suffixes if len(x) > turns)
        got = [suffixes[i][:turns] for i in place]
        assert got == sorted(x for x, n in starts.items() if n > 1 for _ in range(n))
        assert [a == b for a, b in zip(got, got[1:])] == [a == b for a, b in zip(interval, interval[1:])]
        for h, n in settled.items():  # alone with one symbol more, not before
            longer, shorter = Counter(x[: h + 1] for x in suffixes if len(x) > h + 1), Counter(x[:h] for x in suffixes if len(x) > h)
            alone = {x for x, m in longer.items() if m == 1}
            shared = lambda x: h == 0 or shorter[x[1:]] > 1
            assert n == sum(shared(x) for x in alone)


# -- packing ----------------------------------------------------------------
def best_fit(lengths, capacity):
    room = []
    for x in sorted(lengths, reverse=True):
        fit = [i for i, c in enumerate(room) if c >= x]
        if fit:
            room[min(fit, key=lambda i: room[i])] -= x
        else:
            room.append(capacity - x)
    return sorted(room)


def test_plan_is_best_fit_decreasing():
    r = random.Random(5)
    for _ in range(150):
        capacity = r.choice([7, 10, 16, 50, 4096])
        lengths = [r.randint(1, capacity) if r.random() < 0.6 else max(1, capacity // r.randint(2, 4)) for _ in range(r.randint(0, 200))]
        bins = defaultdict(list)
        for length, _, n, first, offset in packing.plan(dict(Counter(lengths)), capacity):
            for k in range(n):
                bins[first + k].append((offset, length))
        for held in bins.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
        assert sorted(capacity - sum(x for _, x in h) for h in bins.values()) == best_fit(lengths, capacity)


def test_words_of_many_texts_are_looked_up_together(spark, monkeypatch):
    encoder, asked = packing.word_encoder(WORD_MODEL), []
    monkeypatch.setattr(encoder, "table", lambda words, table=encoder.table: asked.append(len(words)) or table(words))
    texts = ["word Wörter. <unk> ABC's, straße İx  été? a\u00a0b lower Upper..."] * 4000
    monkeypatch.setattr(packing, "word_encoder", lambda path: encoder)

    class Frame:  # a frame of one task
        columns, schema = ["doc_id", "text"], StructType.fromDDL("doc_id long, text string")

        def drop(self, name):
            return type("Left", (), {"columns": ["doc_id"], "schema": StructType.fromDDL("doc_id long")})()

        def mapInArrow(self, run, schema):
            return list(run(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})])))

    made = packing.pieces(Frame(), WORD_MODEL)
    want = len(encoder.tokenizer.encode(texts[0], add_special_tokens=False).ids) + 1
    assert len(asked) == 1 and sum(b.num_rows for b in made) == len(texts)
    assert {n for b in made for n in b.column(b.schema.names.index("length")).to_pylist()} == {want}


def test_packed_documents(docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_MODEL)
    want = []
    for d, x in texts:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    rows = packing.pack_documents(docs, WORD_MODEL).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) == len(best_fit([w[3] for w in want], 4096))
    assert packing.pack_documents(docs.limit(0), WORD_MODEL).count() == 0


# -- near-duplicates --------------------------------------------------------
def test_signatures_agree_by_weighted_similarity():
    r = np.random.default_rng(6)
    elements = r.integers(0, 2**63, 600).astype(np.uint64)
    a = r.integers(0, 4, 600) + r.random(600) * 0.5
    b = np.where(r.random(600) < 0.3, a, a * r.random(600))
    k = 20_000
    x, y = minhash.signatures([(elements, a), (elements[b > 0], b[b > 0])], k)
    assert abs((x == y).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.015


def brute_classes(rows):
    sets, s = [], minhash.Shingler()
    for _, t in rows:
        x = s.shingles(t or "")
        sets.append(minhash.weighted(x) if len(x) else None)
    name = list(range(len(rows)))

    def top(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] is not None and sets[j] is not None and minhash.similarity(sets[i], sets[j]) >= 0.8:
                name[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, least.get(top(i)) if sets[i] is not None else d) for i, (d, _) in enumerate(rows)), key=str)


def test_classes_equal_brute_force(docs, texts):
    got = sorted(((r.doc_id, r.class_id) for r in minhash.digest(docs).collect()), key=str)
    assert got == brute_classes(texts)
    assert minhash.digest(docs.limit(0)).count() == 0


def test_chains_and_a_large_group(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    rows, base = [], [word() for _ in range(200)]
    for i in range(60):  # each copy differs from its original in a few words
        copy = list(base)
        for _ in range(r.randint(1, 5)):
            copy[r.randrange(200)] = word()
        rows.append((i, " ".join(copy)))
    chain = [word() for _ in range(200)]
    for i in range(100, 112):  # each is near the next one alone
        for _ in range(3):
            chain[r.randrange(200)] = word()
        rows.append((i, " ".join(chain)))
    rows += [(200 + i, " ".join(word() for _ in range(150))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(((x.doc_id, x.class_id) for x in minhash.digest(df).collect()), key=str) == brute_classes(rows)


def template_texts(r, n):
    """Texts of one template with two varying parts: similarity about 0.7 to
    each other, none linked; a few of them twice, changed by a word."""
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    a, b, c = ([word() for _ in range(56)] for _ in range(3))
    texts = [a + [word() for _ in range(12)] + b + [word() for _ in range(12)] + c for _ in range(n)]
    for k in range(0, n, 20):
        near = list(texts[k])
        near[5] = word()
        texts.append(near)
    return [" ".join(t) for t in texts]


def test_template_texts_make_pairs_in_proportion(spark, monkeypatch):
    made, keep = [], minhash.stored

    def kept(df, name):
        out = keep(df, name)
        if name == "pairs":
            made[-1] += out.count()
        return out

    monkeypatch.setattr(minhash, "stored", kept)
    for n in (100, 400):
        texts = template_texts(random.Random(n), n)
        rows = list(enumerate(texts))
        made.append(0)
        got = sorted(((x.doc_id, x.class_id) for x in minhash.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
        if n == 100:
            assert got == brute_classes(rows)  # no link is lost
        assert {(n + k // 20, k) for k in range(0, n, 20)} <= {*got}
    # all pairs of the buckets were 2,547 and 40,532
    assert made[0] < 4 * 100 and made[1] < 4 * 400


def test_rare_shingles_find_every_similar_pair(spark):
    r = random.Random(9)
    texts = []
    for _ in range(12):  # groups of texts at similarities around 0.8
        base = [f"w{r.randint(0, 400)}" for _ in range(60)]
        for _ in range(6):
            t = list(base)
            for _ in range(r.randint(0, 3)):
                t[r.randrange(60)] = f"w{r.randint(0, 400)}"
            texts.append(" ".join(t))
    s = minhash.Shingler()
    sets = [minhash.weighted(s.shingles(t)) for t in texts]
    packed = [(k, bytearray(e.tobytes() + c.astype(np.uint32).tobytes())) for k, (e, c) in enumerate(sets)]
    frame = spark.createDataFrame(packed, "node long, shingles binary")
    nodes = frame.selectExpr("node", "struct(node, 0 AS comp) AS member")
    got = {(x.node, x.b) for x in minhash.rare_pairs(nodes, frame).select("node", "b").distinct().collect()}
    similar = {(i, j) for j in range(len(sets)) for i in range(j) if minhash.similarity(sets[i], sets[j]) >= 0.8}
    assert similar and similar <= got and len(got) < len(sets) ** 2 / 8


def test_edited_copies_of_one_text_make_few_pairs(spark):
    """Texts of one source, each with edits of its own: pairs that are too far
    apart are not made, though they share all else."""
    rng = random.Random(5)
    base = [f"w{k}" for k in range(100)]
    texts = []
    for k in range(160):
        words = list(base)
        for at in rng.sample(range(5, 95, 10), 3):
            words[at] = f"edit{k}"
        texts.append(" ".join(words))
    texts += [t + " end" for t in texts[:10]]
    s = minhash.Shingler()
    sets = [minhash.weighted(s.shingles(t)) for t in texts]
    packed = [(k, bytearray(e.tobytes() + c.astype(np.uint32).tobytes())) for k, (e, c) in enumerate(sets)]
    frame = spark.createDataFrame(packed, "node long, shingles binary")
    made = minhash.rare_pairs(frame.selectExpr("node", "struct(node, 0 AS comp) AS member"), frame).select("node", "b").collect()
    similar = {(i, j) for j in range(len(sets)) for i in range(j) if minhash.similarity(sets[i], sets[j]) >= 0.8}
    apart = [p for p in map(tuple, made) if p not in similar]
    assert len(similar) >= 10 and similar <= {tuple(p) for p in made}
    assert len(apart) < len(sets)


def test_a_key_with_many_rows_is_dealt_out(spark, monkeypatch):
    left = spark.range(1000).selectExpr("id AS node", "if(id % 3 = 0, 7, id) AS k")
    right = spark.createDataFrame([(7, "hot"), (8, "cold")], "k long, v string")
    want = sorted((x.node, x.k, x.v) for x in common.with_one(left, right, "k", "node").collect() if x.v)
    monkeypatch.setattr(common, "BROADCAST_ENTRIES", 1)
    got = common.with_one(left, right, "k", "node")
    assert sorted((x.node, x.k, x.v) for x in got.collect() if x.v) == want and got.count() == 1000
    assert common.with_one(left, right, "k", "node", "inner", entries=F.length("v")).count() == len(want)


def test_one_document_of_each_class_stays(docs):
    wide = clashing(docs)
    out = minhash.deduplicated(wide)
    ids = sorted((r.doc_id for r in out.select("doc_id").collect()), key=str)
    assert out.schema.simpleString() == wide.schema.simpleString()
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids and {4, 5, 6} <= {*ids} and ids.count(11) == 2

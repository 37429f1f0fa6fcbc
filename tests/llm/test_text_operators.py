"""Operators on single texts against libraries and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from rows import CLASHES, clashing, documents

from velolake.llm import licenses, packing, personal_data, quality_rules, sentencepiece_codec, toxicity
from velolake.llm.queries import ORACLE_SQL, PIECE_MODEL, WORD_MODEL


@pytest.fixture(scope="module")
def docs(spark):
    frame = documents(spark).cache()
    yield frame
    frame.unpersist(blocking=True)


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


# -- SentencePiece ----------------------------------------------------------
def test_encoding_equals_the_library(docs, texts):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)

    def expected(doc_id, text):
        ids = [sp.bos_id(), *sp.encode(text or ""), sp.eos_id()]
        packed = np.array(ids, "<u4").tobytes()
        return doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()

    got = [tuple(r)[:4] for r in sentencepiece_codec.digest(docs, PIECE_MODEL).collect()]
    assert sorted(got, key=str) == sorted((expected(*t) for t in texts), key=str)


def test_spans_equal_the_library():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    codec, r = sentencepiece_codec.codec(PIECE_MODEL), random.Random(1)
    for _ in range(300):
        text = "".join(r.choice("ab \n\t▁é😀<>.") for _ in range(r.randint(0, 40)))
        ids, spans = codec.encode(text)
        assert ids[1:-1].tolist() == sp.encode(text)
        pieces = sp.encode(text, return_type="proto").pieces
        assert [(p.begin, p.end) for p in pieces] == [tuple(s) for s in spans[1:-1].tolist()]
        assert codec.decode(ids) == sp.decode(ids.tolist())


def test_character_map_equals_the_library():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    rules = proto.ModelProto()
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    model = proto.ModelProto()
    model.ParseFromString(open(PIECE_MODEL, "rb").read())
    model.normalizer_spec.CopyFrom(rules.normalizer_spec)
    blob = model.SerializeToString()
    sp, codec = sentencepiece.SentencePieceProcessor(model_proto=blob), sentencepiece_codec.Codec(blob)
    r = random.Random(2)
    for _ in range(300):
        text = "".join(r.choice("ab ＡＢ①㈱ﬁé　​\n\t▁é😀") for _ in range(r.randint(0, 30)))
        ids, spans = codec.encode(text)
        assert ids[1:-1].tolist() == sp.encode(text), text
        assert [(p.begin, p.end) for p in sp.encode(text, return_type="proto").pieces] == [tuple(s) for s in spans[1:-1].tolist()]


def test_decoding_any_ids():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    codec, r = sentencepiece_codec.codec(PIECE_MODEL), random.Random(3)
    for _ in range(500):
        ids = [r.choice([3 + 0x41, 3 + 0xE2, 3 + 0x82, 3 + 0xAC, 3 + 0xC3, 300, 400, 29871, 1, 2, 0]) for _ in range(r.randint(0, 9))]
        assert codec.decode(np.array(ids, "<u4")) == sp.decode(ids)


def test_encode_and_decode_columns(docs):
    wide = clashing(docs)
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(wide, PIECE_MODEL), PIECE_MODEL)
    assert set(back.columns) == set(docs.columns) | set(CLASHES)
    for r in back.select("text", "decoded").collect():
        assert r.decoded == (r.text or "").replace("▁", " ")
    assert sentencepiece_codec.encode(docs.limit(0), PIECE_MODEL).count() == 0


# -- quality rules ----------------------------------------------------------
def quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    solid = "".join(words)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), len(solid), sum(c in "#*$%&|<>" for c in solid), len(lines) - len(set(lines)), len(covered), failed


def test_quality_measures(docs, texts):
    got = [tuple(r)[:7] for r in quality_rules.digest(docs).collect()]
    assert sorted(got, key=str) == sorted(((d, *quality(t)) for d, t in texts), key=str)


def test_quality_is_native_and_equals_sql(docs):
    plan = quality_rules.digest(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.execute(ORACLE_SQL["op2_quality_rules"]).fetchall()
    got = [tuple(r) for r in quality_rules.digest(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_quality_columns_of_any_name(docs):
    plain = {(r.doc_id, r.n_words, r.n_repeat_words, r.n_lines, r.stop_word_ratio, r.kept) for r in quality_rules.judged(docs).collect()}
    rows = quality_rules.judged(clashing(docs))
    assert {(r.doc_id, r.n_words, r.n_repeat_words, r.n_lines, r.stop_word_ratio, r.kept) for r in rows.collect()} == plain
    own = {"n_words", "n_repeat_words", "n_lines", "stop_word_ratio", "kept"}
    assert all(set(r) == {"mine"} for r in rows.select(*[c for c in CLASHES if c not in own]).collect())


def test_quality_keeps_rows_and_columns(docs):
    wide = clashing(docs)
    kept = quality_rules.kept_rows(wide)
    assert kept.schema.simpleString() == wide.schema.simpleString()
    ids = {r.doc_id for r in kept.collect()}
    assert {1, 2, 3, 7, 8, 9} <= ids and not {4, 5, 6, 10, 14, 15} & ids
    assert kept.select("n_words").distinct().collect()[0][0] == "mine"
    assert quality_rules.kept_rows(docs.limit(0)).count() == 0


# -- personal data ----------------------------------------------------------
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@lru_cache(maxsize=None)
def personal(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0,
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]
            if ok():
                out.append((kind, *m.span()))
    return out


def test_patterns_equal_plain_ones():
    r = random.Random(4)
    for _ in range(5000):
        text = "".join(r.choice("a@.-1 25+(x0%é9") for _ in range(r.randint(0, 30)))
        assert personal_data.find(text) == personal(text), text


def test_patterns_in_linear_time():
    assert personal_data.find("1" * 100_000 + "." + "1" * 50_000 + "a@" * 50_000 + "a" * 100_000) == []


def test_personal_data_digest(docs, texts):
    for r in personal_data.digest(docs).collect():
        assert (r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) in {
            (d, *(sum(s[0] == k for s in personal(t or "")) for k in PATTERNS)) for d, t in texts
        }
        assert r.base_sha256 in {hashlib.sha256(",".join("%s:%d:%d" % s for s in personal(t or "")).encode()).hexdigest() for d, t in texts if d == r.doc_id}
    assert personal_data.digest(docs.limit(0)).count() == 0


def test_terms_that_disclose_are_masked(spark):
    r = random.Random(5)
    filler = lambda: " ".join(r.choice(["ab", "cde", "fgh", "ijk", "lmn", "opq", "rst"]) + r.choice("abcdefgh") for _ in range(12))
    rows = [(i, f"{filler()} zanzibarian joe@x.example.com {filler()}") for i in range(8)] + [(100 + i, filler()) for i in range(60)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.text for r in personal_data.sanitised(df).collect()}
    assert all("zanzibarian" not in got[i] and "joe@" not in got[i] and "[EMAIL]" in got[i] for i in range(8))
    assert all(got[i] == t for i, t in rows if i >= 100)
    assert personal_data.sanitised(df).schema.simpleString() == df.schema.simpleString()
    told = {r.doc_id: r.spans for r in personal_data.digest(df).collect()}
    assert "removed" in told[0] and told[0].startswith("email:") and told[100] == ""


def planted(r, n):
    words = ["".join(x) for x in zip("abcdefghijklmnopqrstuvwxyz" * 2, "eiou" * 13, "lmnrst" * 9)][:40]
    return [" ".join(r.choice(words) for _ in range(n)) for _ in range(3)]


def test_terms_of_entities_seen_one_to_three_times(spark):
    r = random.Random(8)
    rows = [(i, " ".join(planted(r, 12))) for i in range(300)]
    for times, name in ((1, "quixotine"), (2, "brunhildy"), (3, "zanzibarian")):
        rows += [(1000 * times + i, f"{planted(r, 12)[0]} {name} {name[:3]}@x.example.com {planted(r, 12)[0]}") for i in range(times)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.text for x in personal_data.sanitised(df).collect()}
    for times, name in ((1, "quixotine"), (2, "brunhildy"), (3, "zanzibarian")):
        for i in range(times):
            before, after = dict(rows)[1000 * times + i].split(f"{name} {name[:3]}@x.example.com")
            assert got[1000 * times + i] in (f"{before}[TERM] [EMAIL]{after}", f"{before} [EMAIL]{after}")
    assert all(got[i] == x for i, x in rows if i < 1000)


def plain_disclosures(rows):
    """Spans of telling terms of each text, by plain counting."""
    import math

    term = re.compile(r"[^\W_]+")
    found = [(t or "", personal_data.find(t or "")) for _, t in rows]
    holds = [{personal_data.value_of(t, *s) for s in spans} for t, spans in found]
    words = [{w.lower() for w in term.findall(t)} for t, _ in found]
    around = {}
    for t, spans in found:
        for entity, w, _, _, a in personal_data.surroundings(t, spans):
            around.setdefault((entity, w), set()).add(a)
    bits = {}
    for (entity, w), seen in around.items():
        t = sum(w in x for x in words)
        ct = sum(w in x and entity in h for x, h in zip(words, holds))
        c = sum(entity in h for h in holds)
        p, k, z = ct / t, t * min(len(seen), ct) / ct, personal_data.Z
        low = (p + z * z / (2 * k) - z * math.sqrt(max(0.0, p * (1 - p)) / k + (z / (2 * k)) ** 2)) / (1 + z * z / k)
        if -math.log2(low) <= personal_data.GENERALISE and math.log2(len(rows) / c) + math.log2(low) >= personal_data.GAIN:
            bits[w] = min(bits.get(w, 9), -math.log2(low))
    out = []
    for t, spans in found:
        inside = lambda m: any(a < m.end() and m.start() < b for _, a, b in spans)
        told = [(bits[m.group().lower()], m) for m in term.finditer(t) if m.group().lower() in bits and not inside(m)]
        out.append(sorted(("removed" if b <= personal_data.REMOVE else "generalised", m.start(), m.end()) for b, m in told))
    return out


def test_disclosing_terms_equal_plain_counting(spark):
    r = random.Random(11)
    names = ["Zora", "quill", "brandt", "E4711", "oslo", "vex"]
    entities = ["a@x.example.com", "10.0.0.7", "+46 70 123 45 67", "b@y.example.org"]
    rows = []
    for i in range(240):
        parts = planted(r, 14)
        for _ in range(r.randint(0, 2)):
            parts.insert(r.randint(0, len(parts)), r.choice(names))
        if i % 4 == 0:
            k = r.randint(0, 3)
            parts.insert(1, f"{names[k]} {entities[k]}")
        rows.append((i, " ".join(parts)))
    rows += [(500, None), (501, ""), (502, "Zora a@x.example.com"), (503, "Zora a@x.example.com"), (504, "İzmir vex 10.0.0.7")]
    got = {x.doc_id: x.spans for x in personal_data.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_disclosures(rows)
    assert any(want)
    for (i, _), spans in zip(rows, want):
        assert [s for s in got[i].split(",") if s.startswith(("removed", "generalised"))] == ["%s:%d:%d" % s for s in spans], i


def test_a_telling_term_is_masked_wherever_it_stands(spark):
    r = random.Random(12)
    rows = [(i, " ".join(planted(r, 12))) for i in range(200)]
    rows += [(1000 + i, f"{' '.join(planted(r, 4))} Quixotine q@x.example.com {' '.join(planted(r, 14))} quixotine {planted(r, 5)[0]}") for i in range(4)]
    rows += [(2000, f"{' '.join(planted(r, 9))} seen with quixotine {planted(r, 9)[0]}")]
    spans = lambda rows: {x.doc_id: x.spans for x in personal_data.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    clean = {x.doc_id: x.text for x in personal_data.sanitised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any("quixotine" in clean[i].lower() for i, _ in rows if i >= 1000)  # thirty words later, and in the other document
    assert all(clean[i] == t for i, t in rows if i < 1000)
    # twice as many unrelated documents, and twenty times
    one = spans(rows)
    for times in (2, 20):
        more = [(10_000 + k, f"other{k % 7} words{k % 11} entirely") for k in range(times * len(rows))]
        assert {i: s for i, s in spans(rows + more).items() if i < 10_000} == one


def test_numbers_are_terms():
    text = "account 47110815 and E12345 of joe@x.example.com at 10.0.0.1"
    found = personal_data.surroundings(text, personal_data.find(text))
    places = {term: text[a:b] for entity, term, a, b, _ in found if entity == "email:joe@x.example.com"}
    assert places["47110815"] == "47110815" and places["e12345"] == "E12345"
    assert set(places) == {"account", "47110815", "and", "e12345"}


def test_sanitised_nulls(docs):
    got = personal_data.sanitised(docs)
    assert got.where("text IS NULL").count() == 1 and got.count() == docs.count()


# -- licences ---------------------------------------------------------------
def test_licence_base(docs, texts):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    want = []
    for d, t in texts:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [(i, v) for p, v in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in places]
        want.append((d, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({v for _, v in places}))))
    got = [tuple(r)[:6] for r in licenses.digest(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.digest(docs.limit(0)).count() == 0
    assert set(licenses.scan(clashing(docs)).columns) >= {"n_words", "findings", "labels", "demand", "score", "kept"}


def test_overlapping_phrases():
    n, found, labels, _ = licenses.scan_text("Lesser General Public License, MIT license apache license")
    assert n == 8 and [(f[1], f[2]) for f in found] == [("lgpl", 0), ("gpl", 1), ("mit", 4), ("apache", 6)]


def test_licence_findings_in_linear_time():
    import time

    text = "under the MIT license and the Apache license or\nSPDX-License-Identifier: MIT\n" * 15_000  # over a megabyte
    licenses.scan_text("mit license")
    t = time.process_time()
    words, found, _, _ = licenses.scan_text(text)
    assert time.process_time() - t < 2 and len(text) > 1_000_000
    base = [f for f in found if f[0] == "base"]
    per = words // 15_000
    assert len(base) == 30_000 and [f[2] for f in base[:4]] == [2, 6, per + 2, per + 6]


@pytest.mark.parametrize(
    "text,labels,demand",
    [
        ("MIT", {"mit"}, 1), ("MIT OR GPL-3.0-only", {"mit", "gpl"}, 1), ("MIT AND GPL-3.0-only", {"mit", "gpl"}, 3),
        ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl"}, 2), ("MIT OR Apache-2.0 AND GPL-2.0", {"mit", "apache", "gpl"}, 1),
        ("(MIT OR Apache-2.0) AND GPL-2.0", {"mit", "apache", "gpl"}, 3), ("MIT AND", {"mit"}, None), ("(MIT", {"mit"}, None),
        ("unknown-thing", set(), None), ("", set(), None), ("(" * 5000 + "MIT" + ")" * 5000, {"mit"}, 1),
    ],
)
def test_licence_expressions(text, labels, demand):
    assert licenses.evaluate(text) == (labels, demand)


# -- toxicity ---------------------------------------------------------------
def test_toxicity_learns_words_and_sentences(spark):
    r = random.Random(6)
    clean = lambda n: ". ".join(" ".join(r.choice("red blue green house tree road walk sing".split()) for _ in range(6)) for _ in range(n))
    rows, labels = [], []
    for i in range(400):
        toxic = r.random() < 0.3
        rows.append((i, clean(3) + (". you are " + r.choice(["vilethings", "vilest", "rotter"]) + " here. " if toxic else ". you are nice here. ") + clean(r.randint(1, 30))))
        labels.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "you are rotter"), (1002, "x " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (5000, None)], "doc_id long, toxic int")
    got = {x.doc_id: x for x in toxicity.digest(docs, marks).collect()}
    truth = dict(labels)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in set(held)) for i in truth)
    assert sum(got[i].predicted == truth[i] for i in held) >= 0.95 * len(held)
    assert got[1000].score == got[1001].score < 0.3 and got[None].predicted == 1 and got[1002].predicted == 0
    model = toxicity.fit(toxicity.training_sample(docs, marks))
    told = toxicity.score(clashing(docs), model).where("predicted = 1").select("offending").first()[0]
    assert any(re.search("vile|rotter", s.sentence) for s in told)


def plain_fit(rows):
    """The bags' likelihood climbed by plain loops: bias and weights."""
    import math

    bags = [toxicity._bag(x) for x, _ in rows]
    n, toxic = len(rows), sum(y for _, y in rows)
    seen = [{f for s in bag for f in s} for bag in bags]
    count = lambda f, y: sum(f in s for s, (_, v) in zip(seen, rows) if v == y)
    names = sorted(f for f in set().union(*seen) if sum(f in s for s in seen) >= toxicity.LEAST_DOCUMENTS)
    assert len(names) <= toxicity.MAX_FEATURES  # so all of them are features
    share = lambda f, y, all_: (count(f, y) + 0.5) / (all_ + 1)
    w = {f: 0.5 * (math.log(share(f, 1, toxic)) - math.log(share(f, 0, n - toxic))) for f in names}
    sentences = sum(map(len, bags))  # of which one a toxic document, to start with
    b, m1, m2, b1, b2 = -math.log(sentences / toxic), dict.fromkeys(names, 0.0), dict.fromkeys(names, 0.0), 0.0, 0.0
    for step in range(1, toxicity.STEPS + 1):
        grad, grad_b = dict.fromkeys(names, 0.0), 0.0
        for bag, (_, y) in zip(bags, rows):
            z = [b + sum(w[f] for f in s if f in w) for s in bag]
            clean = sum(math.log1p(math.exp(x)) for x in z)  # minus log of no toxic sentence
            slope = -1 / math.expm1(max(clean, 1e-9)) if y else 1.0
            for s, x in zip(bag, z):
                d = slope / (1 + math.exp(-x)) / n
                grad_b += d
                for f in s:
                    if f in w:
                        grad[f] += d
        c1, c2 = 1 - 0.9**step, 1 - 0.999**step
        for f in names:
            m1[f], m2[f] = 0.9 * m1[f] + 0.1 * grad[f], 0.999 * m2[f] + 0.001 * grad[f] ** 2
            w[f] -= toxicity.RATE * (m1[f] / c1 / (math.sqrt(m2[f] / c2) + 1e-4) + toxicity.DECAY * w[f])
        b1, b2 = 0.9 * b1 + 0.1 * grad_b, 0.999 * b2 + 0.001 * grad_b**2
        b -= toxicity.RATE * (b1 / c1) / (math.sqrt(b2 / c2) + 1e-4)
    return b, w


def test_toxicity_model_equals_plain_loops():
    import math

    r = random.Random(4)
    common, bad = ["tree", "lamp", "road", "milk", "bird"], ["grr", "pfui"]
    rows = []
    for i in range(24):
        parts = [" ".join(r.choice(common) for _ in range(3)) for _ in range(3)]
        if i % 3 == 0:
            parts[r.randrange(3)] += " " + r.choice(bad)
        rows.append((". ".join(parts) + ".", int(i % 3 == 0)))
    model = toxicity.fit(rows)
    bias, weights = plain_fit(rows)
    assert abs(model.bias - bias) < 1e-6
    assert set(model.weights) == {f for f, v in weights.items() if abs(v) > 0.05}
    assert all(abs(v - weights[f]) < 1e-6 for f, v in model.weights.items())
    for text, _ in rows[:8]:  # a document's score: noisy-or of its sentences'
        clean = 1.0
        for s in toxicity._bag(text):
            clean *= 1 - 1 / (1 + math.exp(-(model.bias + sum(model.weights.get(f, 0.0) for f in s))))
        assert abs(model.sentences(text)[0] - (1 - clean)) < 1e-9


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.digest(docs, none).collect()
    assert len(got) == docs.count() and all(r.predicted == 0 and 0 <= r.score <= 1 for r in got)
    assert toxicity.digest(docs.limit(0), none).count() == 0


# -- token ids of the packer ------------------------------------------------
def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_MODEL)
    encoder, r = packing.WordEncoder(WORD_MODEL), random.Random(7)
    texts = ["", "a  b", "x<|endoftext|>y <|startoftext|>", "İstanbul ΣΑΣ don't we'll 's", "a\x1cb c\x1f d"]
    texts += ["".join(r.choice("ab'stl \n\té́ Σİ<|>1.\xa0") for _ in range(r.randint(0, 40))) for _ in range(600)]
    ids, sizes = encoder.encode(pa.array(texts))
    at = 0
    for x, n in zip(texts, sizes):
        assert ids[at : at + n].tolist() == t.encode(x, add_special_tokens=False).ids, x
        at += n


def test_tokenizer_paths_exist():
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECE_MODEL


def test_a_merge_is_named_by_its_rank():
    """The rank of a merge gives the new id without a second lookup; only
    where pieces share a rank is the pair looked up."""
    codec = sentencepiece_codec.codec(PIECE_MODEL)
    known = [(codec.of_rank[k], codec.made[pair]) for pair, k in codec.order.items()]
    assert all(a in (-1, b) for a, b in known) and sum(a >= 0 for a, _ in known) > 0.9 * len(known)

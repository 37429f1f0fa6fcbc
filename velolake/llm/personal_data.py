"""Personal data: patterns, and information-theoretic sanitisation.

Patterns find the protected entities (e-mail, ip, card, phone).  Other terms
may give them away as well, so terms are weighed by what the corpus says.
With t documents that hold a term, and ct of them the entity as well, wherever
in the text, the term leaves -log2(ct / t) bits to tell the entity by: at 0
bits the term names it.  As few observations prove little, Wilson's lower
bound (one-sided, 90 %) stands for ct / t; documents that show the pair in one
surrounding are one observation, so copies of a passage add no confidence.  A
term that leaves at most ``REMOVE`` bits is removed, at most ``GENERALISE`` it
is replaced by its kind.  Documents that hold neither change nothing: the bits
are the same in a corpus of any size.  Only for an entity that itself stands in
much of the corpus a term must also tell something, ``GAIN`` bits more than
the entity's own share of all documents does.

Weighed are the terms that stand within ``REACH`` words of an entity in some
document.  What they tell is counted over whole texts, and a term that tells
is masked wherever it stands: in all of the text, and in documents that do not
hold the entity.

The corpus is read three times in full: for the entities and what stands
beside them, to count the candidates (terms, and terms with entities), and to
find the places of those that tell.  A bitmap of hashes goes along with each of
the last two, sized to what it holds; the exact terms are joined after it.

Defined cases: a null text is the empty text (no spans; sanitised it stays
null); patterns run over whole texts in linear time; repeated rows are
documents of their own for the counts and get equal spans; null ids are
kept; other columns pass through ``sanitised``; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from velolake.llm.common import extended, free_name, slices, stored, with_one

KINDS = ("email", "ip", "card", "phone")
REACH = 8  # terms on either side of an entity that are weighed
LEAST_TERM = 3  # letters or digits
Z = 1.2816  # normal quantile of the confidence, 90 % one-sided
REMOVE, GENERALISE = 1.0, 2.0  # bits that a term leaves at most
GAIN = 1.0  # bits that it must tell beyond the entity's share of the corpus
BITS, MAX_BITS = 1 << 20, 1 << 23  # of a bitmap
COUNTED = 1 << 18  # terms that a task counts before it passes them on

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\W_]+")  # numbers too: accounts, employees
DIGIT = re.compile("[0-9]")


# ---------------------------------------------------------------------------
# Patterns
# ---------------------------------------------------------------------------
def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and a dotted domain.  The local part
    is the run of its characters in front of an @, back to the last match."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """A run of digits after which no dot follows can't start inside itself,
    so matches start at the first digit of a run; long parts fail."""
    return [m.span() for m in IP.finditer(text) if all(len(g.lstrip("0")) <= 3 and int(g[-4:]) <= 255 for g in m.groups())]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]


def find(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) by kind, then start, in code points."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for kind, spans in (("ip", ips), ("card", cards), ("phone", phones)):
            out += [(kind, *s) for s in spans(text)]
    return out


def value_of(text: str, kind: str, a: int, b: int) -> str:
    """The entity that a span names: one for all ways to write it."""
    return f"{kind}:" + (text[a:b].lower() if kind == "email" else text[a:b] if kind == "ip" else "".join(filter(str.isdigit, text[a:b])))


def surroundings(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, int, int, int]]:
    """(entity, term, start, end, hash of the surroundings) for the terms
    within reach of each entity, outside of all spans."""
    out, free = [], _outside(spans)
    for kind, a, b in spans:
        entity = value_of(text, kind, a, b)
        lo, hi = max(0, a - 40 * REACH), min(len(text), b + 40 * REACH)
        while lo and text[lo - 1].isalnum() and lo > a - 80 * REACH:  # from the start of a word
            lo -= 1
        near = [m for m in TERM.finditer(text, lo, hi) if free(m) and (m.end() < hi or hi == len(text))]
        left = [m for m in near if m.end() <= a][-REACH:]
        right = [m for m in near if m.start() >= b][:REACH]
        around = zlib.crc32(" ".join(m.group().lower() for m in left + right).encode())
        for m in left + right:
            if m.end() - m.start() >= LEAST_TERM:
                out.append((entity, m.group().lower(), m.start(), m.end(), around))
    return out


# ---------------------------------------------------------------------------
# The corpus
# ---------------------------------------------------------------------------
SPAN = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType())])
NEAR = StructType(
    [StructField("entity", StringType()), StructField("term", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("around", LongType())]
)
SPAN_ARROW = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
NEAR_ARROW = pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("around", pa.int64())])


def text_key(text: str) -> bytes:
    return hashlib.md5(text.encode("utf-8")).digest()


def entities(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``text_key``, ``spans``, ``near``."""
    new = StructType([StructField("text_key", BinaryType()), StructField("spans", ArrayType(SPAN)), StructField("near", ArrayType(NEAR))])
    kept, schema = extended(df.drop(text), new)
    source, places = df.columns.index(text), [df.columns.index(k) for k in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, spans, near = [], [], []
            for x in batch.column(source).to_pylist():
                x = x or ""
                found = find(x)
                keys.append(text_key(x))
                spans.append([dict(zip(("kind", "start", "end"), s)) for s in found])
                near.append([dict(zip(("entity", "term", "start", "end", "around"), s)) for s in surroundings(x, found)])
            arrays = [pa.array(keys, pa.binary()), pa.array(spans, pa.list_(SPAN_ARROW)), pa.array(near, pa.list_(NEAR_ARROW))]
            yield pa.RecordBatch.from_arrays([batch.column(p) for p in places] + arrays, names=schema.names)

    return df.mapInArrow(run, schema)


def _outside(spans: list[tuple[str, int, int]]):
    """Whether a match lies outside of all spans."""
    begins, ends = [], []
    for _, a, b in sorted(spans, key=lambda s: s[1:]):  # merged, so both lists ascend
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)

    def free(m: re.Match) -> bool:
        k = bisect_right(ends, m.start())
        return k == len(ends) or begins[k] >= m.end()

    return free


def bitmap(values: DataFrame, rows: int) -> bytes:
    """Bits of the hashes of one text column, sixteen a value as far as
    ``MAX_BITS`` goes."""
    bits = min(MAX_BITS, max(BITS, 1 << (16 * rows - 1).bit_length()))
    at = (F.crc32(values[values.columns[0]].cast("binary")) % bits).cast("int").alias("p")
    places = values.select(at).distinct().toArrow()  # at most MAX_BITS numbers
    on = np.zeros(bits, np.uint8)
    on[places.column(0).to_numpy()] = 1
    return np.packbits(on).tobytes()


COUNTS = StructType([StructField("entity", StringType()), StructField("term", StringType()), StructField("n", LongType())])


def term_documents(df: DataFrame, terms: bytes, pairs: bytes, text: str = "text") -> DataFrame:
    """(entity, term, n): documents that hold each term (entity: null), and
    each pair of an entity and a term, of those whose hashes are in the
    bitmaps.  A task counts over all of its rows, and passes its counts on at
    ``COUNTED`` of them."""
    shared = df.sparkSession.sparkContext.broadcast((terms, pairs))  # MAX_BITS / 8 bytes each at most

    def counted(n: Counter) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in n], pa.string()) for i in range(2)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(n.values()), pa.int64())], names=COUNTS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on, both = (np.unpackbits(np.frombuffer(x, np.uint8)).tobytes() for x in shared.value)
        size, wide, n = len(on), len(both), Counter()
        for batch in slices(batches):
            for x in batch.column(0).to_pylist():
                x = x or ""
                held = [w for w in {w.lower() for w in set(TERM.findall(x))} if on[zlib.crc32(w.encode()) % size]]
                n.update([(None, w) for w in held])
                for entity in {value_of(x, *s) for s in find(x)} if held else ():
                    start = zlib.crc32(f"{entity}\n".encode())
                    n.update([(entity, w) for w in held if both[zlib.crc32(w.encode(), start) % wide]])
            if len(n) >= COUNTED:
                yield counted(n)
                n = Counter()
        yield counted(n)

    return df.select(text).mapInArrow(run, COUNTS).groupBy("entity", "term").agg(F.sum("n").alias("n"))


def bits_left(ct, contexts, t):
    """-log2 of the lower bound of ct / t.  ``t`` documents of which ``ct``
    show ``contexts`` surroundings are as many observations as surroundings
    stand for."""
    share, seen = ct / t, t * F.least(contexts, ct) / ct
    lower = (share + Z**2 / (2 * seen) - Z * F.sqrt(F.greatest(F.lit(0.0), share * (1 - share)) / seen + (Z / (2 * seen)) ** 2)) / (1 + Z**2 / seen)
    return -F.log2(lower)


def disclosures(documents: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """(entity, term, bits) of the pairs that leave ``GENERALISE`` bits or
    fewer.  ``found`` is the stored result of ``entities``."""
    near = found.select(F.explode("near").alias("x")).select("x.entity", "x.term", "x.around")
    contexts = near.distinct().groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts"))
    candidates = stored(contexts, "pii-candidates")
    rows = candidates.count()
    terms = bitmap(candidates.select("term"), rows)
    pairs = bitmap(candidates.select(F.concat_ws("\n", "entity", "term")), rows)
    counts = stored(term_documents(documents, terms, pairs, text), "pii-counts")
    of_term = counts.where("entity IS NULL").select("term", F.col("n").alias("t"))
    of_pair = counts.where("entity IS NOT NULL").select("entity", "term", F.col("n").alias("ct"))
    holders = found.select(F.array_distinct(F.transform("near", lambda x: x["entity"])).alias("e"))
    held = holders.select(F.explode("e").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("c"))
    n = found.count()
    left = bits_left(F.col("ct"), F.col("contexts"), F.col("t"))
    return (
        candidates.join(of_pair, ["entity", "term"]).join(of_term, "term").join(held, "entity")
        .select("entity", "term", left.alias("bits"), (F.log2(F.lit(float(n)) / F.col("c")) - left).alias("gain"))
        .where((F.col("bits") <= GENERALISE) & (F.col("gain") >= GAIN)).drop("gain")
    )


PLACES = StructType([StructField("told_key", BinaryType()), StructField("term", StringType()), StructField("start", LongType()), StructField("end", LongType())])


def term_places(df: DataFrame, terms: bytes, text: str = "text") -> DataFrame:
    """(told_key, term, start, end): places of the terms whose hashes are in
    the bitmap, outside of the patterns' spans, in each distinct text that a
    batch has."""
    shared = df.sparkSession.sparkContext.broadcast(terms)  # MAX_BITS / 8 bytes at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.unpackbits(np.frombuffer(shared.value, np.uint8)).tobytes()
        size = len(on)
        for batch in slices(batches):
            rows: list[tuple] = []
            for x in set(batch.column(0).to_pylist()) - {None, ""}:
                held = {w for w in {w.lower() for w in set(TERM.findall(x))} if on[zlib.crc32(w.encode()) % size]}
                if held:
                    free, key = _outside(find(x)), text_key(x)
                    rows += [(key, w, m.start(), m.end()) for m in TERM.finditer(x) if (w := m.group().lower()) in held and free(m)]
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string(), pa.int64(), pa.int64()))], names=PLACES.names)

    return df.select(text).mapInArrow(run, PLACES)


def term_spans(documents: DataFrame, told: DataFrame, text: str = "text") -> DataFrame:
    """(told_key, terms): spans of terms that tell in each distinct text.
    ``told`` is the stored result of ``disclosures``."""
    worst = told.groupBy("term").agg(F.min("bits").alias("bits"))
    places = term_places(documents, bitmap(told.select("term"), told.count()), text)
    kind = F.when(F.col("bits") <= REMOVE, F.lit("removed")).otherwise(F.lit("generalised"))
    hit = places.join(worst, "term").select("told_key", F.struct(kind.alias("kind"), "start", "end").alias("span"))
    # copies of a text give the same spans; a set takes them once
    return hit.groupBy("told_key").agg(F.sort_array(F.collect_set("span")).alias("terms"))


def spans(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without its text, with ``spans`` of the patterns and
    ``terms``, the spans of disclosing terms."""
    found = stored(entities(documents, text), "pii-entities")
    told = stored(disclosures(documents, found, text), "pii-disclosures")
    terms = stored(term_spans(documents, told, text).withColumnRenamed("told_key", "text_key"), "pii-places")
    rest = found.select(*[c for c in found.columns if c.lower() not in ("near", "terms")])
    row = free_name(rest.columns, "row")
    # copies of a text may be many: by their number, not their key alone
    return with_one(rest.withColumn(row, F.monotonically_increasing_id()), terms, "text_key", row, entries=F.size("terms") + 1).drop(row)


def mask(text: str, found: list[tuple[str, int, int]]) -> str:
    """Text with pattern spans replaced by their kind, disclosing terms
    removed or replaced; spans that overlap are masked as one."""
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        out.append(text[at : max(a, at)])
        if a >= at:
            out.append({"removed": "", "generalised": "[TERM]"}.get(kind, f"[{kind.upper()}]"))
        at = b
    return "".join([*out, text[at:]])


def sanitised(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with personal data masked in its text."""
    slim = documents.select(F.col(f"`{text}`").alias("text"))
    found = stored(entities(slim, "text"), "pii-entities")
    told = stored(disclosures(slim, found), "pii-disclosures")
    key, row, terms = (free_name(documents.columns, n) for n in ("told_key", "row", "terms"))
    flagged = stored(term_spans(slim, told).withColumnsRenamed({"told_key": key, "terms": terms}), "pii-places")
    numbered = documents.withColumn(key, F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))).withColumn(row, F.monotonically_increasing_id())
    joined = with_one(numbered, flagged, key, row, entries=F.size(terms) + 1).select(*[F.col(f"`{c}`") for c in documents.columns], terms)
    source, more, names = joined.columns.index(text), joined.columns.index(terms), documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            clean = []
            for x, t in zip(batch.column(source).to_pylist(), batch.column(more).to_pylist()):
                clean.append(x and mask(x, find(x) + [(s["kind"], s["start"], s["end"]) for s in t or []]))
            columns = [pa.array(clean, pa.string()) if k == source else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.select(*[F.col(f"`{c}`") for c in names], F.col(terms)).mapInArrow(run, documents.schema)


def digest(documents: DataFrame) -> DataFrame:
    """Per document: counts, the base spans' hash, all spans."""
    made = spans(documents.select("doc_id", "text"))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    terms = F.coalesce("terms", F.lit([]).cast(ArrayType(SPAN)))
    return made.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(line(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
        line(F.concat("spans", terms)).alias("spans"),
    )

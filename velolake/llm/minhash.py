"""Near-duplicate documents by DartMinHash and banded joining.

A document is the weighted set of its five-word shingles (weight: count).
Each element's region is its weight by an endless rank axis.  Darts fall on
the regions as a Poisson process that depends on the element alone, each
with a rank and a coordinate; the earliest dart of a coordinate is the
signature's value there.  Only darts below a rank that is likely to fill all
coordinates are thrown (more if one stays empty), so a signature takes about
as many darts as it needs, not one hash per element and coordinate.  Two
documents agree in a coordinate with the probability of their weighted
Jaccard similarity.

Signatures are cut into bands; texts with a band in common are candidates.
Pairs of them are compared exactly, and linked texts form classes (connected
components).  Not all pairs of a bucket are made: first each member meets
one member of its bucket, another in each turn; what links are found joins
classes, and pairs within a class are never made.  Then texts of buckets that
still hold several classes are compared, so no link that the bands show is
lost; not all pairs of a bucket, but those that share one of their rarest
shingles.  (In the order of rarity, similar sets share a shingle behind which
each has at least the least similarity of its weight, as what they share lies
there.  Texts of one template, which differ by more, have shingles of their
own there and make no pair; nor do those behind whose rarest common shingle too
little lies.)  Pairs that can't be similar are not made at all:
what two sets share is at most what either shares with any set, so a text with
many shingles of its own is known to be alone.  Copies are one node of this
graph.

At similarity 0.8 a pair shares no band with probability 3e-6.

Words are runs of letters, digits and underscores, lower-cased.

Defined cases: a null, empty or wordless text is in a class of its own; one
to four words make one shingle; repeated rows and equal texts are in one
class; the smallest id names a class, a class of null ids has a null name;
texts of any length are taken whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from velolake.llm.common import extended, free_name, slices, stored, with_one

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
STARS = 3  # turns in which bucket members meet one of them
BROADCAST_ROWS = 1 << 20  # text hashes that are sent to all executors
WORD = re.compile(r"\w+")
WORDS_KEPT = 300_000  # entries of the table of hashed words, per worker

_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Words and shingles as 64-bit hashes, with a bounded table of words."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def words(self, text: str) -> np.ndarray:
        import xxhash

        found = WORD.findall(text.lower())
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        known = self.known
        for w in set(found).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))

    def shingles(self, text: str) -> np.ndarray:
        """Hashes of the shingles in a row; fewer words make one shingle."""
        h = self.words(text)
        n = max(1, len(h) - SHINGLE + 1) if len(h) else 0
        s = np.zeros(n, np.uint64)
        for k in range(min(SHINGLE, len(h))):
            s = mixed(s * _M3 + h[k : k + n])
        return s


def darts(elements: np.ndarray, weights: np.ndarray, upto: np.ndarray, coordinates: int) -> tuple[np.ndarray, ...]:
    """The darts below rank ``upto`` (one bound for each element) on the
    elements' regions: number of the element, rank, coordinate, identity.  A
    region is cut into cells of weight one; each cell's darts arrive in a
    Poisson process of their own, and the last cell keeps those that fall
    within its share."""
    cells = np.ceil(weights).astype(np.int64)
    which = np.repeat(np.arange(len(elements)), cells)
    cell = np.arange(len(which)) - np.repeat(np.cumsum(cells) - cells, cells)
    seed = mixed(elements[which] + cell.astype(np.uint64) * _M3)
    share, bound = weights[which] - cell, upto[which]
    rank, out, turn = np.zeros(len(seed)), [], 0
    while len(seed):
        h = mixed(seed + np.uint64((2 * turn + 1) * int(_M2) % 2**64))
        uniform = (h >> np.uint64(11)).astype(float) * 2.0**-53
        on = np.flatnonzero(uniform < -np.expm1(rank - bound))  # only these arrive below the bound
        which, seed, share, bound, h = which[on], seed[on], share[on], bound[on], h[on]
        rank = rank[on] - np.log1p(-uniform[on])
        at = mixed(h + _M3)
        if (share < 1).any():
            ok = np.flatnonzero((mixed(at) >> np.uint64(11)).astype(float) * 2.0**-53 < share)
        else:
            ok = slice(None)
        out.append((which[ok], rank[ok], (at[ok] % np.uint64(coordinates)).astype(np.int64), h[ok]))
        turn += 1
    return tuple(np.concatenate([o[k] for o in out]) for k in range(4)) if out else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.uint64))


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], coordinates: int = BANDS * ROWS) -> np.ndarray:
    """For each weighted set (elements, weights; none empty), the identity of
    the earliest dart of each coordinate."""
    out = np.zeros((len(sets), coordinates), np.uint64)
    todo, factor = np.arange(len(sets)), np.log(coordinates) + 2
    while len(todo):
        owner = np.repeat(np.arange(len(todo)), [len(sets[i][0]) for i in todo])
        weights = np.concatenate([sets[i][1] for i in todo])
        upto = coordinates * factor / np.bincount(owner, weights)
        which, rank, at, ident = darts(np.concatenate([sets[i][0] for i in todo]), weights, upto[owner], coordinates)
        place = owner[which] * coordinates + at
        order = np.argsort(place + rank / (upto.max() * (1 + 1e-9)))
        place = place[order]
        first = np.flatnonzero(np.diff(place, prepend=-1))
        filled = np.bincount(place[first] // coordinates, minlength=len(todo)) == coordinates
        keep = first[filled[place[first] // coordinates]]
        out[todo[filled]] = ident[order[keep]].reshape(-1, coordinates)
        todo, factor = todo[~filled], 2 * factor
    return out


def band_keys(sig: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per document and band, different bands apart."""
    rows = sig.reshape(len(sig), bands, -1)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _M3, (len(sig), 1))
    for k in range(rows.shape[2]):
        key = mixed(key + rows[:, :, k])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sets (sorted elements, weights)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    union = float(a[1].sum() + b[1].sum()) - both
    return both / union if union else 0.0


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
SIGNED = StructType([StructField("node", LongType()), StructField("bands", ArrayType(LongType()))])
SETS = StructType([StructField("node", LongType()), StructField("shingles", BinaryType())])
_local = threading.local()


def _shingler() -> Shingler:
    if not hasattr(_local, "shingler"):
        _local.shingler = Shingler()
    return _local.shingler


def node_of(shingles: np.ndarray) -> int:
    """64-bit name of a text: the hash of its shingles in a row."""
    import xxhash

    return xxhash.xxh64_intdigest(shingles.tobytes()) - 2**63


def weighted(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    elements, counts = np.unique(shingles, return_counts=True)
    return elements, counts.astype(float)


def signed(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``node`` (null: no words) and ``bands``."""
    kept, schema = extended(df.drop(text), SIGNED)
    source, places = df.columns.index(text), [df.columns.index(k) for k in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler()
        for batch in slices(batches, 64):
            nodes, at, sets = [], {}, []
            for x in batch.column(source).to_pylist():
                s = shingler.shingles(x or "")
                node = node_of(s) if len(s) else None
                if node is not None and node not in at:
                    at[node] = len(sets)
                    sets.append(weighted(s))
                nodes.append(node)
            keys = band_keys(signatures(sets)) if sets else np.zeros((0, BANDS), np.int64)
            bands = pa.array([None if n is None else keys[at[n]] for n in nodes], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(p) for p in places] + [pa.array(nodes, pa.int64()), bands], names=schema.names)

    return df.mapInArrow(run, schema)


def shingle_sets(df: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """(node, shingles) of the wanted (node, text_hash) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = _shingler()
        for batch in slices(batches):
            found: dict[int, bytes] = {}
            for x in batch.column(0).to_pylist():
                s = shingler.shingles(x or "")
                node = node_of(s) if len(s) else None
                if node is not None and node not in found:
                    elements, counts = weighted(s)
                    found[node] = elements.tobytes() + counts.astype(np.uint32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=SETS.names)

    side = wanted.select("text_hash").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        side = F.broadcast(side)  # counted; a longer list is shuffled with the texts
    t = F.col(f"`{text}`")
    sent = df.select(t.alias("text")).withColumn("text_hash", F.xxhash64("text")).join(side, "text_hash", "left_semi")
    return sent.select("text").mapInArrow(run, SETS).join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles"))


SHARED = StructType([StructField("shingle", LongType()), StructField("node", LongType()), StructField("weight", LongType())])


def weights(sets: DataFrame) -> DataFrame:
    """(node, weight, common): the weight of a set, and that of its shingles
    which any other set holds.  What two sets share is ``common`` of either
    at most, which bounds their similarity without comparing them."""

    each = sets.select("node", "shingles").mapInArrow(_exploded, SHARED)
    held = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.sum("weight").alias("weight"))
    own = held.where("n = 1").groupBy("node").agg(F.sum("weight").alias("own"))
    whole = sets.select("node", "shingles").mapInArrow(_total, TOTAL)
    return whole.join(own, "node", "left").select("node", "weight", (F.col("weight") - F.coalesce("own", F.lit(0))).alias("common"))


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of (node, shingles) rows."""
    for batch in slices(batches, 256):
        got = [_set(x) for x in batch.column(1).to_pylist()]
        nodes = np.repeat(batch.column(0).to_numpy(), [len(e) for e, _ in got])
        cat = lambda k, t: np.concatenate([g[k] for g in got]).astype(t) if got else np.zeros(0, t)
        yield pa.RecordBatch.from_arrays([pa.array(cat(0, np.uint64).view(np.int64)), pa.array(nodes, pa.int64()), pa.array(cat(1, np.int64))], names=SHARED.names)


TOTAL = StructType([StructField("node", LongType()), StructField("weight", LongType())])


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = [int(_set(x)[1].sum()) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.int64())], names=TOTAL.names)


def _set(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(packed) // 12
    return np.frombuffer(packed, np.uint64, n), np.frombuffer(packed, np.uint32, n, 8 * n).astype(float)


def compared(pairs: DataFrame, sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``pairs`` (a, b) with ``linked``: similarity of ``least`` or more."""
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"
    )
    schema = StructType([StructField("a", LongType()), StructField("b", LongType()), StructField("linked", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            linked = [similarity(_set(x), _set(y)) >= least for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=schema.names)

    return joined.select("a", "b", "x", "y").mapInArrow(run, schema)


def rare_pairs(nodes: DataFrame, sets: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, member: a struct) that share one of
    their rarest shingles: all that can be ``least`` similar, and few others.

    What two similar sets share lies, in both, behind the rarest shingle they
    share.  So a shared shingle makes a pair only if enough lies behind it in
    either set for their similarity; at the rarest one that holds for every
    similar pair."""
    each = sets.join(nodes.select("node"), "node", "left_semi").select("node", "shingles").mapInArrow(_exploded, SHARED)
    each = stored(each, "rest-shingles")
    many = stored(each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "rest-counts")
    ranked = with_one(each, many, "shingle", "node").withColumn("n", F.coalesce("n", F.lit(1)))
    of_node = Window.partitionBy("node")
    behind = F.sum("weight").over(of_node.orderBy(F.col("n").desc(), F.col("shingle").desc()).rowsBetween(Window.unboundedPreceding, 0))
    reach = ranked.select("node", "shingle", "n", behind.alias("behind"), F.sum("weight").over(of_node).alias("whole"))
    rare = reach.where((F.col("n") > 1) & (F.col("behind") >= least * F.col("whole") - 1e-9)).select("node", "shingle", "behind", "whole")
    held = stored(rare.join(nodes, "node"), "rare-shingles")
    other = held.select(F.col("shingle").alias("same"), F.col("node").alias("b"), F.col("member").alias("o"), F.col("behind").alias("o_behind"), F.col("whole").alias("o_whole"))
    shared = F.least("behind", "o_behind")  # at most
    enough = shared >= least * (F.col("whole") + F.col("o_whole") - shared) - 1e-9
    return held.join(other, (F.col("shingle") == F.col("same")) & (F.col("node") < F.col("b")) & enough)


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of all nodes in ``links`` (a, b): each takes the smallest
    name among its neighbours, then its name's name, until nothing changes.
    Every round is stored, so lineage stays short."""
    both = links.select(F.col("a").alias("near"), F.col("b").alias("far"))
    both = stored(both.union(both.select("far", "near")).distinct(), "links")
    names = stored(both.groupBy(F.col("near").alias("node")).agg(F.min(F.least("near", "far")).alias("comp")), "names")
    while True:
        near = with_one(both, names.select(F.col("node").alias("far"), "comp"), "far", "near", "inner").groupBy(F.col("near").alias("node")).agg(F.min("comp").alias("near"))
        lower = names.join(near, "node").select("node", "comp", F.least("comp", "near").alias("low"))
        jump = names.select(F.col("node").alias("low"), F.col("comp").alias("far"))
        new = stored(with_one(lower, jump, "low", "node", "inner").select("node", F.least("low", "far").alias("comp"), F.col("comp").alias("was")), "names")
        changed = new.where("comp <> was").limit(1).count()
        names = new.select("node", "comp")
        if not changed:
            return names


def joined_classes(names: DataFrame, links: DataFrame) -> DataFrame:
    """``names`` (node, comp) after new links: the classes they join are the
    components of the links between classes, of which there are fewer in
    each turn."""
    end = lambda k: names.select(F.col("node").alias(k), F.col("comp").alias(f"{k}_comp"))
    between = links.select("a", "b").join(end("a"), "a").join(end("b"), "b")
    between = stored(between.where("a_comp <> b_comp").select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")).distinct(), "class-links")
    if between.isEmpty():
        return names
    new = components(between).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    return stored(with_one(names, new, "comp", "node").select("node", F.coalesce("to", "comp").alias("comp")), "names")


def classes(df: DataFrame, id_col: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """Per row of ``df``: id, node and ``comp``, the name of its class."""
    slim = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").alias("text"))
    rows = stored(signed(slim), "signed")
    texts = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands"))
    members = texts.select("node", F.explode("bands").alias("band"))
    shared = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = stored(members.join(shared, "band"), "buckets")
    seen = found.groupBy("node").agg(F.sum("n").alias("met"))
    wanted = stored(rows.join(seen.select("node"), "node", "left_semi").groupBy("node").agg(F.min("text_hash").alias("text_hash")), "wanted")
    sets = stored(shingle_sets(df, wanted, text), "shingle-sets")
    known = stored(weights(sets).join(seen, "node").where(F.col("common") >= least * F.col("weight") - 1e-9), "known")
    kept = stored(found.select("band", "node").join(known, "node"), "members")
    member = F.struct("node", "comp", "weight", "common", "met")
    both = F.least("common", "o.common")
    possible = both >= least * (F.col("weight") + F.col("o.weight") - both) - 1e-9
    names = stored(known.select("node", F.col("node").alias("comp")), "names")
    tested, turn = None, 0
    while True:
        named = kept.join(names, "node")
        if turn < STARS:
            # each member of a bucket with one of its members: the one that
            # meets most others (an original, among its copies), then others
            order = F.struct("met", "node") if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)), "node")
            star = named.groupBy("band").agg(F.max_by(member, order).alias("o"))
            met = named.join(star, "band")
        else:
            # what is left: texts of buckets that still hold several classes
            mixed_up = named.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("band")
            rest = stored(named.join(mixed_up, "band").select("node", member.alias("member")).distinct(), "unjoined")
            met = rare_pairs(rest, sets, least).select("member.*", "o")
        pairs = met.where((F.col("comp") != F.col("o.comp")) & possible).select(F.least("node", "o.node").alias("a"), F.greatest("node", "o.node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        fresh = stored(compared(stored(pairs, "pairs"), sets, least), "compared")
        tested = fresh if tested is None else tested.union(fresh)
        names = joined_classes(names, fresh.where("linked"))
        turn += 1
        if turn > STARS:
            break
    return rows.select("id", "node").join(names, "node", "left").select("id", "node", F.coalesce("comp", "node").alias("comp"))


def digest(documents: DataFrame) -> DataFrame:
    """Per document: the smallest id of its class, and the class's rows.  A
    text without words is in a class of its own."""
    found = stored(classes(documents), "classes")
    size = found.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_class"))
    return with_one(found, size, "comp", "id").select(
        F.col("id").alias("doc_id"), F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_class", F.lit(1)).cast("long").alias("n_class"),
    )


def deduplicated(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each class: that of the smallest id (and
    of these the smallest text hash, then the smallest row); texts without
    words all stay."""
    names = documents.columns
    row = free_name(names, "row_of_class")
    numbered = stored(documents.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = stored(classes(numbered.withColumn("doc_id", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("h"), F.col(row).alias("r")))), "classes")
    first = found.where("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("id")).select(F.col("id.r").alias(row))
    alone = found.where("comp IS NULL").select(F.col("id.r").alias(row))
    return numbered.join(first.union(alone), row, "left_semi").select(*[F.col(f"`{c}`") for c in names])

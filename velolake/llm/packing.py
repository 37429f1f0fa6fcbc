"""Best-fit decreasing packing of tokenised documents into sequences.

Pieces of one length are alike, so what best-fit decreasing does to a corpus
depends on the number of pieces of each length alone.  Spark counts those
(at most ``capacity`` numbers, whatever the size of the corpus).  The plan
is then made run by run: bins with one history are a range of numbers, a
segment tree over the remaining capacities finds the tightest open class in
logarithmic time, and a run of equal pieces fills a range of bins at once.
Last, Spark ranks the pieces within their length and looks up the run that
each rank falls into.

Ranks come from counts per (length, salt) and a row number within each, so a
length that a third of all pieces share is ranked by many tasks.

Defined cases: a null text is the empty text (one piece, the end id alone);
a document longer than the capacity is cut into full pieces and a rest;
repeated rows and null ids are packed as documents of their own (their
pieces each get a place); an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from velolake.llm.common import extended, slices, stored

CAPACITY = 4096
END_ID = 1
WORDS_KEPT = 200_000  # entries of each of the two tables of encoded words, per worker
ROWS = 4096  # texts whose words are looked up together, each distinct one once
SALTS = 64  # a length's pieces are ranked in so many parts


# ---------------------------------------------------------------------------
# Token ids
# ---------------------------------------------------------------------------
class WordEncoder:
    """Ids of whole texts by a tokenizer whose pieces never hold white space:
    texts are cut at ASCII white space, each word is encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def table(self, words: list[str]) -> list[bytes]:
        """Packed ids of distinct words, from the kept ones or the tokenizer."""
        young, old = self.young.get, self.old.get
        got = list(map(young, words))
        missing = [k for k, x in enumerate(got) if x is None]
        fresh: dict[str, bytes] = {"": b""}
        parts = []
        for k in missing:
            word = words[k]
            x = got[k] = old(word)
            if x is None:
                core, tail = (word, "") if word.isascii() and word.isalpha() and word.islower() else parted(word)
                parts.append((k, core, tail))
                if core not in fresh:
                    fresh[core] = young(core) or old(core) or b""
                if tail not in fresh:
                    fresh[tail] = young(tail) or old(tail) or b""
        del fresh[""]
        self.tokenize([x for x, ids in fresh.items() if not ids], fresh)
        for k, core, tail in parts:
            got[k] = fresh.get(core, b"") + fresh[tail] if tail else fresh.get(core, b"")
        if len(self.young) + len(missing) + len(fresh) > WORDS_KEPT:  # those in use move on
            self.young, self.old = {}, self.young
        kept = self.young
        for w, x in fresh.items():
            if len(w) <= 64:
                kept[w] = x
        for k in missing:
            if len(words[k]) <= 64:
                kept[words[k]] = got[k]
        return got

    def tokenize(self, words: list[str], into: dict[str, bytes]) -> None:
        """Words of letters alone are one token run each, whose last id ends
        a word: many go to the tokenizer as one text.  The rest go one by one."""
        plain = [w for w in words if w.isalpha() and (w.isascii() or len(x := w.lower()) == len(w) and x.isalpha())]
        rest = set(words).difference(plain)
        for at in range(0, len(plain), 1000):
            some = plain[at : at + 1000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):
                rest.update(some)
                continue
            packed, starts = ids.tobytes(), [0, *(4 * ends).tolist()]
            into.update((w, packed[i:j]) for w, i, j in zip(some, starts, starts[1:]))
        rest = list(rest)
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            into[w] = array("I", e.ids).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each."""
        if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
            words = pc.split_pattern_regex(texts, "[ \t\n\r]+")  # those are no white space to the tokenizer
        else:
            words = pc.utf8_split_whitespace(texts)
        flat = words.flatten().dictionary_encode()
        packed = self.table(flat.dictionary.to_pylist())
        size = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        word = flat.indices.to_numpy(zero_copy_only=False)
        ids = np.frombuffer(b"".join(map(packed.__getitem__, word.tolist())), "<u4")
        lists = np.diff(words.offsets.to_numpy(zero_copy_only=False).astype(np.int64))
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size[word])])
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(lists)])
        return ids, np.diff(ends[upto])


def parted(word: str) -> tuple[str, str]:
    """A word and the marks behind its last letter; the tokenizer always
    cuts there.  Capitals of an ASCII word are no matter to it."""
    core = word.rstrip(".,;:!?")
    if core == word or not core or not core[-1].lower().isalpha():
        core = word
    tail = word[len(core) :]
    return core.lower() if core.isascii() and "<" not in core else core, tail


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


PIECE = StructType(
    [StructField("piece", IntegerType()), StructField("start", LongType()), StructField("length", LongType()), StructField("ids_crc32", LongType())]
)


def pieces(df: DataFrame, tokenizer: str, text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each row's token ids (and the end id): its
    number, the ids of the row before it, its length, its ids' CRC-32.
    ``text`` gives way; other columns pass through."""
    kept, schema = extended(df.drop(text), PIECE)
    source, places = df.columns.index(text), [df.columns.index(k) for k in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_encoder(tokenizer), array("I", [end_id]).tobytes()
        for batch in slices(batches, ROWS):
            rows, number, start, length, crc = [], [], [], [], []
            ids, size = encoder.encode(pc.fill_null(batch.column(source), ""))
            packed, first = memoryview(ids.tobytes()), 0
            for row, n in enumerate((4 * size).tolist()):
                for k, at in enumerate(range(0, n + 4, 4 * capacity)):
                    upto = min(at + 4 * capacity, n + 4)
                    value = zlib.crc32(packed[first + at : first + min(upto, n)])
                    rows.append(row)
                    number.append(k)
                    start.append(at // 4)
                    length.append((upto - at) // 4)
                    crc.append(zlib.crc32(end, value) if upto > n else value)
                first += n
            take = pa.array(rows, pa.int64())
            new = [pa.array(number, pa.int32())] + [pa.array(x, pa.int64()) for x in (start, length, crc)]
            yield pa.RecordBatch.from_arrays([batch.column(p).take(take) for p in places] + new, names=schema.names)

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------------------
# The plan
# ---------------------------------------------------------------------------
class Tightest:
    """Segment tree over remaining capacities 0..n: which have open bins."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.any = bytearray(2 * self.size)

    def set(self, capacity: int, on: bool) -> None:
        i = capacity + self.size
        self.any[i] = on
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def least(self, needed: int) -> int:
        """The smallest capacity of ``needed`` or more with open bins; -1."""
        i = needed + self.size
        if not self.any[i]:
            while i > 1 and (i & 1 or not self.any[i + 1]):
                i >>= 1
            if i <= 1:
                return -1
            i += 1
            while i < self.size:
                i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.size


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing for ``counts`` pieces of each length, as runs
    (length, first rank, pieces, first bin, offset): the pieces with ranks
    from ``first rank`` go to bins from ``first bin``, one each, at
    ``offset``.  Bins of one remaining capacity fill in order of number."""
    open_bins: dict[int, list[tuple[int, int]]] = {}  # remaining capacity: ranges of bins
    tree, runs, bins = Tightest(capacity), [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        rank, left = 0, counts[length]
        while left:
            room = tree.least(length)
            if room < 0:
                room = capacity
                first, n = bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = open_bins[room].pop(0)
            # the next piece of the same length fits tightest where this one
            # went: a bin takes all it can hold before the next one is opened
            each = room // length
            full = min(n, left // each)
            last = min(left - full * each, each) if full < n else 0
            for held, begin, width in ((each, first, full), (last, first + full, 1)):
                for k in range(held if width else 0):
                    runs.append((length, rank, width, begin, capacity - room + k * length))
                    rank += width
                if held and width and room > held * length:
                    insort(open_bins.setdefault(room - held * length, []), (begin, width))
                    tree.set(room - held * length, True)
            used = full + (last > 0)
            if used < n:
                insort(open_bins.setdefault(room, []), (first + used, n - used))
            if room < capacity or used < n:
                tree.set(room, bool(open_bins.get(room)))
            left -= full * each + last
    return runs


def pack(items: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset`` by best-fit decreasing.

    ``items`` is read more than once: give it as a stored table."""
    salted = items.withColumn("_salt", F.pmod(F.xxhash64(*items.columns), F.lit(SALTS)).cast("int"))
    per_salt = salted.groupBy(F.col(length).alias("_length"), "_salt").agg(F.count(F.lit(1)).alias("_n"))
    # at most capacity * SALTS numbers, however many items there are
    parts = sorted((r._length, r._salt, r._n) for r in per_salt.collect())
    counts: dict[int, int] = {}
    before: dict[tuple[int, int], int] = {}
    for size, salt, n in parts:
        before[size, salt] = counts.get(size, 0)
        counts[size] = counts.get(size, 0) + n
    runs = plan(counts, capacity)
    # sorted by (length, rank), as one key; ranks stay far below 2**48
    key = np.array([r[0] << 48 | r[1] for r in runs], np.int64)
    base, at = np.array([r[3] for r in runs], np.int64), np.array([r[4] for r in runs], np.int64)
    order = np.argsort(key)
    key, base, at = key[order], base[order], at[order]
    offsets = np.zeros((capacity + 1, SALTS), np.int64)
    for (size, salt), n in before.items():
        offsets[size, salt] = n
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy(length, "_salt").orderBy(*[F.col(f"`{c}`") for c in items.columns])) - 1)
    new = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])
    kept, schema = extended(items, new)
    places = {c: i for i, c in enumerate(ranked.columns)}
    # a few numbers per run of the plan: bounded by the capacity, not by the items
    shared = items.sparkSession.sparkContext.broadcast((key, base, at, offsets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, base, at, offsets = shared.value
        for batch in batches:
            size = batch.column(places[length]).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(places["_rank"]).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = rank + offsets[size, batch.column(places["_salt"]).to_numpy(zero_copy_only=False)]
            found = np.searchsorted(key, size << 48 | rank, side="right") - 1
            bins = base[found] + rank - (key[found] & ((1 << 48) - 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(places[c]) for c in kept] + [pa.array(bins, pa.int64()), pa.array(at[found], pa.int64())], names=schema.names
            )

    return ranked.mapInArrow(run, schema)


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places.  The pieces (a few numbers
    each, no text) are stored once, as two passes read them."""
    cut = pieces(documents.select("doc_id", "text"), tokenizer, capacity=capacity)
    return pack(stored(cut, "pieces"), capacity=capacity)

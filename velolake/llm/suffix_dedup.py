"""Repeated passages by merged Burrows-Wheeler transforms of shards.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
in a document with a smaller id.  All suffixes of a corpus can't be sorted
in one place, so strings are first brought together:

* Anchors.  Every string of ``LENGTH`` bytes holds a minimiser: of its
  ``GRAM``-byte grams the one with the smallest hash (of equals the last).
  Equal strings have equal minimisers.  Grams held by one text alone can't
  be part of a repeat and go; this only chooses candidates.  A block of texts
  tells a gram once, with the smallest holder; it sends the answer on to its
  other holders itself, so a gram that a third of all texts share meets once a
  block.
* Pieces.  Stretches of candidate strings are cut from the texts and go to
  the group their minimiser names: the text and stretch where it occurs
  first.  Neighbouring strings of a copied passage so stay together, and a
  group's pieces that are equal are one piece with its smallest id.
* Merging.  A task deals its pieces to shards.  Each shard's transform comes
  from sorting that shard alone.  The transforms are merged by refining
  their interleave: reading all shards' transforms in the order so far and
  dealing the suffixes out again by the byte in front of them sorts them by
  one byte more.  A boundary between two suffixes that appears in turn h
  tells their common prefix, h - 1; a suffix between two boundaries is
  settled.  After ``LENGTH`` turns what no boundary parts is a repeated
  interval: equal strings, whose smallest id decides.

Of equal texts one, with the smallest id, is cut into pieces, the others go
whole; a block takes one of them for its anchors.  Texts and their grams are
compressed (zstd) before they are shuffled.

Defined cases: null texts are empty; texts shorter than ``LENGTH`` lose
nothing; strings never cross documents; a null id counts as larger than any
other, and rows of one id (two nulls too) never take from each other; any
length of text is covered whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from velolake.llm.common import free_name, slices, stored

LENGTH = 50
GRAM = 24
STRETCH = 512  # bytes of a text that share a group
BLOCK_BYTES = 1 << 21  # text whose anchors are sent as one block
BUCKET_BYTES = 1 << 22  # text per bucket of anchors
MAX_BUCKETS = 1 << 20
SHARD_BYTES = 1 << 16
MERGE_BYTES = 1 << 18  # pieces that are merged at once, whole groups
BROADCAST_BYTES = 32 << 20
LAST_ID = 2**63 - 1  # stands for a null id

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOW24, _LOW48 = np.uint64((1 << 24) - 1), np.uint64((1 << 48) - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


# ---------------------------------------------------------------------------
# Anchors
# ---------------------------------------------------------------------------
def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``GRAM`` (three times eight) bytes from each place."""
    x = data.astype(np.uint64)
    for k in (1, 2, 4):
        x = x[:-k] | (x[k:] << np.uint64(8 * k))
    n = len(data) - GRAM + 1
    h = mixed(x[:n] * _M1 + x[8 : n + 8])
    return mixed(h * _M2 + x[16 : n + 16])


def minimisers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each place where a string of ``LENGTH`` bytes starts: runs of
    starts with one minimiser, as first starts, minimisers' places, hashes."""
    h = gram_hashes(data)
    size, parts = (1 << 24) - LENGTH, []
    for at in range(0, len(h), size):
        x = h[at : at + size + LENGTH - GRAM]
        m = (x & ~_LOW24) | (_LOW24 - np.arange(len(x), dtype=np.uint64))
        span, wide = LENGTH - GRAM + 1, 1
        while 2 * wide <= span:
            m = np.minimum(m[:-wide], m[wide:])
            wide *= 2
        if span > wide:
            m = np.minimum(m[: wide - span], m[span - wide :])
        parts.append((_LOW24 - (m[:size] & _LOW24)).astype(np.int64) + at)
    place = np.concatenate(parts)[: len(data) - LENGTH + 1]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return first, place[first], h[place[first]]


def squeezed(data: bytes) -> bytes:
    """``data`` as it is sent: zstd, behind its length."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unsqueezed(sent: bytes) -> bytes:
    return pa.decompress(pa.py_buffer(sent).slice(8), int.from_bytes(sent[:8], "little"), "zstd", asbytes=True)


def packed_grams(pairs: np.ndarray) -> bytes:
    """(48-bit gram, group) pairs: grams, each pair's place among the distinct
    groups (few: a copied passage has one), these groups."""
    groups, which = np.unique(pairs[:, 1], return_inverse=True)
    low = np.ascontiguousarray(pairs[:, 0]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    places = which.astype("<u4").view(np.uint8).reshape(-1, 4).T  # high bytes, mostly zero, lie together
    return squeezed(len(pairs).to_bytes(8, "little") + low.tobytes() + places.tobytes() + groups.astype("<u8").tobytes())


def unpacked_grams(sent: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = unsqueezed(sent)
    n = int.from_bytes(data[:8], "little")
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8, 6 * n, 8).reshape(-1, 6)
    which = np.ascontiguousarray(np.frombuffer(data, np.uint8, 4 * n, 8 + 6 * n).reshape(4, -1).T).view("<u4").reshape(-1)
    groups = np.frombuffer(data, "<u8", -1, 8 + 10 * n)
    return wide.reshape(-1).view("<u8"), groups[which]


def text_name(data: bytes) -> int:
    return int.from_bytes(hashlib.md5(data).digest()[:8], "big")


ANCHORS = StructType([StructField("bucket", LongType()), StructField("block", LongType())] + [StructField(n, BinaryType()) for n in ("grams", "names", "spots")])
_TWO = np.uint16(1 << 15)  # flag on a spot: the block has a second text with the gram


def anchors(texts: DataFrame, bits: int) -> DataFrame:
    """The minimisers of all texts, packed by block of texts and bucket of
    hashes.  A block tells each gram once, however many of its texts hold it:
    48 bits of the hash, the smallest name, its stretch, whether there is a
    second text.  The other holders go past the buckets, under a bucket of
    their block's own (negative), as (gram, name)."""

    def pack(block: list[bytes]) -> pa.RecordBatch | None:
        distinct = {text_name(x): x for x in block if len(x) >= LENGTH}  # copies hold the same grams
        if not distinct:
            return None
        names = np.array(sorted(distinct), np.uint64)
        grams, owner, spot = [], [], []
        for k, name in enumerate(names.tolist()):
            _, place, h = minimisers(np.frombuffer(distinct[name], np.uint8))
            grams.append(h)
            owner.append(np.full(len(h), k, np.uint32))
            spot.append((place // STRETCH % int(_TWO)).astype(np.uint16))  # it only names a group
        g, o, s = np.concatenate(grams), np.concatenate(owner), np.concatenate(spot)
        order = np.argsort(g, kind="stable")  # of a gram: by name, then by place
        g, o, s = g[order], o[order], s[order]
        first = np.flatnonzero(np.diff(g, prepend=g[0] + np.uint64(1)))
        last = np.append(first[1:], len(g)) - 1
        other = np.ones(len(g), bool)
        other[1:] = (g[1:] != g[:-1]) | (o[1:] != o[:-1])
        other[first] = False
        links = np.stack([g[other] & _LOW48, names[o[other]]], 1)
        s = np.where(o[last] > o[first], s[first] | _TWO, s[first])
        g, n = g[first], names[o[first]]
        bucket = (g >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(g), np.int64)
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        pairs = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(g)]))
        low = g.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        number = int.from_bytes(hashlib.md5(names.tobytes()).digest()[:8], "little") >> 2
        rows = [(b, number, low[i:j].tobytes(), n[i:j].tobytes(), s[i:j].tobytes()) for b, (i, j) in zip(bucket[cuts].tolist(), pairs)]
        if len(links):
            rows.append((-1 - number, number, b"", links.tobytes(), b""))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=ANCHORS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = [], 0
        for batch in slices(batches):
            for x in batch.column(0).to_pylist():
                x = (x or "").encode("utf-8")
                if block and size + len(x) > BLOCK_BYTES:
                    if (out := pack(block)) is not None:
                        yield out
                    block, size = [], 0
                block.append(x)
                size += len(x)
        if block and (out := pack(block)) is not None:
            yield out

    return texts.mapInArrow(run, ANCHORS)


REPLY = StructType([StructField("block", LongType()), StructField("found", BinaryType()), StructField("links", BinaryType())])


def repeated(bucket: pd.DataFrame) -> pd.DataFrame:
    """Of a bucket, the grams that two texts hold: for each block (name,
    gram, group), packed.  A gram is here once a block, not once a text.
    Links pass."""
    if bucket["bucket"].iloc[0] < 0:
        return pd.DataFrame({"block": bucket["block"], "found": [b""] * len(bucket), "links": bucket["names"]})
    low = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in bucket["grams"]]
    size = np.array([len(x) for x in low])
    wide = np.zeros((size.sum(), 8), np.uint8)
    wide[:, :6] = np.concatenate(low)
    gram = wide.reshape(-1).view("<u8")
    del low, wide
    name = np.concatenate([np.frombuffer(x, np.uint64) for x in bucket["names"]])
    spot = np.concatenate([np.frombuffer(x, np.uint16) for x in bucket["spots"]])
    order = np.argsort(gram, kind="stable")
    start = np.flatnonzero(np.diff(gram[order], prepend=gram[order[0]] + np.uint64(1)))
    count = np.diff(start, append=len(order))
    flagged = np.maximum.reduceat(spot[order], start) >= _TWO
    order = order[np.repeat((count > 1) | flagged, count)]
    if not len(order):
        return pd.DataFrame({"block": pd.Series([], dtype="int64"), "found": pd.Series([], dtype=object), "links": pd.Series([], dtype=object)})
    order = order[np.lexsort((spot[order] & ~_TWO, name[order], gram[order]))]
    g, n, s = gram[order], name[order], spot[order]
    start = np.flatnonzero(np.diff(g, prepend=g[0] + np.uint64(1)))
    count = np.diff(start, append=len(g))
    two = (np.maximum.reduceat(n, start) != n[start]) | (np.maximum.reduceat(s, start) >= _TWO)
    group = np.repeat(mixed(mixed(n[start]) + (s[start] & ~_TWO).astype(np.uint64)), count)
    keep = np.repeat(two, count)
    order, g, n, group = order[keep], g[keep], n[keep], group[keep]
    row = np.searchsorted(np.cumsum(size), order, side="right")
    by = np.argsort(row, kind="stable")
    row = row[by]
    packed = np.stack([n[by], g[by], group[by]], 1)
    cuts = np.flatnonzero(np.diff(row, prepend=-1))
    found = [packed[i:j].tobytes() for i, j in zip(cuts, [*cuts[1:], len(row)])]
    return pd.DataFrame({"block": bucket["block"].to_numpy()[row[cuts]], "found": found, "links": [b""] * len(found)})


HELD = StructType([StructField("name", LongType()), StructField("grams", BinaryType())])


def by_text(reply: pd.DataFrame) -> pd.DataFrame:
    """A block's repeated grams by text: (gram, group) pairs, sorted, packed."""
    x = np.concatenate([np.frombuffer(b, np.uint64).reshape(-1, 3) for b in reply["found"]])
    if not len(x):
        return pd.DataFrame({"name": pd.Series([], dtype="int64"), "grams": pd.Series([], dtype=object)})
    links = np.concatenate([np.frombuffer(b, np.uint64).reshape(-1, 2) for b in reply["links"]])
    x = x[np.argsort(x[:, 1])]  # in a block each gram was told once
    at = np.minimum(np.searchsorted(x[:, 1], links[:, 0]), len(x) - 1)
    on = x[at, 1] == links[:, 0]
    x = np.concatenate([x, np.stack([links[on, 1], links[on, 0], x[at[on], 2]], 1)])
    x = x[np.lexsort((x[:, 1], x[:, 0]))]
    start = np.flatnonzero(np.diff(x[:, 0], prepend=x[0, 0] + np.uint64(1)))
    ends = [*start[1:], len(x)]
    return pd.DataFrame({"name": x[start, 0].view(np.int64), "grams": [packed_grams(x[i:j, 1:]) for i, j in zip(start, ends)]})


# ---------------------------------------------------------------------------
# Pieces
# ---------------------------------------------------------------------------
def cut(data: bytes, grams: bytes) -> list[tuple[int, int, int]]:
    """(group, first byte, end) of the stretches of candidate strings."""
    first, _, h = minimisers(np.frombuffer(data, np.uint8))
    known, groups = unpacked_grams(grams)
    h = h & _LOW48
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    on = known[at] == h
    ends = np.append(first[1:], len(data) - LENGTH + 1)
    group = groups[at]
    joins = np.zeros(len(on), bool)
    joins[1:] = on[1:] & on[:-1] & (group[1:] == group[:-1])
    start = np.flatnonzero(on & ~joins)
    stop = np.flatnonzero(on & ~np.append(joins[1:], False))
    return [(int(group[i].view(np.int64)), int(first[i]), int(ends[j]) + LENGTH - 1) for i, j in zip(start, stop)]


SENT = StructType([StructField("key", BinaryType()), StructField("id", LongType()), StructField("text", BinaryType())])


def sent_texts(docs: DataFrame) -> DataFrame:
    """(key, id, text) of texts that can hold a string, each compressed: they
    meet their grams in a shuffle, which holds every text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [squeezed(x.encode("utf-8")) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=SENT.names)

    return docs.where(F.octet_length("text") >= LENGTH).select("key", "id", "text").mapInArrow(run, SENT)


PIECES = StructType(
    [StructField("key", BinaryType()), StructField("id", LongType()), StructField("group", LongType()), StructField("at", LongType()), StructField("piece", BinaryType())]
)


def pieces(candidates: DataFrame) -> DataFrame:
    """Pieces of (key, id, compressed text, packed grams) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            rows: list[tuple] = []
            for key, ident, text, grams in zip(*(batch.column(k).to_pylist() for k in range(4))):
                data = unsqueezed(text)
                rows += [(key, ident, g, a, data[a:b]) for g, a, b in cut(data, grams)]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=PIECES.names)

    return candidates.select("key", "id", "text", "grams").mapInArrow(run, PIECES)


DISTINCT = StructType([StructField("group", LongType()), StructField("piece", BinaryType()), StructField("lo", LongType())])


def distinct_pieces(found: DataFrame) -> DataFrame:
    """(group, piece, lo) with the smallest id of each group's equal pieces;
    a group lies in one partition.  Equal pieces of a batch go as one, so
    those that many texts hold are few where they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = pa.Table.from_batches([batch]).group_by(["group", "piece"], use_threads=False).aggregate([("id", "min")])
            yield from least.select(["group", "piece", "id_min"]).rename_columns(DISTINCT.names).to_batches()

    sent = found.select("group", "piece", "id").mapInArrow(run, DISTINCT)
    return sent.repartition("group").groupBy("group", "piece").agg(F.min("lo").alias("lo"))


# ---------------------------------------------------------------------------
# Transforms
# ---------------------------------------------------------------------------
def transform(strings: list[bytes], depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order of a shard's strings by their first ``depth`` symbols at
    least, its transform (the symbol in front of each suffix) and its steps
    (where in the order the suffix stands that is longer by that symbol).
    Symbols are bytes plus one, which UTF-8 leaves room for; 0 ends a string."""
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8) + np.uint8(1)
    n = len(text)
    rank = np.zeros(n + 8, np.uint64)
    rank[:n] = text
    for k in (1, 2, 4):  # eight symbols at once
        rank = rank[:-k] << np.uint64(8 * k) | rank[k:]
    rank, width = rank[:n], 8
    while True:
        order = np.argsort(rank, kind="stable")
        at = np.empty(n, np.int64)
        if width >= depth:
            at[order] = np.arange(n)
            return order, text[order - 1], at[order - 1]
        new = np.cumsum(np.diff(rank[order], prepend=rank[order[0]]) != 0)
        at[order] = new
        ahead = np.zeros(n, np.int64)
        ahead[:-width] = at[width:] + 1
        rank = at * np.int64(n + 1) + ahead
        width *= 2


def merge(transforms: list[tuple[np.ndarray, np.ndarray, np.ndarray]], turns: int = LENGTH) -> tuple[np.ndarray, np.ndarray, dict[int, int]]:
    """Merge transforms by refining their interleave.

    Each turn reads the symbols in front of the suffixes in the order so far
    and deals the suffixes that are longer by them out again, stably: they
    then stand sorted by one symbol more.  Those with equal symbols in front
    of one interval are an interval again.  A suffix that is alone in its
    interval is settled and leaves: none that is longer by a symbol is shared
    either.

    Returns the suffixes (their places in the shards' orders, one shard after
    the other) that share ``turns`` symbols with others, in merged order, the
    interval of each, and how many suffixes were settled with how long a
    common prefix."""
    base = np.cumsum([0] + [len(t[0]) for t in transforms])
    front = np.concatenate([t[1] for t in transforms])
    step = np.concatenate([t[2] + b for t, b in zip(transforms, base)]).astype(np.int32)
    order = np.arange(len(front), dtype=np.int32)
    interval, settled = np.zeros(len(front), np.int32), {}
    for turn in range(1, turns + 1):
        symbol = front[order]
        deal = np.argsort(symbol, kind="stable")
        deal = deal[np.searchsorted(symbol[deal], 1) :]  # in front of a string is nothing
        symbol, old = symbol[deal], interval[deal]
        parted = np.empty(len(deal) + 1, bool)
        parted[:1] = parted[-1:] = True
        parted[1:-1] = (symbol[1:] != symbol[:-1]) | (old[1:] != old[:-1])
        shared = np.flatnonzero(~(parted[:-1] & parted[1:]))
        settled[turn - 1] = len(deal) - len(shared)
        order = step[order[deal[shared]]]
        interval = np.cumsum(parted[:-1], dtype=np.int32)[shared]
        if not len(order):
            break
    return order, interval, settled


def owned(strings: list[bytes], ids: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each string, the byte ranges covered by strings of ``LENGTH``
    bytes that also start in one with a smaller id."""
    shards, size = [[]], 0
    for k, x in enumerate(strings):
        if size > SHARD_BYTES:
            shards.append([])
            size = 0
        shards[-1].append(k)
        size += len(x)
    made = [transform([strings[k] for k in s]) for s in shards]
    order, interval, _ = merge(made)
    # which string, and where in it, each shared suffix starts
    base = np.cumsum([0] + [len(m[0]) for m in made])
    place = np.concatenate([m[0] + b for m, b in zip(made, base)])[order]
    lens = np.array([len(strings[k]) + 1 for s in shards for k in s])
    first = np.cumsum(lens) - lens
    string = np.searchsorted(first, place, side="right") - 1
    at = place - first[string]
    start = np.flatnonzero(np.diff(interval, prepend=-1))
    least = np.repeat(np.minimum.reduceat(ids[string], start), np.diff(start, append=len(string))) if len(start) else ids[:0]
    hit = least < ids[string]
    string, at = string[hit], at[hit]
    order = np.lexsort((at, string))
    string, at = string[order], at[order]
    out: list[list[tuple[int, int]]] = [[] for _ in strings]
    if len(at):
        new = np.append(True, (string[1:] != string[:-1]) | (at[1:] > at[:-1] + LENGTH))
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(at)) - 1
        for s, a, b in zip(string[begin].tolist(), at[begin].tolist(), at[last].tolist()):
            out[s].append((a, b + LENGTH))
    return out


OWNED = StructType([StructField("group", LongType()), StructField("pid", BinaryType()), StructField("lo", LongType()), StructField("ranges", BinaryType())])


def resolved(grouped: DataFrame) -> DataFrame:
    """(group, pid, lo, ranges) of distinct pieces (group, piece, lo) that
    lie sorted by group in their partitions."""

    def settle(rows: list[tuple[int, bytes, int]]) -> pa.RecordBatch:
        got = owned([r[1] for r in rows], np.array([r[2] for r in rows], np.int64))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()), pa.array([hashlib.md5(r[1]).digest() for r in rows], pa.binary()),
                pa.array([r[2] for r in rows], pa.int64()), pa.array([np.array(x, np.uint32).tobytes() for x in got], pa.binary()),
            ],
            names=OWNED.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, group = [], 0, None
        for batch in slices(batches, 2048):
            for g, piece, lo in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if rows and g != group and size > MERGE_BYTES:
                    yield settle(rows)
                    rows, size = [], 0
                rows.append((g, piece, lo))
                size += len(piece)
                group = g
        if rows:
            yield settle(rows)

    return grouped.select("group", "piece", "lo").mapInArrow(run, OWNED)


# ---------------------------------------------------------------------------
# Documents
# ---------------------------------------------------------------------------
SPANS = StructType([StructField("key", BinaryType()), StructField("spans", BinaryType())])


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def text_spans(hits: DataFrame) -> DataFrame:
    """Spans of each text from its pieces (sorted by key in their
    partitions): a piece that a smaller id has goes whole, one of the
    smallest id loses what other pieces own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, spans = None, []
        for batch in batches:
            done: list[tuple[bytes, bytes]] = []
            for k, ident, at, size, lo, ranges in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if k != key:
                    if spans:
                        done.append((key, np.array(_merged(spans), "<u4").tobytes()))
                    key, spans = k, []
                if ident > lo:
                    spans.append((at, at + size))
                else:
                    spans += [(at + a, at + b) for a, b in np.frombuffer(ranges, "<u4").reshape(-1, 2).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.binary()) for i in range(2)], names=SPANS.names)
        if spans:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([np.array(_merged(spans), "<u4").tobytes()], pa.binary())], names=SPANS.names)

    return hits.repartition("key").sortWithinPartitions("key").mapInArrow(run, SPANS)


def removals(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lo, spans) of the texts that lose bytes: those of ids over
    ``lo`` lose all, the first document loses the spans.  The key is the
    text's MD5."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    ident = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID))
    docs = df.select(ident.alias("id"), t.alias("text"), F.unhex(F.md5(t.cast("binary"))).alias("key"))
    texts = stored(docs.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.max(F.octet_length("text")).cast("long").alias("size")), "texts")
    total = texts.agg(F.sum("size")).first()[0] or 0
    bits = max(0, min(MAX_BUCKETS, -(-total // BUCKET_BYTES)) - 1).bit_length()
    sent = anchors(docs.where(F.octet_length("text") >= LENGTH).select("text"), bits)
    replies = sent.groupBy("bucket").applyInPandas(repeated, REPLY)  # and links, which only pass
    held = replies.groupBy("block").applyInPandas(by_text, HELD).groupBy("name").agg(F.first("grams").alias("grams"))
    name = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")  # as text_name has it
    wanted = stored(texts.withColumn("name", name).join(held, "name").select("key", "lo", "grams"), "candidates")
    chosen = sent_texts(docs).join(wanted, "key").where("id = lo")
    found = stored(pieces(chosen), "pieces")
    settled = resolved(distinct_pieces(found).sortWithinPartitions("group"))
    slim = found.select("key", "id", F.col("group").alias("g"), "at", F.length("piece").cast("long").alias("size"), F.unhex(F.md5("piece")).alias("p"))
    joined = slim.join(settled, (F.col("g") == F.col("group")) & (F.col("p") == F.col("pid")))
    hit = joined.where("id > lo OR length(ranges) > 0").select("key", "id", "at", "size", "lo", "ranges")
    lost = text_spans(hit)
    copied = texts.where(f"hi > lo AND size >= {LENGTH}").select("key", F.col("lo").alias("least"))
    ids = texts.select("key", "lo")
    return copied.join(lost, "key", "full").join(ids, "key").select("key", "lo", "spans")


def spanned(df: DataFrame, id_col: str = "doc_id", text: str = "text", column: str = "spans") -> DataFrame:
    """``df`` with the byte spans that each text loses (packed begin and end,
    unsigned 32-bit), null where it loses nothing."""
    lost = stored(removals(df, id_col, text), "removals")
    size = lost.agg(F.sum(F.coalesce(F.length("spans"), F.lit(0)) + 64)).first()[0] or 0
    key, low, own = (free_name(df.columns, n) for n in ("text_key", "least_id", "own_spans"))
    side = lost.select(F.col("key").alias(key), F.col("lo").alias(low), F.col("spans").alias(own))
    if size <= BROADCAST_BYTES:
        side = F.broadcast(side)  # its size was measured; larger ones are shuffled
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keyed = df.withColumn(key, F.unhex(F.md5(t.cast("binary"))))
    joined = keyed.join(side, key, "left")
    later = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)) > F.col(low)
    all_of_it = F.concat(F.unhex(F.lit("00000000")), F.unhex(_hex32(F.octet_length(t))))
    spans = F.when(later, all_of_it).when(F.col(low).isNotNull(), F.col(own))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], spans.alias(column))


def _hex32(n: Column) -> Column:
    """A number as eight hex digits, least byte first."""
    digits = F.lpad(F.hex(n.cast("long")), 8, "0")
    return F.concat(*[F.substring(digits, k, 2) for k in (7, 5, 3, 1)])


def kept_bytes(data: bytes, spans: bytes | None) -> tuple[bytes, list[tuple[int, int]]]:
    found = [tuple(x) for x in np.frombuffer(spans or b"", "<u4").reshape(-1, 2).tolist()]
    out, at = [], 0
    for a, b in found:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]]), found


def deduplicated(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` without the repeated bytes of its text.  A character that a cut
    leaves in part goes too; a null text stays null."""
    names = df.columns
    spans = free_name(names, "spans")
    marked = spanned(df, id_col, text, spans)
    source = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            new = [
                x if not s else kept_bytes(x.encode("utf-8"), s)[0].decode("utf-8", "ignore")
                for x, s in zip(batch.column(source).to_pylist(), batch.column(len(names)).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if k == source else batch.column(k) for k in range(len(names))], names=names)

    return marked.mapInArrow(run, df.schema)


DIGEST = StructType([StructField("doc_id", LongType())] + [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [StructField("kept_sha256", StringType())])


def digest(documents: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs, hash of the rest."""
    marked = spanned(documents.select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for x, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = (x or "").encode("utf-8")
                kept, spans = kept_bytes(data, s)
                rows.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], names=DIGEST.names)

    return marked.mapInArrow(run, DIGEST)

"""Offset-preserving SentencePiece encoding and decoding.

A text is normalised by the model's compiled character map: at every
position the longest prefix the map knows is replaced, and each byte of the
result records the source byte it comes from.  The normalised text is
segmented by the model's merges, and every piece is projected through that
record to its span of source bytes.

The normalised text is cut in front of every run of word marks and around
characters that no longer piece contains.  No merge crosses such a cut, so
each chunk is segmented once and its pieces are kept in a bounded table.

Defined cases: a null text is the empty text (begin and end ids only, empty
decoded text); any length of text is encoded whole; repeated rows give
repeated results; other columns pass through, those whose names clash with
the new columns give way.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from velolake.llm.common import extended, slices

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CHUNKS_KEPT = 200_000  # entries of each of the two tables of segmented chunks, per worker
SHORT = 48  # symbols up to which the plain merge loop is the faster one


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a little-endian length,
    a double-array trie of that many bytes, then zero-ended replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist() if size else []
        self.pool = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of ``data[at:]`` and what
        replaces it; None if the map knows no prefix."""
        units = self.units
        if not units:
            return None
        step = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
        node, best = step(units[0]), None
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= step(unit)
            if unit >> 8 & 1:
                best = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.pool[best[1] : self.pool.index(b"\0", best[1])]


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        m.ParseFromString(model)
        if m.trainer_spec.model_type != 2:
            raise ValueError("only models of merges (BPE) are encoded here")
        spec = m.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.suffix = m.trainer_spec.treat_whitespace_as_suffix
        self.fallback = m.trainer_spec.byte_fallback
        self.ids = {p.piece: i for i, p in enumerate(m.pieces) if p.type in (NORMAL, USER_DEFINED)}
        self.score = {p.piece: p.score for p in m.pieces if p.type in (NORMAL, USER_DEFINED)}
        self.user = sorted((p.piece for p in m.pieces if p.type == USER_DEFINED), key=len, reverse=True)
        self.unknown = next((i for i, p in enumerate(m.pieces) if p.type == UNKNOWN), 0)
        self.bytes = [0] * 256
        self.surface: list[bytes] = []
        self.byte_of: dict[int, int] = {}
        for i, p in enumerate(m.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
                self.byte_of[i] = int(p.piece[1:-1], 16)
                self.surface.append(bytes([int(p.piece[1:-1], 16)]))
            elif p.type == CONTROL:
                self.surface.append(b"")
            elif p.type == UNKNOWN:
                self.surface.append(m.trainer_spec.unk_surface.encode())
            else:
                self.surface.append(p.piece.replace(MARK, " ").encode())
        self.marked = {i for p, i in self.ids.items() if p.startswith(MARK)}
        by_piece = {p.piece: i for i, p in enumerate(m.pieces) if p.type == CONTROL}
        self.controls = sorted(by_piece.values())
        self.begin, self.end = by_piece[m.trainer_spec.bos_piece], by_piece[m.trainer_spec.eos_piece]
        longer = [p for p in self.ids if len(p) > 1]
        joined = any(MARK in p.lstrip(MARK) for p in longer) or self.suffix or self.user
        apart = "".join(c for c in "\n\r\t" if not any(c in p for p in longer))
        self.cut = None if joined else re.compile(f"{MARK}*[^{MARK}{apart}]+|{MARK}+" + (f"|[{apart}]+" if apart else ""))
        self.spaces = self.plain()
        self.spelling = [p.piece if p.type in (NORMAL, USER_DEFINED) else "" for p in m.pieces]
        self.size = [self.width(p) for p in self.spelling]
        rank = {x: k for k, x in enumerate(sorted({-p.score for p in m.pieces}))}
        self.order: dict[tuple[int, int], int] = {}  # a pair of ids: the rank of its merge
        self.made: dict[tuple[int, int], int] = {}  # a pair of ids: the id it merges to
        for i, p in enumerate(m.pieces):
            for k in range(1, len(p.piece)) if p.type == NORMAL else ():
                a, b = self.ids.get(p.piece[:k]), self.ids.get(p.piece[k:])
                if a is not None and b is not None:
                    self.order[a, b], self.made[a, b] = rank[-p.score], i
        self.of_rank = [-1] * len(rank)  # the id that a merge of this rank makes, -1 where it can be several
        makes = {(k, self.made[x]) for x, k in self.order.items()}
        several = Counter(k for k, _ in makes)
        for k, i in makes:
            if several[k] == 1:
                self.of_rank[k] = i
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}

    # -- normalising ------------------------------------------------------
    def plain(self) -> bool:
        """Whether the map replaces nothing, so only spaces change."""
        return not (self.map.units or self.squeeze or self.suffix or self.user) and self.dummy and self.escape

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text and, for each of its bytes and its end, the
        source byte it comes from."""
        data, at, out, origin = text.encode("utf-8"), 0, bytearray(), []
        space = MARK.encode() if self.escape else b" "

        def prefix(i: int) -> tuple[int, bytes]:
            for u in self.user:
                if data.startswith(u.encode(), i):
                    return len(u.encode()), u.encode()
            found = self.map.longest(data, i)
            if found:
                return found
            n = 1 if data[i] < 0x80 else 2 if data[i] < 0xE0 else 3 if data[i] < 0xF0 else 4
            return n, data[i : i + n]

        def put(piece: bytes, source: int) -> None:
            out.extend(piece)
            origin.extend([source] * len(piece))

        if self.squeeze:
            while at < len(data) and (p := prefix(at))[1] == b" ":
                at += p[0]
        if at >= len(data):
            return "", np.array([at], np.int64)
        if self.dummy and not self.suffix:
            put(space, at)
        after_space = self.squeeze
        while at < len(data):
            n, piece = prefix(at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                for j in range(len(piece)):
                    put(space if piece[j] == 0x20 else piece[j : j + 1], at)
                after_space = piece.endswith(b" ")
            at += n
            after_space = after_space and self.squeeze
        if self.squeeze:
            while out.endswith(space):
                at = origin[len(out) - len(space)]
                del out[-len(space) :], origin[-len(space) :]
        if self.dummy and self.suffix:
            put(space, at)
        return out.decode("utf-8", "replace"), np.array([*origin, at], np.int64)

    # -- segmenting -------------------------------------------------------
    def merged(self, symbols: list[str]) -> list[str]:
        """Merge the best-scored neighbours, leftmost first among equals."""
        score = self.score
        n = len(symbols)
        left, right, live = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        agenda = [(-s, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (s := score.get(a + b)) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = right[i]
            if not live[i] or j < 0 or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], live[j], right[i] = a + b, False, right[j]
            if right[i] >= 0:
                left[right[i]] = i
            for x in (left[i], i):
                if x >= 0 and right[x] >= 0 and (s := score.get(symbols[x] + symbols[right[x]])) is not None:
                    heapq.heappush(agenda, (-s, x, symbols[x], symbols[right[x]]))
        return [s for s, ok in zip(symbols, live) if ok]

    def _short(self, chunk: str) -> list[int]:
        """``merged`` for a few symbols that are all pieces, on their ids."""
        order, none = self.order.get, math.inf
        of_rank, ids = self.of_rank, list(map(self.ids.__getitem__, chunk))
        pairs = list(map(order, zip(ids, ids[1:]), repeat(none)))
        while pairs and (best := min(pairs)) != none:
            at = pairs.index(best)
            new = of_rank[best]
            if new < 0:
                new = self.made[ids[at], ids[at + 1]]
            ids[at] = new
            del ids[at + 1], pairs[at]
            if at:
                pairs[at - 1] = order((ids[at - 1], new), none)
            if at < len(pairs):
                pairs[at] = order((new, ids[at + 1]), none)
        return ids

    def segment(self, chunk: str) -> tuple[bytes, bytes]:
        """Packed ids of a normalised chunk, and the bytes that each spans.
        An id of a byte that no piece spells spans none but the last of its
        character, which spans the whole character."""
        got = self.old.get(chunk)  # ``encode`` has looked among the young ones
        if got is None:
            try:
                if len(chunk) > SHORT or self.user:
                    raise KeyError
                ids = self._short(chunk)
                sizes = [self.size[i] for i in ids]
            except KeyError:
                symbols = list(chunk)
                if self.user:
                    symbols = [s for s in re.split("(" + "|".join(map(re.escape, self.user)) + "|.)", chunk, flags=re.S) if s]
                ids, sizes = self._spelt(self.merged(symbols))
            got = array("I", ids).tobytes(), array("I", sizes).tobytes()
        if len(chunk) <= SHORT:
            if len(self.young) >= CHUNKS_KEPT:  # those in use move on
                self.young, self.old = {}, self.young
            self.young[chunk] = got
        return got

    def _spelt(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        ids, sizes = [], []
        for s in pieces:
            i = self.ids.get(s)
            if i is not None:
                ids.append(i)
                sizes.append(self.width(s))
            elif self.fallback:
                raw = s.encode("utf-8")
                ids += [self.bytes[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [self.width(s)]
            elif ids and ids[-1] == self.unknown:
                sizes[-1] += self.width(s)
            else:
                ids.append(self.unknown)
                sizes.append(self.width(s))
        return ids, sizes

    def width(self, piece: str) -> int:
        """Bytes of a normalised piece.  Where only spaces change, bytes of
        its source (a mark is one space; marks of the source itself are
        rare, and texts with them go the general way)."""
        if piece.isascii():
            return len(piece)
        n = len(piece.encode("utf-8"))
        return n - 2 * piece.count(MARK) if self.spaces else n

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """All ids (begin, pieces, end) and their spans of source bytes."""
        if not text:
            norm, origin = "", np.zeros(1, np.int64)
        elif self.spaces and MARK not in text:
            norm, origin = MARK + text.replace(" ", MARK), None
        else:
            norm, origin = self.normalise(text)
        known = self.young.get
        chunks = [norm] if self.cut is None else self.cut.findall(norm)
        got = [known(c) or self.segment(c) for c in chunks if c]
        packed = b"".join([g[0] for g in got])
        n = len(packed) // 4
        ids = np.empty(n + 2, "<u4")
        ids[0], ids[-1] = self.begin, self.end
        ids[1:-1] = np.frombuffer(packed, "<u4")
        ends = np.cumsum(np.frombuffer(b"".join([g[1] for g in got]), "<u4"), dtype=np.uint32)
        spans = np.zeros((n + 2, 2), "<u4")
        if origin is None:  # the added mark has no source byte
            spans[1:-1, 1] = ends - 1
            spans[2:-1, 0] = ends[:-1] - 1
            spans[-1] = ends[-1] - 1
        else:
            if self.spaces:
                ends = ends + 2 * np.cumsum([x.count(MARK) for x in self._pieces(got)], dtype=np.uint32)
            spans[1:-1, 1] = origin[ends]
            spans[1:2, 0], spans[2:-1, 0] = origin[0], origin[ends[:-1]]
            spans[-1] = origin[-1]
        return ids, spans

    def _pieces(self, got: list[tuple[bytes, bytes]]) -> list[str]:
        """Normalised text of each id; a byte id has its whole character at
        its last byte, none of which is a mark."""
        return [self.spelling[i] for g in got for i in np.frombuffer(g[0], "<u4").tolist()]

    # -- decoding ---------------------------------------------------------
    def decode(self, ids: np.ndarray) -> str:
        """Text of ``ids``: controls vanish, runs of byte ids are characters
        (a byte that belongs to none is U+FFFD), the mark in front of the
        first piece is dropped."""
        surface = self.surface
        raw = b"".join([surface[i] for i in ids.tolist()])
        try:
            text = raw.decode("utf-8")
            whole = not any((ids[1:-1] == i).any() for i in self.controls)
        except UnicodeDecodeError:
            whole = False
        if not whole:
            text = "".join(self._runs(ids.tolist()))
        first = next((i for i in ids.tolist() if surface[i]), None)
        return text[1:] if first in self.marked and (self.dummy or self.squeeze) else text

    def _runs(self, ids: list[int]) -> Iterator[str]:
        run = bytearray()
        for i in [*ids, -1]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            while run:
                n = next((n for n in range(1, 5) if _valid(bytes(run[:n]))), 0)
                yield bytes(run[:n]).decode() if n else "�"
                del run[: n or 1]
            if i >= 0:
                yield self.surface[i].decode()


def _valid(piece: bytes) -> bool:
    try:
        return len(piece.decode("utf-8")) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    with open(path, "rb") as f:
        return Codec(f.read())


ENCODED = StructType([StructField("n_tokens", IntegerType()), StructField("ids", BinaryType()), StructField("spans", BinaryType())])


def encode(df: DataFrame, model: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``df`` with ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and
    ``spans`` (begin and end source byte of each id, packed alike).

    ``model`` is the place of a model file that every executor has.  With
    ``decoded`` the ids are decoded again in the same pass, as ``decoded``."""
    schema = StructType(ENCODED.fields + [StructField("decoded", StringType())] * decoded)
    kept, schema = extended(df, schema)
    source, places = df.columns.index(text), [df.columns.index(k) for k in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in slices(batches):
            n, ids, spans, back = [], [], [], []
            for x in batch.column(source).to_pylist():
                i, s = c.encode(x or "")
                n.append(len(i))
                ids.append(i.tobytes())
                spans.append(s.tobytes())
                if decoded:
                    back.append(c.decode(i))
            columns = [batch.column(p) for p in places]
            new = [pa.array(n, pa.int32()), pa.array(ids, pa.binary()), pa.array(spans, pa.binary())] + [pa.array(back, pa.string())] * decoded
            yield pa.RecordBatch.from_arrays(columns + new, names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the text of the packed ``ids`` (null: empty)."""
    kept, schema = extended(df, StructType([StructField("decoded", StringType())]))
    source, places = df.columns.index(ids), [df.columns.index(k) for k in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in slices(batches):
            back = [c.decode(np.frombuffer(x or b"", "<u4")) for x in batch.column(source).to_pylist()]
            columns = [batch.column(p) for p in places]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(back, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def digest(documents: DataFrame, model: str) -> DataFrame:
    """Per document: token count, hashes of ids and decoded text, and the
    source bytes that the spans cover."""
    done = encode(documents.select("doc_id", "text"), model, decoded=True)
    return done.select(
        "doc_id",
        F.col("n_tokens").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.sha2("spans", 256).alias("spans_sha256"),
    )

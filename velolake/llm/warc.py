"""Web archives (WARC): written by Spark, read back, segments put together.

Writing.  A page becomes a record whose block is an HTTP response with its
body in chunks.  Of pages with equal payloads one is a response, the others
are revisit records without payload that refer to it.  A block over
``SEGMENT`` bytes is cut into segments: the first keeps the record's type, the
others are continuation records with the origin's identifier, a number and, on
the last one, the total length.  Records fill archives of ``ARCHIVE`` bytes,
which Spark's text sink writes (a row a file) to any store it can reach.

Reading.  Each archive is read record by record.  Continuations and the
records that they continue are brought together by the origin's identifier
and lie sorted by segment number, so a task holds one record at a time.
Numbers must run from 1 without a gap and the lengths must add up to the
total.  Then the chunks' framing is taken off and the payload's digest
compared.  A record that fails a check stays, with ``problem`` naming it and a
null payload.

Which page of equal ones is the response, and what a revisit refers to, are
joins by digest and by identifier.  A key that holds over a ten-thousandth of
the rows is joined by broadcast (so there are at most ten thousand of them),
the others by shuffle.

Defined cases: a null html is an empty payload; empty payloads are equal to
each other; of repeated rows that share the largest id any one is the
response; a null id is smaller than all others and has no field, a null url
none either; line breaks in urls are percent-encoded; columns other than id,
url and html are not written; an empty table writes no record and reads as
none; payloads of any length are cut, never dropped.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from velolake.llm.common import slices, stored, workspace

SEGMENT = 1 << 15  # bytes of a record's block
CHUNK = 1 << 13  # bytes of a chunk of an HTTP body
ARCHIVE = 1 << 22  # bytes of an archive, before compression
LEAST = 0  # payloads from this many bytes on can be revisits
DATE = "2024-01-01T00:00:00Z"  # no page has a date of its own
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HOT_SHARE = 10_000
HOT_ROWS = 1_000

_END = b"\r\n\r\n"


# ---------------------------------------------------------------------------
# Framing
# ---------------------------------------------------------------------------
def sha1_name(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(row: int, page: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{row}:{page}'.encode()).digest())}>"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """A payload in HTTP's chunked framing."""
    parts = [payload[k : k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are passed over.
    ValueError if the framing does not hold."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        digits = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not digits or digits.strip(b"0123456789abcdefABCDEF"):
            raise ValueError("chunk size")
        size, at = int(digits, 16), end + 2
        if not size:
            break
        out.append(body[at : at + size])
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk length")
        at += size + 2
    while (end := body.find(b"\r\n", at)) > at:  # trailers
        at = end + 2
    if end != at or end + 2 != len(body):
        raise ValueError("end of chunks")
    return b"".join(out)


def http_payload(block: bytes) -> bytes:
    head, mark, body = block.partition(_END)
    if not head.startswith(b"HTTP/") or not mark:
        raise ValueError("HTTP head")
    fields = [line.partition(b":") for line in head.split(b"\r\n")[1:]]
    coding = [v.strip().lower() for k, _, v in fields if k.strip().lower() == b"transfer-encoding"]
    return unchunked(body) if coding and coding[-1].endswith(b"chunked") else body


def fields_of(pairs: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1"] + [f"{k}: {v}" for k, v in pairs if v is not None] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8") + _END


def written(row: int, page: int | None, url: str | None, payload: bytes, digest: str, target: str | None, segment: int = SEGMENT) -> Iterator[bytes]:
    """The records of a page, each without the line breaks that end it."""
    name = record_name(row, page)
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nTransfer-Encoding: chunked" + _END
    block = head if target else head + chunked(payload)
    uri = None if url is None else url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    pairs: list[tuple[str, object]] = [
        ("WARC-Type", "revisit" if target else "response"), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("X-Page-ID", page),
        ("WARC-Payload-Digest", "sha1:" + digest), ("WARC-Refers-To", target), ("WARC-Profile", PROFILE if target else None),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    parts = [block[k : k + segment] for k in range(0, len(block), segment)]
    if len(parts) == 1:
        yield fields_of(pairs, block) + block
        return
    for k, part in enumerate(parts, 1):
        if k > 1:
            own = f"<urn:uuid:{uuid.uuid5(uuid.UUID(name[10:-1]), str(k))}>"
            pairs = [("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Segment-Origin-ID", name)]
        total = len(block) if k == len(parts) else None
        yield fields_of([*pairs, ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total)], part) + part


def archive_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Fields (names in lower case) and block of an archive's records, plain
    or gzipped.  What can't be read ends the archive with a null block."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    with io.BufferedReader(stream) as source:
        try:
            while line := source.readline():
                if not line.strip():
                    continue  # ends the record before
                if not line.startswith(b"WARC/"):
                    raise ValueError("no record")
                fields: dict[str, str] = {}
                while (line := source.readline()).strip():
                    key, _, value = line.decode("utf-8", "replace").partition(":")
                    fields[key.strip().lower()] = value.strip()
                length = int(fields["content-length"])
                block = source.read(length)
                if len(block) < length:
                    raise ValueError("cut off")
                yield fields, block
        except (ValueError, KeyError, EOFError, OSError):
            yield {}, None


# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------
def joined_one(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``left`` with ``columns`` of the one row that ``right`` has for its
    ``key``, or nulls; keys that hold much of ``left`` are not shuffled."""
    counts = stored(left.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(f"n > {HOT_ROWS}"), "counts")
    rows = left.count()
    hot_keys = counts.where((F.col("n") > rows // HOT_SHARE) & F.col(key).isNotNull()).select(key)  # at most HOT_SHARE rows
    pick = F.struct(*columns)
    hot = right.join(F.broadcast(hot_keys), key).select(key, pick.alias("_hot"))
    one = left.join(F.broadcast(hot), key, "left")
    # rows that are served, or have no key, go anywhere
    cold = F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key)).otherwise(F.concat(F.lit("-"), F.pmod(F.monotonically_increasing_id(), F.lit(4096))))
    two = one.withColumn("_cold", cold).join(right.select(F.col(key).alias("_cold"), pick.alias("_rest")), "_cold", "left")
    found = [F.coalesce(F.col(f"_hot.{c}"), F.col(f"_rest.{c}")).alias(c) for c in columns]
    return two.select(*left.columns, *found)


# ---------------------------------------------------------------------------
# Writing
# ---------------------------------------------------------------------------
def write_pages(
    pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST, segment: int = SEGMENT, archive: int = ARCHIVE
) -> str:
    """Write ``pages`` as archives into ``folder``."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    slim = pages.select(F.col(f"`{id_col}`").cast("long").alias("page"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("html"))
    numbered = slim.withColumn("row", F.monotonically_increasing_id()).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    rows = stored(numbered, "pages")  # the numbers must stay
    chosen = F.max(F.struct("page", "row")).alias("w")
    able = rows.where(F.octet_length("html") >= least)
    shared = able.groupBy("sha1").agg(chosen, F.count(F.lit(1)).alias("n")).where("n > 1")
    targets = stored(shared.select("sha1", F.col("w.page").alias("to_page"), F.col("w.row").alias("to_row")), "responses")
    planned = joined_one(rows, targets, "sha1", ["to_page", "to_row"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, 64):
            for page, address, text, row, to_page, to_row in zip(*(batch.column(k).to_pylist() for k in range(6))):
                data = text.encode("utf-8")
                target = None if to_row is None or to_row == row else record_name(to_row, to_page)
                for record in written(row, page, address, data, sha1_name(data), target, segment):
                    if held and size + len(record) > archive:
                        yield pa.RecordBatch.from_arrays([pa.array([_END.join(held)], pa.binary())], names=["archive"])
                        held, size = [], 0
                    held.append(record)
                    size += len(record)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([_END.join(held)], pa.binary())], names=["archive"])

    archives = planned.select("page", "url", "html", "row", "to_page", "to_row").mapInArrow(run, "archive binary")
    # the sink ends each row as a record ends
    sink = archives.select(F.col("archive").cast("string")).write.option("lineSep", _END.decode()).option("maxRecordsPerFile", 1)
    sink.option("compression", "gzip").text(folder)
    return folder


# ---------------------------------------------------------------------------
# Reading
# ---------------------------------------------------------------------------
PARTS = StructType(
    [StructField("origin", StringType()), StructField("segment", IntegerType()), StructField("total", LongType()), StructField("kind", StringType())]
    + [StructField("page_id", LongType()), StructField("url", StringType()), StructField("digest", StringType()), StructField("refers_to", StringType())]
    + [StructField("block", BinaryType()), StructField("problem", StringType())]
)
RECORDS = StructType(
    [StructField("record_id", StringType()), StructField("kind", StringType()), StructField("page_id", LongType()), StructField("url", StringType())]
    + [StructField("digest", StringType()), StructField("refers_to", StringType()), StructField("payload", BinaryType()), StructField("problem", StringType())]
)


def _whole(x: str | None) -> int | None:
    try:
        return int(x)
    except (TypeError, ValueError):
        return None


def _part(fields: dict[str, str], block: bytes | None) -> tuple:
    kind = fields.get("warc-type")
    origin = fields.get("warc-segment-origin-id") if kind == "continuation" else fields.get("warc-record-id")
    url = fields.get("warc-target-uri")
    url = None if url is None else url.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
    digest = fields.get("warc-payload-digest", "")
    digest = digest[5:] if digest.lower().startswith("sha1:") else None
    numbers = [_whole(fields.get(n)) for n in ("warc-segment-number", "warc-segment-total-length", "x-page-id")]
    problem = "unreadable" if block is None else None if origin else "no identifier"
    return (origin, numbers[0], numbers[1], kind, numbers[2], url, digest, fields.get("warc-refers-to"), block, problem)


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """The archives' response, revisit and continuation records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows, size = [], 0
            for fields, block in archive_records(batch.column(0)[0].as_py()):
                if block is not None and fields.get("warc-type") not in ("response", "revisit", "continuation"):
                    continue
                rows.append(_part(fields, block))
                size += len(block or b"")
                if size > ARCHIVE:
                    yield _batch(rows, PARTS)
                    rows, size = [], 0
            yield _batch(rows, PARTS)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, PARTS)


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, schema)], names=schema.names)


def decoded(origin: str | None, kind: str | None, page: int | None, url: str | None, digest: str | None, refers: str | None, block: bytes | None, problem: str | None) -> tuple:
    """A record's row: the payload with its framing taken off."""
    payload = None
    if problem is None and kind != "revisit":
        try:
            payload = http_payload(block)
        except ValueError as error:
            problem = str(error)
        else:
            if digest is not None and sha1_name(payload) != digest:
                payload, problem = None, "digest"
    return (origin, kind, page, url, digest, refers, payload, problem)


def reassembled(segments: list[tuple]) -> tuple:
    """The record of one origin's segments, sorted by number."""
    first = segments[0]
    _, _, _, kind, page, url, digest, refers, _, problem = first
    if kind == "continuation" or first[1] != 1:
        kind, problem = None, "first segment missing"
    elif [s[1] for s in segments] != list(range(1, len(segments) + 1)):
        problem = "segment missing or repeated"
    block = b"".join(s[8] or b"" for s in segments)
    if problem is None and segments[-1][2] is None:
        problem = "last segment missing"
    if problem is None and segments[-1][2] != len(block):
        problem = "total length"
    return decoded(first[0], kind, page, url, digest, refers, block, problem)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the archives in ``folder``: ``record_id, kind, page_id, url,
    digest`` (as its field says), ``refers_to`` (an identifier), ``payload``
    (null for revisits) and ``problem``."""
    found = parts(spark, folder)

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            rows = [decoded(r["origin"], *(r[c] for c in ("kind", "page_id", "url", "digest", "refers_to", "block", "problem"))) for r in batch.to_pylist()]
            yield _batch(rows, RECORDS)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches, 16):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield _batch([reassembled(held)], RECORDS)
                    held = []
                held.append(row)
        if held:
            yield _batch([reassembled(held)], RECORDS)

    cut = F.col("origin").isNotNull() & (F.col("segment").isNotNull() | F.col("kind").eqNullSafe("continuation"))
    whole = found.where(~cut).mapInArrow(single, RECORDS)
    segments = found.where(cut).repartition("origin").sortWithinPartitions("origin", "segment")
    return whole.unionByName(segments.mapInArrow(join, RECORDS))


def resolved(records: DataFrame) -> DataFrame:
    """Per page record: ``page_id, payload_bytes, payload_digest`` (of the full
    payload, for a revisit that of the response it refers to), ``record_type``,
    ``refers_to`` (the response's page) and ``problem``."""
    measured = records.select(
        "record_id", "kind", "page_id", "refers_to", "problem", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1")
    )
    slim = stored(measured, "records")
    response = slim.where("kind = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("to_page"), F.col("size").alias("to_size"), F.col("sha1").alias("to_sha1"))
    revisit = F.col("kind") == "revisit"
    later = joined_one(slim.where(revisit), response, "refers_to", ["to_page", "to_size", "to_sha1"])
    lost = F.coalesce(F.col("problem"), F.when(F.col("to_sha1").isNull(), F.lit("response missing")))
    again = later.select("page_id", F.col("to_size").alias("payload_bytes"), _base32(F.col("to_sha1")).alias("payload_digest"), F.col("kind").alias("record_type"), F.col("to_page").alias("refers_to"), lost.alias("problem"))
    first = slim.where(~F.coalesce(revisit, F.lit(False))).select(
        "page_id", F.col("size").alias("payload_bytes"), _base32(F.col("sha1")).alias("payload_digest"), F.col("kind").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "problem"
    )
    return first.unionByName(again)


def _base32(sha1: Column) -> Column:
    """A SHA-1 in hex digits as base 32: five of the former are four of the latter."""
    groups = F.sequence(F.lit(0), F.lit(31))
    value = lambda k: F.conv(F.substring(sha1, (F.floor(k / 4) * 5 + 1).cast("int"), F.lit(5)), 16, 10).cast("int")
    digit = lambda k: F.floor(value(k) / F.pow(F.lit(32), 3 - k % 4)).cast("int") % 32
    letters = F.transform(groups, lambda k: F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), digit(k) + 1, F.lit(1)))
    return F.when(sha1.isNotNull(), F.array_join(letters, ""))


def digest(pages: DataFrame) -> DataFrame:
    """Per page, after a write and a read: the payload's length and digest,
    the record's type and the page it refers to."""
    folder = write_pages(pages, workspace(pages.sparkSession, "archives"))
    return resolved(read_records(pages.sparkSession, folder))


def oracle() -> str:
    """The digest in SQL, from the pages alone."""
    digit = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, k // 4 * 5 + 1, 5))::INT >> (15 - 5 * (k % 4))) & 31) + 1, 1)"
    return f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes, array_to_string([{digit} FOR k IN range(0, 32)], '') AS payload_digest,
       CASE WHEN payload_bytes >= {LEAST} AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST} AND page_id <> top THEN top END AS refers_to, NULL::VARCHAR AS problem
FROM m"""

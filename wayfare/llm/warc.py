"""WARC archives: written with segmented, chunked HTTP records, and read back by reassembling the segments.

Writing: a response record holds an HTTP message whose body is framed in chunks; a record longer than
``segment_bytes`` is continued in further records. A page whose payload another page has too is a revisit of that page
and has no payload of its own. Records end in two line ends, so Spark's text writer, given that as its line separator
and a codec, makes the archives.

Reading: records are cut out of each archive by their lengths; continuations are grouped by the identifier of their
first record, ordered by segment number and verified against the total length; then the chunks are decoded.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.common import repeated_rows, save, small_batches, text_slices

END = b"\r\n\r\n"
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
ARCHIVE_BYTES = 128 << 20  # of records, before compression
HEAD_ROOM = 2048  # bytes of headers, taken into account for the size of an archive
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailing fields are skipped."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            return b"".join(parts)
        parts.append(body[at : at + size])
        at += size
        if len(parts[-1]) != size or body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk is shorter than its size")
        at += 2


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def _one_line(value: str) -> str:
    """A header value on one line: control characters and the escape itself are percent-escaped."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "%\x7f" else c for c in value)


def _from_line(value: str) -> str:
    parts = value.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def _record_id(page: int | None, url: str | None, key: bytes, copy: int = 0) -> str:
    return f"<{uuid.UUID(bytes=hashlib.md5(repr((page, url, copy)).encode() + key).digest()).urn}>"


def _write_step(segment_bytes: int, chunk_bytes: int, date: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "html", 8 << 20):
                records: list[bytes] = []
                for row in batch.to_pylist():
                    payload = (row["html"] or "").encode()
                    name = _record_id(row["page_id"], row["url"], row["key"], row["copy"])
                    fields = [("WARC-Record-ID", name), ("WARC-Date", date)]
                    if row["url"] is not None:
                        fields.append(("WARC-Target-URI", _one_line(row["url"])))
                    if row["page_id"] is not None:
                        fields.append(("Page-ID", str(row["page_id"])))
                    fields.append(("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"))
                    fields.append(("Content-Type", "application/http;msgtype=response"))
                    if not row["response"]:
                        target = _record_id(row["best_id"], row["best_url"], row["key"])
                        more = [("WARC-Type", "revisit"), ("WARC-Profile", PROFILE), ("WARC-Refers-To", target)]
                        records.append(_record(more + fields, HTTP_HEAD))
                        continue
                    block = HTTP_HEAD + chunked(payload, chunk_bytes)
                    pieces = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
                    first = [("WARC-Type", "response"), *fields]
                    if len(pieces) > 1:
                        first.append(("WARC-Segment-Number", "1"))
                    records.append(_record(first, pieces[0]))
                    for number, piece in enumerate(pieces[1:], 2):
                        own = f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{number}').urn}>"
                        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Date", date)]
                        more += [("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(number))]
                        if number == len(pieces):
                            more.append(("WARC-Segment-Total-Length", str(len(block))))
                        records.append(_record(more, piece))
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    return step


def write_archives(
    pages: DataFrame,
    folder: str,
    minimum_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write ``page_id, url, html`` as gzip-compressed archives into a new folder that all executors share.

    The payload is the html in UTF-8, empty for NULL. Of pages with equal payloads of ``minimum_bytes`` or more, that
    with the largest page_id is the response and the others revisit it (NULL page_ids lose; among equal ones the url
    decides); rows that agree in all three columns are each written as the response is, under record identifiers of their
    own, the first of which the others revisit. Other columns are not read. An empty table writes no record.
    """
    small_batches(pages.sparkSession)
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("bigint"), "url", "html").withColumn("key", F.unhex(F.sha2(payload, 256)))
    page = ["key", "page_id", "url"]
    counted = save(rows.groupBy(*page).agg(F.count(F.lit(1)).alias("rows")), "payloads")
    best = F.max(F.struct(F.col("page_id").isNotNull(), "page_id", F.col("url").isNotNull(), "url")).alias("best")
    best = counted.groupBy("key").agg(best).select("key", F.col("best.page_id").alias("best_id"), F.col("best.url").alias("best_url"))
    # written, so that both sides of the join are plain shuffles, which AQE splits at a payload that many pages share
    wanted = save(counted.join(save(best, "responses"), "key"), "decided")
    same = (rows.key == wanted.key) & rows.page_id.eqNullSafe(wanted.page_id) & rows.url.eqNullSafe(wanted.url)
    joined = rows.join(wanted.hint("shuffle_hash"), same)  # pages are dealt out once, and not sorted
    joined = joined.select(*[rows[c] for c in rows.columns], "rows", "best_id", "best_url")
    single = joined.filter("rows = 1").withColumn("copy", F.lit(0).cast("bigint"))
    most = wanted.agg(F.max("rows")).first()[0] or 0
    if most > 1:
        single = single.unionByName(repeated_rows(joined.filter("rows > 1").dropDuplicates(page), "rows", "copy", most))
    response = F.col("page_id").eqNullSafe(F.col("best_id")) & F.col("url").eqNullSafe(F.col("best_url"))
    large = F.octet_length(F.coalesce("html", F.lit(""))) >= minimum_bytes
    joined = single.withColumn("response", response | ~large)
    records = joined.mapInArrow(_write_step(segment_bytes, chunk_bytes, date), "record binary")
    (
        records.select(F.col("record").cast("string"))
        .write.option("lineSep", END.decode())
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", max(1, archive_bytes // (segment_bytes + HEAD_ROOM)))
        .text(folder)
    )


SEGMENTS = (
    "record_id string, record_type string, page_id bigint, url string, digest string, refers_to string, "
    "origin string, segment int, total bigint, block binary"
)
DECODED = (
    "record_id string, record_type string, page_id bigint, url string, digest string, refers_to string, "
    "payload binary, problem string"
)
HEAD = ("record_id", "record_type", "page_id", "url", "digest", "refers_to")
_HEAD_TYPES = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
BATCH_BYTES = 8 << 20


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of an archive."""
    at = 0
    while at < len(data):
        if data[at : at + 5] != b"WARC/":
            raise ValueError(f"no record begins at byte {at}")
        head = data.index(END, at)
        lines = data[at:head].decode().split("\r\n")[1:]
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        start, size = head + 4, int(fields["content-length"])
        if len(data) < start + size:
            raise ValueError(f"the record at byte {at} is cut off")
        yield fields, data[start : start + size]
        at = start + size + 4


def _inflate(data: bytes) -> bytes:
    """The content of one or more gzip members, or the data itself if it isn't compressed."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts = []
    while data:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(data))
        data = member.unused_data
    return b"".join(parts)


def _head(get) -> tuple:
    """The values of ``HEAD`` from a record's header fields."""
    page, url = get("page-id"), get("warc-target-uri")
    digest = (get("warc-payload-digest") or "").removeprefix("sha1:") or None
    named = None if page is None else int(page), None if url is None else _from_line(url)
    return get("warc-record-id"), get("warc-type"), *named, digest, get("warc-refers-to")


def _packed(rows: list[tuple], names: tuple[str, ...], types: tuple[pa.DataType, ...]) -> pa.RecordBatch:
    cells = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    return pa.RecordBatch.from_arrays(cells, list(names))


def _rows_of_archives(batches: Iterator[pa.RecordBatch], row_of, names: tuple[str, ...], types: tuple[pa.DataType, ...]) -> Iterator[pa.RecordBatch]:
    """Batches of what ``row_of`` makes of each record; it returns None for records that are not its own."""
    for batch in batches:
        for content in batch.column("content"):
            rows, held = [], 0
            for fields, block in parse_records(_inflate(content.as_py())):
                row = row_of(fields.get, block)
                if row is None:
                    continue
                rows.append(row)
                held += len(block)
                if held >= BATCH_BYTES:
                    yield _packed(rows, names, types)
                    rows, held = [], 0
            if rows:
                yield _packed(rows, names, types)


def _whole_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of one piece, decoded on the spot."""

    def row_of(get, block: bytes) -> tuple | None:
        if get("warc-segment-number"):
            return None
        head = _head(get)
        return *head, *_payload(head[1], head[4], block)

    return _rows_of_archives(batches, row_of, (*HEAD, "payload", "problem"), (*_HEAD_TYPES, pa.binary(), pa.string()))


def _segment_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First records of several pieces, and their continuations."""

    def row_of(get, block: bytes) -> tuple | None:
        number, total = get("warc-segment-number"), get("warc-segment-total-length")
        if not number:
            return None
        origin = get("warc-segment-origin-id") or get("warc-record-id")
        return *_head(get), origin, int(number), None if total is None else int(total), block

    types = (*_HEAD_TYPES, pa.string(), pa.int32(), pa.int64(), pa.binary())
    return _rows_of_archives(batches, row_of, (*HEAD, "origin", "segment", "total", "block"), types)


def _joined_block(segments: list[dict]) -> bytes:
    """The block that segments make up. Raises ValueError if it isn't whole."""
    ordered = sorted(segments, key=lambda s: s["segment"])
    if any(s["segment"] != i for i, s in enumerate(ordered, 1)):
        raise ValueError("segments are missing or repeated")
    block = b"".join(s["block"] for s in ordered)
    if ordered[-1]["total"] != len(block):
        raise ValueError(f"the segments have {len(block)} bytes, not {ordered[-1]['total']}")
    return block


def _payload(kind: str, digest: str | None, block: bytes) -> tuple[bytes | None, str | None]:
    """The payload of a response, if it agrees with its digest, and what is wrong with it otherwise."""
    if kind != "response":
        return None, None
    try:
        head, _, body = block.partition(END)
        payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    except ValueError as error:
        return None, str(error)
    return (payload, None) if digest == base32_sha1(payload) else (None, "the payload has another digest")


def _decode_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records whose segments have been brought together."""
    names, types = (*HEAD, "payload", "problem"), (*_HEAD_TYPES, pa.binary(), pa.string())
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            rows = []
            for row in batch.slice(at, 64).to_pylist():
                try:
                    found = _payload(row["record_type"], row["digest"], _joined_block(row["segments"]))
                except ValueError as error:
                    found = None, str(error)
                rows.append((*(row[n] for n in HEAD), *found))
            yield _packed(rows, names, types)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per response or revisit record of the archives: ``record_id, record_type, page_id, url, digest, refers_to,
    payload, problem``.

    ``payload`` is decoded and agrees with the record's digest. It is NULL for revisits, and for records that can't be
    put together, for which ``problem`` says why; none is left out. An archive is read as a whole by one task.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    whole = files.mapInArrow(_whole_step, DECODED)
    parts = files.mapInArrow(_segment_step, SEGMENTS)
    lead = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    grouped = parts.groupBy("origin").agg(
        *[lead(c) for c in HEAD[1:]], F.collect_list(F.struct("segment", "total", "block")).alias("segments")
    )
    return whole.unionByName(grouped.withColumnRenamed("origin", "record_id").mapInArrow(_decode_step, DECODED))


def resolve(records: DataFrame) -> DataFrame:
    """Add to each record ``target_page``, the page of the response that it revisits, and the size of its payload.

    The archives are read once; what comes of them, without the payloads, is written for the steps after that.
    """
    sized = save(records.withColumn("own_bytes", F.octet_length("payload").cast("bigint")).drop("payload"), "records")
    targets = sized.filter("record_type = 'response'").groupBy(F.col("record_id").alias("target")).agg(
        F.max("page_id").alias("target_page"), F.max("own_bytes").alias("target_bytes")
    )
    targets = save(targets, "targets")  # for AQE to split the revisits of one page
    revisits = sized.filter("record_type = 'revisit'").join(targets, F.col("refers_to") == F.col("target"), "left").drop("target")
    others = sized.filter("record_type <> 'revisit'").withColumn("target_page", F.lit(None).cast("bigint"))
    both = revisits.unionByName(others.withColumn("target_bytes", F.col("own_bytes")))
    return both.withColumn("payload_bytes", F.coalesce("own_bytes", "target_bytes")).drop("own_bytes", "target_bytes")

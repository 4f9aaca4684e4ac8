"""WARC archives: segmented writing, and segment reassembly on reading.

Writing: a page becomes one ``response`` record whose block is an HTTP
message in chunked transfer framing, or a ``revisit`` record when an equal
payload is stored already. A block over ``segment_bytes`` is spread over a
first record and ``continuation`` records. Spark's text writer puts records
into files of bounded size, so the archives may live in any store.

Reading: archives are parsed record by record; segments are grouped by their
origin identifier, put in order of segment number, checked against the total
length that the last one states, joined, and unframed.

Cases: a null html is an empty payload; a null page id comes after all others
and is written as an empty identifier; rows that repeat the id of a response
are responses too; an empty table gives no rows; a damaged or incomplete
record comes back with a null payload and its fault in ``error``, and reading
goes on at the next place that looks like the begin of a record. A damaged record whose header
can't be read, or a compressed file that breaks off, is a row without an
identifier.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path, stage_table

SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
RECORDS_PER_FILE = 1_000
REVISIT_FROM_BYTES = 100
#: Most bytes of shared payloads' digests that are broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
RECORD_END = "\r\n\r\n"
URN = "urn:x-page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame) -> DataFrame:
    """The pages with their digest and, for a revisit, the page whose response it refers to.

    Equal payloads of at least ``REVISIT_FROM_BYTES`` share one response, that
    of the smallest page id; the minimum is taken map-side first, so a payload
    that a third of all pages share is one row per task.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"))
    rows = rows.withColumns({
        "payload_bytes": F.octet_length("html").cast("long"),
        "digest": F.sha2(F.col("html").cast("binary"), 256),
    })
    first = (
        rows.filter(F.col("payload_bytes") >= REVISIT_FROM_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", "first_page")
    )
    first, _ = stage_table(first, "warc_first")
    small = first.count() * 256 <= BROADCAST_BYTES
    joined = rows.join(F.broadcast(first) if small else first, "digest", "left")
    revisit = F.col("first_page").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_page"))
    return joined.select(
        "page_id", "url", "digest",
        F.when(revisit, F.lit("")).otherwise(F.col("html")).alias("html"),
        F.when(revisit, F.col("first_page")).alias("refers_to"),
    )


def cuts(data: bytes, most: int) -> list[int]:
    """Places to cut data into parts of at most ``most`` bytes, never inside a character."""
    places, lo = [], 0
    while len(data) - lo > most:
        hi = lo + most
        while data[hi] & 0xC0 == 0x80:
            hi -= 1
        places.append(hi)
        lo = hi
    return places


def chunked(payload: bytes, most: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    out, lo = [], 0
    for hi in [*cuts(payload, most), len(payload)]:
        if hi > lo:
            out.append(b"%x\r\n" % (hi - lo) + payload[lo:hi] + b"\r\n")
        lo = hi
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a body in chunked framing; ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size line missing")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(body[at : at + size])
        at += size + 2


def one_line(text: str | None) -> str:
    """A header value: line breaks can't stand in one."""
    return " ".join((text or "").split())


def page_name(page_id, digest: str) -> str:
    return f"{'' if page_id is None else page_id}:{digest}"


def records_of(page_id, url: str | None, digest: str, html: str, refers_to, row_no: int, segment: int):
    """The records of one page as texts, each without the blank lines that end it.

    An identifier is made of page id, payload digest and the row's number; a
    revisit refers to the first two, which rows of one payload share.
    """
    name = f"{page_name(page_id, digest)}:{row_no}"

    def record(kind: str, ident: str, block: bytes, *extra: str) -> str:
        head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{URN}{ident}>", "WARC-Date: 1970-01-01T00:00:00Z"]
        head += [*extra, f"Content-Length: {len(block)}"]
        return "\r\n".join(head) + "\r\n\r\n" + block.decode("utf-8")

    common = [f"WARC-Target-URI: {one_line(url)}", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        yield record(
            "revisit", name, b"", *common, f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: <{URN}{page_name(refers_to, digest)}>",
        )
        return
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    block = head + chunked(html.encode("utf-8"))
    http = [*common, "Content-Type: application/http; msgtype=response"]
    places = cuts(block, segment)
    if not places:
        yield record("response", name, block, *http)
        return
    bounds = [0, *places, len(block)]
    last = len(bounds) - 1
    for k in range(1, last + 1):
        part = block[bounds[k - 1] : bounds[k]]
        if k == 1:
            yield record("response", name, part, *http, "WARC-Segment-Number: 1")
        else:
            total = [f"WARC-Segment-Total-Length: {len(block)}"] if k == last else []
            yield record(
                "continuation", f"{name}:{k}", part, f"WARC-Segment-Origin-ID: <{URN}{name}>",
                f"WARC-Segment-Number: {k}", *total,
            )


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Writes one compressed archive per ``RECORDS_PER_FILE`` records under ``path``."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = zip(*(c.to_pylist() for c in batch.slice(at, 200).columns), strict=True)
                texts = [r for row in rows for r in records_of(*row, segment_bytes)]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["value"])

    planned = plan_records(pages).withColumn("row_no", F.monotonically_increasing_id())
    writer = planned.mapInArrow(records, "value string").write.mode("overwrite").option("compression", "gzip")
    writer.option("lineSep", RECORD_END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


RECORD_SCHEMA = (
    "record_id string, kind string, target_uri string, refers_to string, stated_digest string, "
    "origin_id string, segment int, total_length long, block binary, error string"
)


def unpacked(content: bytes) -> tuple[bytes, str | None]:
    """An archive's bytes, decompressed if need be as far as they can be read, and the fault that ended that."""
    if content[:2] != b"\x1f\x8b":
        return content, None
    out, at = [], 0
    while content.startswith(b"\x1f\x8b", at):
        member = zlib.decompressobj(31)
        try:
            while at < len(content) and not member.eof:
                out.append(member.decompress(content[at : at + CHUNK_BYTES]))
                at += CHUNK_BYTES
        except zlib.error as fault:
            return b"".join(out), f"compressed file damaged: {fault}"
        if not member.eof:
            return b"".join(out), "compressed file cut short"
        at = min(at, len(content)) - len(member.unused_data)
    return b"".join(out), "no compressed data after a member" if content[at:].strip(b"\0") else None


def header_number(value: str | None) -> int | None:
    """A header's number, None where it is absent; ValueError where it is none."""
    if value is None:
        return None
    if not (value.isascii() and value.isdigit() and len(value) < 10):
        raise ValueError(f"{value[:40]!r} is no number")
    return int(value)


def parse_archive(data: bytes) -> Iterator[tuple]:
    """The records of one archive, as rows of ``RECORD_SCHEMA``.

    A fault is a row of kind ``damaged``, after which reading goes on at the
    next place that looks like the begin of a record.
    """
    at = 0
    ident = lambda v: None if v is None else v.strip("<>").removeprefix(URN)
    while at < len(data):
        head, lo = {}, at
        try:
            head_end = data.find(b"\r\n\r\n", at)
            if head_end < 0 or not data.startswith(b"WARC/", at):
                raise ValueError("no record")
            lines = data[at:head_end].decode("utf-8", "replace").split("\r\n")[1:]
            head = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            length, lo = header_number(head.get("content-length")), head_end + 4
            end = lo + (length or 0)
            if length is None or end > len(data) or end < len(data) and not data.startswith(b"\r\n", end):
                raise ValueError("record cut short")
            segment, total = (header_number(head.get(f"warc-segment-{x}")) for x in ("number", "total-length"))
        except ValueError as fault:
            yield (
                ident(head.get("warc-record-id")), "damaged", head.get("warc-target-uri"), None, None, None, None, None, None,
                f"{fault} at byte {at}",
            )
            at = data.find(b"WARC/1.", max(lo, at + 1))
            if at < 0:
                return
            continue
        record_id = ident(head.get("warc-record-id"))
        yield (
            record_id, head.get("warc-type"), head.get("warc-target-uri"), ident(head.get("warc-refers-to")),
            (head.get("warc-payload-digest") or "").removeprefix("sha256:") or None,
            ident(head.get("warc-segment-origin-id")) or record_id, segment, total, data[lo:end], None,
        )
        at = end
        while data.startswith(b"\r\n", at):
            at += 2


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``."""
    schema = pa.schema([
        ("record_id", pa.string()), ("kind", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
        ("stated_digest", pa.string()), ("origin_id", pa.string()), ("segment", pa.int32()),
        ("total_length", pa.int64()), ("block", pa.binary()), ("error", pa.string()),
    ])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                data, fault = unpacked(value.as_py())
                rows = list(parse_archive(data))
                if fault:
                    rows.append((None, "damaged", None, None, None, None, None, None, None, fault))
                for lo in range(0, len(rows), 500):
                    cols = zip(*rows[lo : lo + 500], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, RECORD_SCHEMA)


def message_payload(parts: list[tuple[int, int | None, bytes]]) -> bytes:
    """Payload of an HTTP message given as (segment number, stated total, bytes)."""
    parts = sorted(parts, key=lambda p: p[0])
    if [p[0] for p in parts] != list(range(1, len(parts) + 1)):
        raise ValueError("segments missing or repeated")
    block = b"".join(p[2] for p in parts)
    if len(parts) > 1 and parts[-1][1] is None:
        raise ValueError("last segment missing")
    if parts[-1][1] not in (None, len(block)):
        raise ValueError(f"{len(block)} bytes instead of {parts[-1][1]}")
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of the HTTP header")
    fields = {k.strip().lower(): v.strip().lower() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    return unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body


def reassemble(records: DataFrame) -> DataFrame:
    """One row per response: its payload, or the fault that keeps it from being read.

    Whole records need no shuffle. Only segments are grouped, by origin, and
    such a group is one page.
    """
    one = F.array(F.struct(F.lit(1).alias("segment"), F.col("total_length"), F.col("block")))
    whole = records.filter("kind = 'response' and segment is null or kind = 'damaged'").select(
        "record_id", "target_uri", "stated_digest", F.when(F.col("kind") == "response", one).alias("parts"), "error"
    )
    origin = F.col("kind") == "response"
    split = (
        records.filter("kind in ('response', 'continuation') and segment is not null")
        .groupBy(F.col("origin_id").alias("record_id"))
        .agg(
            F.max(F.when(origin, F.col("target_uri"))).alias("target_uri"),
            F.max(F.when(origin, F.col("stated_digest"))).alias("stated_digest"),
            F.collect_list(F.struct("segment", "total_length", "block")).alias("parts"),
            F.lit(None).cast("string").alias("error"),
        )
    )

    def join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                payloads, errors = [], []
                for value, fault in zip(part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True):
                    if fault is not None:
                        payloads.append(None)
                        errors.append(fault)
                        continue
                    try:
                        payloads.append(message_payload([(p["segment"], p["total_length"], p["block"]) for p in value]))
                        errors.append(None)
                    except ValueError as broken:
                        payloads.append(None)
                        errors.append(str(broken))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(payloads, pa.binary()), pa.array(errors, pa.string())],
                    names=["record_id", "target_uri", "stated_digest", "payload", "error"],
                )

    return whole.unionByName(split).mapInArrow(
        join_parts, "record_id string, target_uri string, stated_digest string, payload binary, error string"
    )


def read_archives(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(responses with payloads, revisits with the identifier that they refer to)."""
    records = read_records(spark, path)
    return reassemble(records), records.filter("kind = 'revisit'").select(
        "record_id", "target_uri", "stated_digest", "refers_to"
    )


def roundtrip(pages: DataFrame) -> DataFrame:
    """Writes the pages as archives, reads these back, and describes each page's payload.

    ``payload_bytes`` and ``payload_digest`` are taken from the payload read
    back; a revisit has those of the response that it refers to.
    """
    spark = pages.sparkSession
    id_type = pages.schema["page_id"].dataType.simpleString()
    path = scratch_path(spark, "archives")
    write_archives(pages, path)
    responses, revisits = read_archives(spark, path)
    page = lambda c: F.expr(f"try_cast(nullif(substring_index({c}, ':', 1), '') as {id_type})")
    described, _ = stage_table(
        responses.select(
            "record_id", F.length("payload").cast("long").alias("payload_bytes"),
            F.sha2("payload", 256).alias("payload_digest"), "error",
        ),
        "warc_payloads",
    )
    named = described.select(
        F.substring_index("record_id", ":", 2).alias("refers_to"), "payload_bytes", "payload_digest", "error"
    )
    found = revisits.select("record_id", "refers_to").join(named.dropDuplicates(["refers_to"]), "refers_to", "left")
    return described.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
        F.lit(None).cast(id_type).alias("refers_to"), "error",
    ).unionByName(
        found.select(
            page("record_id").alias("page_id"), "payload_bytes", "payload_digest",
            F.lit("revisit").alias("record_type"), page("refers_to").alias("refers_to"), "error",
        )
    )

"""WARC archives: writing with segmentation and revisits, reading with segment reassembly.

Writing. Each row becomes an HTTP response record whose body is framed in
chunks; a record block above ``segment_bytes`` is cut into a first segment and
continuation records that name their origin record and segment number, the last
one also the total length. Of rows with equal payloads of at least
``revisit_bytes`` bytes, the one with the largest id is written as response, the
others as revisit records (a digest and a reference, no body). Spark's text
writer puts the records down, with the record end CRLF CRLF as its line
separator, compressed with gzip; ``records_per_file`` bounds the size of a file.

Reading. Files are parsed record by record; whole records are decoded at once,
segments are grouped by the identity of their origin record (only these are
shuffled), ordered by number, checked against the total length, joined, and the
chunked framing is taken off.

A null payload counts as empty. Rows that repeat an id give a record each; a
null id stays null and is never the response that others refer to, unless all
ids of a group are null (then each is a response). Only the id, url and payload
columns are read. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicflow.llm.common import discard_at_exit, scratch_path, ship, written

CRLF = b"\r\n"
RECORD_END = "\r\n\r\n"
GZIP = b"\x1f\x8b"
SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 8 * 1024
RECORDS_PER_FILE = 512
REVISIT_BYTES = 1000
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PARSED = (
    "record_id string, origin_id string, segment_number int, segment_total long, record_type string, url string, "
    "page_id long, refers_to long, payload_bytes long, payload_digest string, header_digest string, "
    "intact boolean, body binary"
)


# ---- one record


def header(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1"] + [f"{k}: {_one_line(v)}" for k, v in fields if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8") + CRLF + CRLF + block


def _one_line(value: object) -> str:
    """A header value; control characters are percent-encoded so that they can't end the line."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in str(value))


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    out = []
    for k in range(0, len(payload), size):
        part = payload[k : k + size]
        out += [b"%x" % len(part), CRLF, part, CRLF]
    out.append(b"0\r\n\r\n")
    return b"".join(out)


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        end = body.index(CRLF, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != CRLF:
            raise ValueError("a chunk doesn't end where its length says")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, gap, body = block.partition(CRLF + CRLF)
    if not gap:
        raise ValueError("an HTTP response without an end of its header")
    fields = dict(_fields(head))
    return unchunked(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body


def _fields(head: bytes) -> list[tuple[str, str]]:
    found = []
    for line in head.split(CRLF)[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if colon:
            found.append((name.strip().lower(), value.strip()))
    return found


def records_of(content: bytes):
    """The records of an archive file: header fields and block."""
    at = 0
    while at < len(content):
        end = content.index(CRLF + CRLF, at)
        if not content.startswith(b"WARC/", at):
            raise ValueError(f"no record begins at byte {at}")
        fields = dict(_fields(content[at:end]))
        start = end + 4
        stop = start + int(fields["content-length"])
        if content[stop : stop + 4] != CRLF + CRLF:
            raise ValueError(f"the record at byte {at} doesn't end where its length says")
        yield fields, content[start:stop]
        at = stop + 4


def record_segments(row: dict, date: str, segment_bytes: int) -> list[bytes]:
    """The records of one row: a revisit, a whole response, or a first segment with its continuations."""
    record_id = f"<urn:uuid:{uuid.uuid4()}>"
    common = [
        ("WARC-Record-ID", record_id),
        ("WARC-Date", date),
        ("WARC-Target-URI", row["url"]),
        ("Page-Id", row["page_id"]),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["refers_to"] is not None:
        more = [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To-Target-URI", row["refers_to_url"]),
            ("WARC-Refers-To-Date", date),
            ("Refers-To-Page-Id", row["refers_to"]),
        ]
        return [header([("WARC-Type", "revisit"), *common, *more], HTTP_HEAD)]
    block = HTTP_HEAD + chunked(row["payload"])
    if len(block) <= segment_bytes:
        return [header([("WARC-Type", "response"), *common], block)]
    parts = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    out = [header([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1)], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        fields = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", row["url"]),
            ("WARC-Segment-Origin-ID", record_id),
            ("WARC-Segment-Number", number),
            ("WARC-Segment-Total-Length", len(block) if number == len(parts) else None),
        ]
        out.append(header(fields, part))
    return out


# ---- tables


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    segment_bytes: int = SEGMENT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
    revisit_bytes: int = REVISIT_BYTES,
) -> None:
    """Write one WARC record per row (with continuations where it is long) under ``path``."""
    ship(pages.sparkSession)
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # One small row per payload that occurs more than once; counts are combined before the shuffle.
    origins = (
        rows.filter(F.octet_length("payload") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("origin"), F.max_by("url", "page_id").alias("origin_url"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("origin").isNotNull())
        .drop("n")
    )
    revisit = F.col("origin").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("origin"))
    planned = rows.join(origins, "digest", "left").select(
        "page_id",
        "url",
        "digest",
        F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, F.col("origin")).alias("refers_to"),
        F.when(revisit, F.col("origin_url")).alias("refers_to_url"),
    )

    def compose(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                out = []
                for row in batch.slice(k, 256).to_pylist():
                    out += record_segments(row, date, segment_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    (
        planned.mapInArrow(compose, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("maxRecordsPerFile", records_per_file)
        .option("compression", "gzip")
        .text(path)
    )


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The rows of the archives under ``path``: page_id, url, record_type, refers_to, payload_bytes, payload_digest.

    ``payload`` too, unless ``with_payload`` is false (null for revisits).
    ``intact`` says that segment numbers, total length, framing and digest agree.
    A revisit has the size of the response that has its digest.
    """
    ship(spark)

    def parse(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                data = content.as_py()
                for fields, block in records_of(gzip.decompress(data) if data.startswith(GZIP) else data):
                    rows.append(_parsed(fields, block, with_payload))
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    files = spark.read.format("binaryFile").load(path).select("content")
    parsed = written(files.mapInArrow(parse, PARSED), "warc-records")

    joined = (
        parsed.filter("segment_number is not null")
        .groupBy(F.coalesce("origin_id", "record_id").alias("origin"))
        .agg(
            F.sort_array(F.collect_list(F.struct("segment_number", "body"))).alias("parts"),
            F.max("segment_total").alias("segment_total"),
            *[F.max(c).alias(c) for c in ("page_id", "header_digest")],
            F.max(F.when(F.col("segment_number") == 1, F.col("url"))).alias("url"),
        )
    )

    def reassemble(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                numbers = [p["segment_number"] for p in row["parts"]]
                block = b"".join(p["body"] for p in row["parts"])
                whole = numbers == list(range(1, len(numbers) + 1)) and row["segment_total"] == len(block)
                rows.append(_response(row["page_id"], row["url"], row["header_digest"], block, whole, with_payload))
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    whole = parsed.filter("segment_number is null").unionByName(joined.mapInArrow(reassemble, PARSED))
    whole = whole.withColumn("payload_digest", F.coalesce("payload_digest", "header_digest"))
    sizes = (
        whole.filter("record_type = 'response'")
        .groupBy("payload_digest")
        .agg(F.max("payload_bytes").alias("size"), F.count("*").alias("responses"))
        .join(parsed.filter("record_type = 'revisit'").select(F.col("header_digest").alias("payload_digest")).distinct(), "payload_digest", "left_semi")
    )
    out = whole.join(sizes, "payload_digest", "left").select(
        "page_id",
        "url",
        F.coalesce("payload_bytes", "size").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
        "intact",
        F.col("body").alias("payload"),
    )
    return out if with_payload else out.drop("payload")


_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("origin_id", pa.string()),
        ("segment_number", pa.int32()),
        ("segment_total", pa.int64()),
        ("record_type", pa.string()),
        ("url", pa.string()),
        ("page_id", pa.int64()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("header_digest", pa.string()),
        ("intact", pa.bool_()),
        ("body", pa.binary()),
    ]
)


def _response(page_id, url, digest, block: bytes, whole: bool, with_payload: bool) -> dict:
    try:
        payload = http_payload(block)
    except ValueError:
        payload = b""
        whole = False
    found = hashlib.sha1(payload).hexdigest()
    return {
        "record_type": "response",
        "url": url,
        "page_id": page_id,
        "payload_bytes": len(payload),
        "payload_digest": found,
        "header_digest": digest,
        "intact": whole and found == digest,
        "body": payload if with_payload else None,
    }


def _parsed(fields: dict, block: bytes, with_payload: bool) -> dict:
    kind = fields["warc-type"]
    number = fields.get("warc-segment-number")
    page_id = int(fields["page-id"]) if "page-id" in fields else None
    digest = fields.get("warc-payload-digest")
    digest = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest else None
    url = fields.get("warc-target-uri")
    if number is not None:
        total = fields.get("warc-segment-total-length")
        return {
            "record_id": fields["warc-record-id"],
            "origin_id": fields.get("warc-segment-origin-id"),
            "segment_number": int(number),
            "segment_total": int(total) if total else None,
            "record_type": kind,
            "url": url,
            "page_id": page_id,
            "header_digest": digest,
            "body": block,
        }
    if kind == "revisit":
        refers = fields.get("refers-to-page-id")
        return {
            "record_id": fields["warc-record-id"],
            "record_type": kind,
            "url": url,
            "page_id": page_id,
            "refers_to": int(refers) if refers else None,
            "header_digest": digest,
            "intact": True,
        }
    return {"record_id": fields["warc-record-id"], **_response(page_id, url, digest, block, True, with_payload)}


def round_trip(pages: DataFrame, with_payload: bool = False, **options) -> DataFrame:
    """Write the pages as archives in the shared checkpoint folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc-archives")
    write_archives(pages, path, **options)
    discard_at_exit(spark, path)
    return read_archives(spark, path, with_payload)

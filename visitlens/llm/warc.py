"""WARC writing with revisits and segments, and segment reassembly (operator 4).

Writing: a page becomes an HTTP response in chunked transfer coding inside a
WARC record; a block longer than ``segment_bytes`` is cut into a first
record and continuation records. Of equal payloads of at least
``min_payload`` bytes the one with the largest page id is stored, others
become revisits that refer to it by its record id. Records are written as text files whose
line separator is the record separator, gzip-compressed, at most about
``records_a_file`` a file, by Spark's own writer, so any shared store will do.

Reading: files are read once and whole (their size is bounded by the record
bounds) and parsed by Content-Length. Complete records are decoded at once; only
the records of segmented payloads are shuffled, grouped by origin id and ordered
by segment number as a stream over sorted partitions. Their total length is
verified against the last segment's, then the chunks are decoded.

Edge cases: a null html is an empty payload; a null page id is written as
``null``; repeated rows with equal page id and payload are all responses
(each has the largest id); with no non-null id in a group all of it are
responses; an empty table writes an empty archive and reads no rows; other
columns are ignored; incomplete or inconsistent records come back with
``error`` set instead of failing the job.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.frames import map_batches, saved, small_batches
from visitlens.session import scratch_dir

CRLF = "\r\n"
VERSION = "WARC/1.1"
RESPONSE_HEAD = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                 "Transfer-Encoding: chunked\r\n\r\n")


def decide_records(pages: DataFrame, min_payload: int = 1000) -> DataFrame:
    """(page_id, url, html, bytes, digest, refers_to, copies) of each page.

    ``refers_to`` is null for a response; ``copies`` of a response that revisits
    refer to is the number of rows with its page id and payload.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.octet_length(html).cast("long").alias("bytes"),
                        F.sha1(html.cast("binary")).alias("digest"))
    # rows of a payload by page id first, so that a common payload is dealt out
    by_id = rows.where(F.col("bytes") >= min_payload).groupBy("digest", "page_id").agg(
        F.count("*").alias("n"))
    groups = saved(by_id.groupBy("digest").agg(
        F.max("page_id").alias("stored"), F.max_by("n", "page_id").alias("copies"),
        F.sum("n").alias("n")).where("n > 1").select("digest", "stored", "copies"), "payloads")
    mine = F.col("page_id") == F.col("stored")
    return rows.join(groups, "digest", "left").select(
        "page_id", "url", "html", "bytes", "digest",
        F.when(F.col("stored").isNotNull() & ~F.coalesce(mine, F.lit(False)), F.col("stored"))
        .alias("refers_to"), F.when(mine, F.col("copies")).alias("copies"))


def _chunks(body: bytes, size: int) -> bytes:
    parts = _cut_text(body, size) if body else []
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def _header(fields) -> bytes:
    lines = [VERSION] + [f"{k}: {v}" for k, v in fields if v is not None]
    return (CRLF.join(lines) + CRLF + CRLF).encode()


def _cut_text(block: bytes, size: int) -> list[bytes]:
    """Parts of at most ``size`` bytes that do not part a UTF-8 character."""
    out, at = [], 0
    while len(block) - at > size:
        end = at + size
        while end > at and (block[end] & 0xC0) == 0x80:
            end -= 1
        out.append(block[at:end])
        at = end
    return out + [block[at:]]


def record_texts(page_id, url, html: str, digest: str, refers_to, copies, segment_bytes: int,
                 chunk_bytes: int, serial: str):
    """The page's WARC records, each as text without the closing separator.

    A response that revisits refer to has the id they name, others have one
    with a serial number. Repeated rows of the former share the id, so these are
    written without segments, which are told apart by their origin's id.
    """
    body = html.encode()
    name = "null" if page_id is None else str(page_id)
    digest32 = base64.b32encode(bytes.fromhex(digest)).decode()
    uri = re.sub(r"[\r\n]", "", url or "")
    common = [("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Target-URI", uri or None),
              ("WARC-Payload-Digest", f"sha1:{digest32}"), ("X-Page-Id", name)]
    rid = f"<urn:page:{name}:{serial}>" if copies is None else f"<urn:page:{name}>"
    if copies is not None and copies > 1:
        segment_bytes = 1 << 62
    if refers_to is not None:
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n"
        yield (_header([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), *common,
                        ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/"
                                         "identical-payload-digest"),
                        ("Content-Type", "application/http; msgtype=response"),
                        ("Content-Length", len(head))]) + head.encode()).decode()
        return
    parts = _cut_text(RESPONSE_HEAD.encode() + _chunks(body, chunk_bytes), segment_bytes)
    for i, part in enumerate(parts, 1):
        last = len(parts) > 1 and i == len(parts)
        yield (_header([
            ("WARC-Type", "response" if i == 1 else "continuation"),
            ("WARC-Record-ID", rid if i == 1 else f"{rid[:-1]}:{i}>"), *common,
            ("WARC-Segment-Number", i if len(parts) > 1 else None),
            ("WARC-Segment-Origin-ID", rid if i > 1 else None),
            ("WARC-Segment-Total-Length", sum(map(len, parts)) if last else None),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", len(part))]) + part).decode()


def write_archives(pages: DataFrame, path: str, segment_bytes: int = 16 << 10,
                   chunk_bytes: int = 4 << 10, records_a_file: int = 2000,
                   min_payload: int = 1000) -> None:
    """Write the pages' records under ``path`` as gzip-compressed WARC files."""
    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts, held = [], 0
            for r in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "html", "digest", "refers_to", "copies"))):
                for text in record_texts(*r, segment_bytes, chunk_bytes, f"{part}-{n}"):
                    texts.append(text)
                    held += len(text)
                n += 1
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])
                    texts, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])

    decide_records(pages, min_payload).transform(map_batches, run, "value string").write \
        .option("lineSep", CRLF + CRLF).option("compression", "gzip") \
        .option("maxRecordsPerFile", records_a_file).text(path)


def parse_records(data: bytes):
    """(headers, block) of the records of a WARC file, by their Content-Length."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            yield {"error": "no record header"}, b""
            return
        head = {}
        for line in data[at:end].decode("utf-8", "replace").split(CRLF)[1:]:
            key, _, value = line.partition(":")
            head[key.strip().lower()] = value.strip()
        size = int(head["content-length"]) if head.get("content-length", "").isdigit() else -1
        at = end + 4 + size
        if size < 0 or at > len(data):
            head["error"] = "bad Content-Length"
            yield head, b""
            return
        yield head, data[end + 4:at]
        at += 4


def decode_http(block: bytes) -> tuple[bytes, str | None]:
    """(payload, error) of an HTTP response, its chunked framing taken off."""
    end = block.find(b"\r\n\r\n")
    if end < 0:
        return b"", "no HTTP header"
    head, body = block[:end].lower(), block[end + 4:]
    if b"transfer-encoding: chunked" not in head:
        return body, None
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        size = body[at:line].split(b";")[0].strip() if line >= 0 else b""
        try:
            n = int(size, 16)
        except ValueError:
            return b"", "bad chunk size"
        at = line + 2
        if n == 0:
            return b"".join(out), None
        if len(body) < at + n + 2 or body[at + n:at + n + 2] != b"\r\n":
            return b"", "short chunk"
        out.append(body[at:at + n])
        at += n + 2


FOUND = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
         "record_type string, refers_to long, error string")
PARTS = ("origin string, number int, total long, head map<string,string>, block binary")


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d+", text) else None


def _row(head, payload, error):
    """A read record: payload facts are recomputed from the payload read back."""
    revisit = head.get("warc-type") == "revisit"
    declared = head.get("warc-payload-digest", "").partition(":")[2]
    try:
        declared = base64.b32decode(declared).hex()
    except ValueError:
        declared = ""
    digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
    if revisit:
        m = re.search(rb"content-length: (\d+)", payload.lower())
        digest, size, payload = declared, int(m[1]) if m else None, None
    elif error is None and declared and declared != digest:
        error = "payload digest differs"
    refers = re.fullmatch(r"<urn:page:(-?\d+)>", head.get("warc-refers-to", ""))
    return {"page_id": _number(head.get("x-page-id")), "url": head.get("warc-target-uri"),
            "payload": payload, "payload_bytes": size, "payload_digest": digest,
            "record_type": "revisit" if revisit else "response",
            "refers_to": int(refers[1]) if refers else None, "error": error}


SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("error", pa.string()), ("origin", pa.string()),
    ("number", pa.int32()), ("total", pa.int64()), ("head", pa.map_(pa.string(), pa.string())),
    ("block", pa.binary())])


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The pages of the archives under ``path``; one row per logical record.

    The archives are read once: pages of complete records and the parts of
    segmented ones are stored, then the parts are brought together.
    """
    small_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path) \
        .select("content")

    def parse(batches):
        for batch in batches:
            for raw in batch.column(0):
                rows, held = [], 0
                for head, block in parse_records(gzip.decompress(raw.as_py())):
                    number = _number(head.get("warc-segment-number"))
                    if number is None:
                        payload, error = (block, None) if head.get("warc-type") == "revisit" \
                            else decode_http(block)
                        rows.append(_row(head, payload, head.get("error") or error))
                        if not with_payload:
                            rows[-1]["payload"] = None
                    else:
                        rows.append({
                            "origin": head.get("warc-segment-origin-id")
                            or head.get("warc-record-id"), "number": number,
                            "total": _number(head.get("warc-segment-total-length")),
                            "head": list(head.items()) if number == 1 else [], "block": block})
                    held += len(block)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    def finish(parts):
        head, blocks = dict(parts[0]["head"]), [p["block"] for p in parts]
        block = b"".join(blocks)
        error = None
        if [p["number"] for p in parts] != list(range(1, len(parts) + 1)):
            error = "segments missing"
        elif parts[-1]["total"] != len(block):
            error = "total length differs"
        payload, bad = decode_http(block)
        row = _row(head, payload, error or bad)
        if not with_payload:
            row["payload"] = None
        return pa.RecordBatch.from_pylist([row], schema=pa.schema(list(SCHEMA)[:8]))

    def reassemble(batches):
        parts: list = []
        for batch in batches:
            for r in batch.to_pylist():
                if parts and r["origin"] != parts[0]["origin"]:
                    yield finish(parts)
                    parts = []
                parts.append(r)
        if parts:
            yield finish(parts)

    read = saved(files.transform(map_batches, parse, f"{FOUND}, {PARTS}"), "records")
    names = [c.split()[0] for c in FOUND.split(", ")]
    segments = read.where("number is not null").select("origin", "number", "total", "head", "block") \
        .repartition("origin").sortWithinPartitions("origin", "number") \
        .transform(map_batches, reassemble, FOUND)
    return read.where("number is null").select(*names).unionByName(segments)


def archive_dir(spark: SparkSession) -> str:
    return f"{scratch_dir(spark, 'llm-warc')}/records"


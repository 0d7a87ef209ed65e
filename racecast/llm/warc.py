"""WARC archives of web pages: written with segments and chunked transfer framing, read back whole.

Writing: pages with equal payloads are told apart by their digest; the one with the largest id is a
response, the others are revisit records that refer to it. A long response is cut into a first
record and continuation records. Reading: records are parsed by their stated lengths, continuation
records are grouped by origin, ordered by segment number and held against the total length, chunked
framing is removed and the payload held against its digest.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
RECORDS_PER_FILE = 4_000

RECORD = (
    "record_id string, record_type string, page_id long, url string, digest string, refers_to long, "
    "segment int, origin string, total_length long, content binary, whole boolean"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing: each chunk after its length in hexadecimal, then an empty chunk."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes | None:
    """The payload of chunked framing (chunk extensions and trailers are passed over), or None if broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            return None
        at = end + 2
        if size == 0:
            return b"".join(out)
        if size < 0 or body[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes | None:
    """The payload of an HTTP response, or None if its header or framing is broken."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    fields = headers(head.split(b"\r\n")[1:])
    return dechunked(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body


def headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines)
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in pairs}


def record(fields: dict[str, str | int | None], content: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields.items() if v is not None)]
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(content), b"", content]) + END


def page_records(
    page_id: int | None, url: str | None, payload: bytes, number: int, refers_to: int | None, segment: int
) -> Iterator[bytes]:
    """All records of one page; ``number`` tells rows with equal ids apart."""
    url = None if url is None else "".join(c for c in url if c >= " ").strip()
    name = f"<urn:page:{'' if page_id is None else page_id}:{number}>"
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": name,
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
        "X-Page-ID": page_id,
    }
    if refers_to is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield record(fields | {"WARC-Profile": profile, "X-Refers-To-Page-ID": refers_to}, b"")
        return
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    block = head + chunked(payload)
    if len(block) <= segment:
        yield record(fields, block)
        return
    yield record(fields | {"WARC-Segment-Number": 1}, block[:segment])
    starts = range(segment, len(block), segment)
    for k, start in enumerate(starts, 2):
        later = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"{name[:-1]}:{k}>",
            "WARC-Date": "1970-01-01T00:00:00Z",
            "WARC-Segment-Origin-ID": name,
            "WARC-Segment-Number": k,
            "WARC-Segment-Total-Length": len(block) if start == starts[-1] else None,
        }
        yield record(later, block[start : start + segment])


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, bool]]:
    """Header fields, content, and whether the record is whole, of each record of an archive.

    Records end where their length says, so content may hold anything. After a broken record the
    next one is searched by its version line.
    """
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        gap = data.find(b"\r\n\r\n", at)
        if gap < 0:
            return
        fields = headers(data[at:gap].split(b"\r\n")[1:])
        size = fields.get("content-length", "")
        start = gap + 4
        if not size.isdigit():
            yield fields, b"", False
            at = start
            continue
        end = start + int(size)
        whole = data[end : end + 4] == b"\r\n\r\n"
        yield fields, data[start:end], whole
        at = end + 4 if whole else start


def write(pages: DataFrame, path: str, page: str = "page_id", url: str = "url", html: str = "html",
          min_bytes: int = 0, segment: int = SEGMENT_BYTES) -> None:
    """Write a record for every row of ``pages`` as gzip archive files in ``path``.

    Rows with a payload of at least ``min_bytes`` that equals the payload of the row with the largest
    page id become revisits of it. NULL html is an empty payload; a NULL url has no field. Rows that
    repeat the largest id of their payload are all responses, as are rows whose payload no row with
    an id has. Other columns are not read.
    """
    rows = pages.select(
        F.col(page).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.sha1("payload"))
    # Counted before the shuffle: one row for each payload and task, whatever the copies.
    copied = rows.groupBy("sha").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    copied = copied.filter((F.col("n") > 1) & F.col("first").isNotNull()).select("sha", "first")
    target = F.when(
        (F.octet_length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")
    )
    joined = rows.join(copied, "sha", "left").select("page_id", "url", "payload", target.alias("refers_to"))
    joined = joined.withColumn("number", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "number", "refers_to"))
            out: list[bytes] = []
            held = 0
            for row in zip(*columns):
                for one in page_records(*row, segment):
                    out.append(one.removesuffix(END))
                    held += len(one)
                if held > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = joined.mapInArrow(run, "record binary")
    # The text writer writes a value's bytes as they are, and the end of a record after each.
    archive = records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END.decode())
    archive.option("maxRecordsPerFile", RECORDS_PER_FILE).option("compression", "gzip").text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in ``path``, plain or gzip, with their segment fields.

    An archive file is one task's work and is held by it, as archives are made to be (about 1 GB at
    most; ``write`` makes far smaller ones).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        schema = pa.schema(
            [("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
             ("digest", pa.string()), ("refers_to", pa.int64()), ("segment", pa.int32()), ("origin", pa.string()),
             ("total_length", pa.int64()), ("content", pa.binary()), ("whole", pa.bool_())]
        )

        def number(text: str | None) -> int | None:
            return int(text) if text and text.lstrip("-").isdigit() else None

        for batch in batches:
            for data in batch.column("content"):
                data = data.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows, held = [], 0
                for fields, content, whole in parse(data):
                    own = fields.get("warc-record-id")
                    rows.append(
                        (own, fields.get("warc-type"), number(fields.get("x-page-id")), fields.get("warc-target-uri"),
                         fields.get("warc-payload-digest", "").rpartition(":")[2] or None,
                         number(fields.get("x-refers-to-page-id")), number(fields.get("warc-segment-number")),
                         fields.get("warc-segment-origin-id", own), number(fields.get("warc-segment-total-length")),
                         content, whole)
                    )
                    held += len(content)
                    if held > 4_000_000:
                        yield _batch(rows, schema)
                        rows, held = [], 0
                yield _batch(rows, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.filter(F.col("length") > 0).select("content").mapInArrow(run, RECORD)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def reassembled(records: DataFrame) -> DataFrame:
    """Whole records: segments joined by origin in the order of their numbers.

    ``whole`` is False where a record was cut off, a segment is missing or repeated, or the total
    differs from what the last segment states. Only segmented records are shuffled; a group is one
    record, so its size is that of a payload.
    """
    single = records.filter("segment is null").drop("segment", "origin", "total_length")
    parts = records.filter("segment is not null")
    first = F.col("segment") == 1
    named = ("record_type", "page_id", "url", "digest", "refers_to")
    joined = parts.groupBy(F.col("origin").alias("record_id")).agg(
        *(F.max(F.when(first, F.col(c))).alias(c) for c in named),
        F.sort_array(F.collect_list(F.struct("segment", "content"))).alias("parts"),
        F.max("total_length").alias("total_length"),
        F.min("whole").alias("whole"),
    )
    numbers = F.transform("parts", lambda x: x["segment"])
    content = F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["content"]))
    complete = (
        F.col("whole")
        & (numbers == F.sequence(F.lit(1), F.size("parts")))
        & F.col("total_length").eqNullSafe(F.octet_length("content"))
    )
    joined = joined.withColumn("content", content).withColumn("whole", F.coalesce(complete, F.lit(False)))
    return joined.select("record_id", *named, "content", "whole").union(
        single.select("record_id", *named, "content", "whole")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the archives in ``path``: a revisit gets what its response holds.

    Columns page_id, url, payload (NULL for revisits), payload_bytes, payload_digest, record_type,
    refers_to, and valid: the record was whole, its framing right and its digest that of its payload.
    An empty folder of archives gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("record_type").to_pylist()
            stated = batch.column("digest").to_pylist()
            whole = batch.column("whole").to_pylist()
            payloads, sizes, digests, valid = [], [], [], []
            for kind, says, ok, content in zip(kinds, stated, whole, batch.column("content")):
                payload = http_payload(content.as_py()) if kind == "response" else None
                found = says if payload is None else digest(payload)
                payloads.append(payload)
                sizes.append(None if payload is None else len(payload))
                digests.append(found)
                valid.append(ok and found == says and (kind != "response" or payload is not None))
            columns = [batch.column(c) for c in ("page_id", "url", "record_type", "refers_to")]
            columns += [pa.array(payloads, pa.binary()), pa.array(sizes, pa.int64())]
            columns += [pa.array(digests, pa.string()), pa.array(valid, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest", "valid"]
    wanted = reassembled(read_records(spark, path)).filter("record_type in ('response', 'revisit')")
    found = wanted.mapInArrow(
        run,
        "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, "
        "payload_digest string, valid boolean",
    )
    return found.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid")


def resolved(pages: DataFrame) -> DataFrame:
    """``pages`` with the length of each revisit's payload, from the response that it refers to.

    A revisit is valid only if its response is and has the same digest.
    """
    sizes = pages.filter("record_type = 'response' and page_id is not null")
    sizes = sizes.groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest")).agg(
        F.max("payload_bytes").alias("_bytes"), F.max("valid").alias("_valid")
    )
    same = (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest"))
    joined = pages.join(sizes, same, "left")
    revisit = F.col("record_type") == "revisit"
    return joined.withColumns(
        {
            "payload_bytes": F.when(revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")),
            "valid": F.when(revisit, F.col("valid") & F.coalesce(F.col("_valid"), F.lit(False))).otherwise(F.col("valid")),
        }
    ).drop("_id", "_digest", "_bytes", "_valid")

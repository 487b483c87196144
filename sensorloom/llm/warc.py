"""WARC archives of pages: writing with revisit records and segments, and reading back with reassembly."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.common import numbered, staged, text_or_empty

# Fixed values of the format.
END = b"\r\n"
GAP = b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(archive: str, row: int, segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{row}/{segment}')}>"


def chunked(body: bytes, size: int = 16384) -> bytes:
    """HTTP chunked transfer framing."""
    out = []
    for at in range(0, len(body), size):
        part = body[at:at + size]
        out += [b"%x" % len(part), END, part, END]
    return b"".join([*out, b"0", GAP])


def unchunk(body: bytes) -> bytes:
    """The content of chunked framing; chunk extensions and trailers are allowed, a broken frame is an error."""
    out, at = [], 0
    while True:
        line = body.find(END, at)
        if line < 0:
            raise ValueError("chunk size is missing")
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != END:
            raise ValueError("chunk is cut short")
        out.append(body[at:at + size])
        at += size + 2


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _head(fields: list[tuple[str, str | None]]) -> bytes:
    lines = ["WARC/1.1"] + [f"{k}: {v}" for k, v in fields if v is not None]
    return "\r\n".join(lines).encode() + GAP


def _uri(url: str | None) -> str | None:
    return None if url is None else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def page_records(archive: str, row: int, key: str | None, url: str | None, payload: bytes | None, digest: str,
                 response_row: int, response_url: str | None, segment_bytes: int, date: str) -> Iterator[bytes]:
    """The WARC records of one page, each without the gap that ends it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + GAP
    common = [("WARC-Date", date), ("WARC-Target-URI", _uri(url)), ("WARC-Page-ID", key),
              ("WARC-Payload-Digest", f"sha1:{digest}")]
    if response_row != row:
        yield _head([("WARC-Type", "revisit"), ("WARC-Record-ID", record_id(archive, row)), *common,
                     ("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", record_id(archive, response_row)),
                     ("WARC-Refers-To-Target-URI", _uri(response_url)),
                     ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(http)))]) + http
        return
    block = http + chunked(payload)
    parts = [block[at:at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    for n, part in enumerate(parts, 1):
        fields = [("WARC-Type", "response" if n == 1 else "continuation"), ("WARC-Record-ID", record_id(archive, row, n))]
        fields += common if n == 1 else common[:2]
        if len(parts) > 1:
            fields += [("WARC-Segment-Number", str(n))]
            fields += [("WARC-Segment-Origin-ID", record_id(archive, row))] if n > 1 else []
            fields += [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
        fields += [("Content-Type", "application/http;msgtype=response")] if n == 1 else []
        yield _head([*fields, ("Content-Length", str(len(part)))]) + part


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                   revisit_bytes: int = 0, segment_bytes: int = 1 << 16, records_per_file: int = 512,
                   date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one WARC record per page to gzipped archive files under `path`, larger ones in segments.

    Of pages with equal payloads of at least `revisit_bytes` bytes the one with the largest id is a
    response and the others revisit it; ids that are null come last, and of rows with equal ids the later
    row counts as larger. Null payloads are empty. Null urls and ids leave their fields out. The choice is an
    aggregation by payload digest; only (row, digest) meet on that key, the payloads are joined by row, so
    a payload shared by many pages crowds nobody. A file holds at most `records_per_file` segments
    and so is small enough to be read whole. Other columns are not looked at.
    """
    archive = uuid.uuid4().hex
    rows = numbered(pages.select(F.col(page_id).alias("key"), F.col(url).cast("string").alias("url"),
                                 text_or_empty(html).alias("html")))
    body = F.col("html").cast("binary")
    own = rows.select("row", "key", "url", F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("size"))
    best = own.where(F.col("size") >= revisit_bytes).groupBy("digest").agg(
        F.max(F.struct(F.col("key").isNotNull().alias("z"), "key", "row", "url")).alias("best"))
    roles = own.join(best, "digest", "left").select(
        "row", F.coalesce("best.row", "row").alias("response_row"), F.col("best.url").alias("response_url"))
    joined = rows.join(roles, "row").select(
        "row", F.col("key").cast("string").alias("key"), "url", body.alias("html"), "response_row", "response_url")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for r in (dict(zip(batch.schema.names, v, strict=True)) for v in zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                for record in page_records(archive, r["row"], r["key"], r["url"], r["html"], sha1_base32(r["html"]),
                                           r["response_row"], r["response_url"], segment_bytes, date):
                    out.append(record)
                    size += len(record)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    (joined.mapInArrow(records, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def inflate(content: bytes) -> bytes:
    """A gzip file of any number of members, or plain bytes."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        if not member.eof:
            raise ValueError("archive is cut short")
        content = member.unused_data
    return b"".join(out)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of each record of an archive."""
    at = 0
    while at < len(data):
        gap = data.find(GAP, at)
        if gap < 0 or not data.startswith(b"WARC/", at):
            raise ValueError("not a WARC record")
        lines = data[at:gap].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        begin = gap + len(GAP)
        end = begin + int(fields["content-length"])
        if data[end:end + len(GAP)] != GAP:
            raise ValueError("record does not end where its length says")
        yield fields, data[begin:end]
        at = end + len(GAP)


RECORD = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.string()), ("uri", pa.string()),
                    ("digest", pa.string()), ("refers_to", pa.string()), ("segment", pa.int32()), ("origin", pa.string()),
                    ("total", pa.int64()), ("block", pa.binary())])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under `path`, one row each; files are read by Spark and parsed in tasks."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out, size = [], 0
                for f, block in parse_records(inflate(content.as_py())):
                    segment, total = f.get("warc-segment-number"), f.get("warc-segment-total-length")
                    out.append({
                        "record_id": f["warc-record-id"], "type": f["warc-type"], "page_id": f.get("warc-page-id"),
                        "uri": f.get("warc-target-uri"), "digest": f.get("warc-payload-digest"),
                        "refers_to": f.get("warc-refers-to"), "segment": segment and int(segment),
                        "origin": f.get("warc-segment-origin-id"), "total": total and int(total), "block": block})
                    size += len(block)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(out, RECORD)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, RECORD)

    return files.mapInArrow(parse, "record_id string, type string, page_id string, uri string, digest string, refers_to string, "
                                   "segment int, origin string, total long, block binary")


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: continuation records joined to their first one by origin identifier, in segment order.

    Unsegmented records pass without a shuffle. `problem` says what is wrong with a record whose segments do
    not run from 1 to the last without a gap, or do not add up to the stated total length; its block is null.
    Segments of one record meet in one group, which is as large as that record.
    """
    fields = ["record_id", "type", "page_id", "uri", "digest", "refers_to"]
    single = records.where("segment IS NULL").select(*fields, "block", F.lit(None).cast("string").alias("problem"))
    first = F.col("segment") == 1
    parts = F.sort_array(F.collect_list(F.struct("segment", "block")))
    groups = records.where("segment IS NOT NULL").withColumn("whole", F.coalesce("origin", "record_id")).groupBy("whole").agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in fields[1:]], F.max("total").alias("total"), parts.alias("parts"))
    numbers = F.transform("parts", lambda p: p["segment"])
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p["block"]))
    problem = (F.when(numbers != F.sequence(F.lit(1), F.size("parts")), F.lit("segments are missing or repeat"))
               .when(F.col("total").isNull(), F.lit("the last segment is missing"))
               .when(length != F.col("total"), F.lit("segments do not add up to the total length")))
    block = F.array_join(F.transform("parts", lambda p: F.hex(p["block"])), "")
    joined = groups.withColumn("problem", problem).select(
        F.col("whole").alias("record_id"), *fields[1:],
        F.when(F.col("problem").isNull(), F.unhex(block)).alias("block"), "problem")
    return single.union(joined)


def payloads(records: DataFrame) -> DataFrame:
    """Payloads of whole response records, decoded from chunked framing and checked against their digest.

    (record_id, type, page_id, uri, refers_to, payload, payload_digest, problem); revisit records have no payload of
    their own and keep the stated digest.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, digests, problems = [], [], []
            for kind, block, digest, problem in zip(*(batch.column(c).to_pylist() for c in ("type", "block", "digest", "problem")), strict=True):
                stated, payload = (digest or "").removeprefix("sha1:"), None
                if kind == "response" and problem is None:
                    head, _, payload = block.partition(GAP)
                    try:
                        payload = unchunk(payload) if b"transfer-encoding: chunked" in head.lower() else payload
                        own = sha1_base32(payload)
                        problem = None if own == stated else "the payload does not have the stated digest"
                        stated = own
                    except ValueError as e:
                        payload, problem = None, str(e)
                content.append(payload)
                digests.append(stated)
                problems.append(problem)
            keep = [batch.column(c) for c in ("record_id", "type", "page_id", "uri", "refers_to")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(content, pa.binary()), pa.array(digests, pa.string()), pa.array(problems, pa.string())],
                ["record_id", "type", "page_id", "uri", "refers_to", "payload", "payload_digest", "problem"])

    return records.mapInArrow(decode, "record_id string, type string, page_id string, uri string, refers_to string, "
                                      "payload binary, payload_digest string, problem string")


def page_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of the archives: (page_id STRING, payload_bytes, payload_digest, record_type, refers_to, problem).

    A revisit takes the size of the payload from the response it refers to, found by record id; a revisit
    of a record that is not there has a problem and no size. An empty archive gives an empty result.
    """
    found = payloads(reassemble(read_records(spark, path))).select(
        "record_id", "type", "page_id", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "problem")
    found = staged(found)
    responses = found.where("type = 'response'")
    targets = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("response"),
                               F.col("payload_bytes").alias("size"))
    revisits = found.where("type = 'revisit'").drop("payload_bytes").join(targets, "refers_to", "left")
    return responses.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                            F.lit(None).cast("string").alias("refers_to"), "problem").union(
        revisits.select("page_id", "size", "payload_digest", "type", "response",
                        F.coalesce("problem", F.when(F.col("size").isNull(), F.lit("the response is missing")))))

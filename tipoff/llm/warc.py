"""WARC archives: deduplicated writing, and reading with reassembly of segmented records.

Writing: payloads of at least ``MIN_REVISIT`` bytes are grouped by SHA-256; the smallest page
id of a group becomes a ``response``, the others ``revisit`` records that refer to it. Tasks
write gzip members (one per record) into files of bounded size in a folder all executors
share, and return a manifest; only files of tasks that succeeded are in it, so a repeated
task leaves at most an unlisted file. Bodies use chunked transfer framing, and blocks longer
than ``SEGMENT_BYTES`` are cut into a first record and ``continuation`` records.

Reading: one archive file per row of work. Whole records are decoded at once; segments are
grouped by the id of their origin record, ordered by segment number, joined, checked against
the announced total length, and freed of their framing. A payload that does not match its
digest fails the job.

Edge cases: null html is an empty payload; a null page id is written as a response of its own;
rows that repeat both page id and payload are one page (one record, one result row); empty
tables give an archive without files.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.session import materialize, shared_dir

MIN_REVISIT = 100
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
FILE_BYTES = 16 << 20
FILES_PER_TASK = 4

MANIFEST = "path string, records long"
RECORDS = (
    "record_id string, page_id long, url string, record_type string, refers_to long, digest string, "
    "origin string, segment int, total long, block binary, payload binary"
)
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = re.compile(r"<urn:page:(-?\d+|none):([0-9a-f]{64})>")


def _file(uri: str):
    """File system and path of a URI or a plain path."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def framed(payload: bytes) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = []
    for at in range(0, len(payload), CHUNK_BYTES):
        piece = payload[at : at + CHUNK_BYTES]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unframed(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        piece = body[end + 2 : end + 2 + size]
        if len(piece) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(piece)
        at = end + 4 + size


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response message."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of HTTP headers")
    chunked = re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r", b""))
    return unframed(body) if chunked else body


def _record(kind: str, record_id: str, block: bytes, headers: dict[str, object]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}"]
    lines += [f"{k}: {v}" for k, v in headers.items() if v is not None]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def records_of(page_id: int | None, url: str | None, digest: str, refers: int | None, payload: bytes, date: str) -> Iterator[bytes]:
    """The WARC records of one page."""
    record_id = f"<urn:page:{'none' if page_id is None else page_id}:{digest}>"
    target = None if url is None else re.sub(r"\s", "%20", url)
    headers = {"WARC-Date": date, "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha256:{digest}"}
    http = {"Content-Type": "application/http; msgtype=response"}
    if refers is not None:
        more = {"WARC-Profile": _REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{refers}:{digest}>"}
        yield _record("revisit", record_id, _HTTP, headers | http | more)
        return
    block = _HTTP + framed(payload)
    cuts = [block[at : at + SEGMENT_BYTES] for at in range(0, len(block), SEGMENT_BYTES)]
    if len(cuts) == 1:
        yield _record("response", record_id, block, headers | http)
        return
    yield _record("response", record_id, cuts[0], headers | http | {"WARC-Segment-Number": 1})
    for number, cut in enumerate(cuts[1:], 2):
        last = {"WARC-Segment-Total-Length": len(block)} if number == len(cuts) else {}
        own = {"WARC-Date": date, "WARC-Segment-Origin-ID": record_id, "WARC-Segment-Number": number}
        yield _record("continuation", f"<urn:uuid:{uuid.uuid4()}>", cut, own | last)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; returns the stored manifest."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("digest"))
    # Owners come from (id, digest, size) rows; payloads move once, by the even key (id, digest).
    small = pages.select("page_id", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("bytes"))
    small = small.where(F.col("bytes") >= MIN_REVISIT)
    owners = small.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    refers = small.join(owners.where("n > 1"), "digest").where("refers_to < page_id")
    refers = refers.groupBy("page_id", "digest").agg(F.first("refers_to").alias("refers_to"))
    rows = rows.join(refers, ["page_id", "digest"], "left").dropDuplicates(["page_id", "digest"])
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, sink, size, count, path = None, None, 0, 0, ""
        done: list[tuple[str, int]] = []

        def finish():
            nonlocal sink, size, count
            if sink is not None:
                sink.close()
                done.append((path, count))
            sink, size, count = None, 0, 0

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                page_id, url, digest, refers_to, text = row
                for record in records_of(page_id, url, digest, refers_to, text.encode(), date):
                    if sink is None:
                        path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                        files, place = _file(path)
                        sink = files.open_output_stream(place, compression=None)
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    sink.write(packer.compress(record) + packer.flush())
                    size, count = size + len(record), count + 1
                if size >= FILE_BYTES:
                    finish()
        finish()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
                ["path", "records"],
            )

    jvm = spark._jvm.org.apache.hadoop.fs.Path(folder)
    jvm.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jvm)
    manifest = rows.select("page_id", "url", "digest", "refers_to", "html").mapInArrow(write, MANIFEST)
    return materialize(manifest)


def _members(path: str, size: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of one archive file, read piece by piece: no more than a record is held."""
    files, place = _file(path)
    with files.open_input_stream(place, compression=None) as source:
        rest = b""
        unpacker, parts = zlib.decompressobj(31), []
        while True:
            if not rest:
                rest = source.read(size)
                if not rest:
                    break
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
            if unpacker.eof:
                yield _parsed(b"".join(parts))
                unpacker, parts = zlib.decompressobj(31), []
        if any(parts):
            raise ValueError(f"{path}: the last record is cut short")


def _parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    headers = {k.lower(): v for k, v in headers.items()}
    length = int(headers["content-length"])
    if len(rest) != length + 4:
        raise ValueError("a block differs from its length")
    return headers, rest[:length]


def read_records(manifest: DataFrame) -> DataFrame:
    """The records of the listed archives; whole responses carry their payload already."""
    names = [x.split(" ")[0] for x in RECORDS.split(", ")]
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    types += [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind, segment = headers["warc-type"], headers.get("warc-segment-number")
        own = _ID.fullmatch(headers["warc-record-id"])
        refers = _ID.fullmatch(headers.get("warc-refers-to", ""))
        origin = headers.get("warc-segment-origin-id") or (headers["warc-record-id"] if segment else None)
        total = headers.get("warc-segment-total-length")
        whole = kind == "response" and segment is None
        return (
            headers["warc-record-id"],
            int(own[1]) if own and own[1] != "none" else None,
            headers.get("warc-target-uri"),
            kind,
            int(refers[1]) if refers else None,
            headers.get("warc-payload-digest", "").removeprefix("sha256:") or None,
            origin,
            int(segment) if segment else None,
            int(total) if total else None,
            block if origin else None,
            http_payload(block) if whole else None,
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for headers, block in _members(path):
                    rows.append(row(headers, block))
                    held += len(block)
                    if held >= 4 << 20:
                        yield _batch(rows, names, types)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names, types)

    # A stated number of partitions: adaptive execution would read the short list of names as one.
    tasks = max(1, -(-manifest.count() // FILES_PER_TASK))
    return manifest.select("path").repartition(tasks, "path").mapInArrow(read, RECORDS)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def reassemble(records: DataFrame) -> DataFrame:
    """Segmented responses joined from their records: (record_id, ..., payload)."""
    first = F.col("record_type") == "response"
    names = ("page_id", "url", "digest")
    pieces = (
        records.where("origin is not null")
        .groupBy("origin")
        .agg(
            *[F.max(F.when(first, F.col(c))).alias(c) for c in names],
            F.max("total").alias("total"),
            F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"),
        )
    )
    schema = "record_id string, page_id long, url string, digest string, payload binary"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = []
            for origin, total, parts in zip(*[batch.column(c).to_pylist() for c in ("origin", "total", "parts")]):
                if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                    raise ValueError(f"{origin}: segments are missing or repeated")
                block = b"".join(p["block"] for p in parts)
                if len(block) != total:
                    raise ValueError(f"{origin}: {len(block)} bytes of {total}")
                payloads.append(http_payload(block))
            columns = [batch.column(c) for c in ("origin", *names)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(payloads, pa.binary())], ["record_id", *names, "payload"]
            )

    return pieces.mapInArrow(join, schema)


def read_pages(manifest: DataFrame) -> DataFrame:
    """Every page of the archives: (page_id, url, record_type, refers_to, payload_digest, payload).

    The payload of a revisit is null here; it is that of the page it refers to.
    """
    records = read_records(manifest)
    own = records.where("origin is null").select(
        "page_id", "url", "record_type", "refers_to", "digest", "payload"
    )
    joined = reassemble(records).select(
        "page_id", "url", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "digest", "payload"
    )
    pages = own.unionByName(joined)
    found = F.sha2("payload", 256)
    same = F.col("payload").isNull() | (found == F.col("digest"))
    checked = F.when(same, F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("payload differs from digest "), "digest"))
    )
    return pages.withColumn("payload_digest", checked.cast("string")).drop("digest")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive ``pages`` and read them back: one row per page with its payload's size and digest."""
    manifest = write_archives(pages, folder or f"{shared_dir(pages.sparkSession)}/warc")
    read = materialize(
        read_pages(manifest).select(
            "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
        )
    )
    # Sizes of revisits come from the responses they refer to, verified by digest.
    response = read.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("_bytes")
    )
    visited = read.where("record_type = 'revisit'").drop("payload_bytes")
    visited = visited.join(response, ["refers_to", "payload_digest"], "left")
    visited = visited.withColumn("payload_bytes", F.col("_bytes")).drop("_bytes")
    return read.where("record_type = 'response'").unionByName(visited)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page of the archives written from ``pages`` and read back."""
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), owner AS (
  SELECT payload_digest, min(page_id) AS owner FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN owner < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN owner < page_id THEN owner END AS refers_to
FROM p LEFT JOIN owner USING (payload_digest)
"""

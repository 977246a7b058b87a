"""Repeated runs of lines, found as content-defined chunks.

A rolling hash over the hashes of the last ``ROLL`` lines ends a chunk wherever it hits a fixed
residue, so chunks realign after inserted or removed lines. Chunks of at least two lines that
occur in several documents stay only in the one with the smallest id, there at their first
place; chunks are told apart by their bytes: Spark groups them on the text itself, with partial
aggregation in the map tasks, and only digests of the repeated ones travel back.

Edge cases: null and empty texts have no lines; a null document id sorts behind all others; rows
that repeat an id never remove from each other; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm.text import MAX_ID, releasing

ROLL = 2
RESIDUES = 4  # a chunk ends at one line in four, on average
MIN_LINES = 2


def chunks(text: str | None) -> list[list[bytes]]:
    """The lines of a text as content-defined chunks, in order."""
    if not text:
        return []
    found: list[list[bytes]] = []
    own: list[bytes] = []
    last: list[int] = []
    for line in text.encode().split(b"\n"):
        own.append(line)
        last = [*last[1 - ROLL :], zlib.crc32(line)] if ROLL > 1 else [zlib.crc32(line)]
        rolled = 0
        for h in last:
            rolled = ((rolled ^ h) * 0x9E3779B1 + (rolled >> 15)) & 0xFFFFFFFF
        if len(own) >= MIN_LINES and (rolled >> 7) % RESIDUES == 0:
            found.append(own)
            own = []
    if own:
        found.append(own)
    return found


def _digest(chunk: bytes) -> bytes:
    return hashlib.md5(chunk, usedforsecurity=False).digest()


def _chunk_rows(docs: DataFrame, whole: bool) -> DataFrame:
    """Distinct multi-line chunks of each row: (doc, row, chunk), or their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                out: list[tuple] = []
                for doc, row, text in zip(*[c.to_pylist() for c in part.columns]):
                    own = {b"\n".join(c): None for c in chunks(text) if len(c) >= MIN_LINES}
                    out += [(MAX_ID if doc is None else doc, row, c if whole else _digest(c)) for c in own]
                if out:
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc", "row", "chunk"])

    return docs.select("doc_id", "row", "text").mapInArrow(releasing(run), "doc long, row long, chunk binary")


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep``, n_lines, n_removed, n_chunks, n_removed_chunks, and ``kept``: the remaining text."""
    extra = [c for c in keep if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text", *extra)
    texts = _chunk_rows(rows, whole=True).groupBy("chunk").agg(F.min("doc").alias("owner"), F.max("doc").alias("other"))
    owners = texts.where("owner < other").select(F.unhex(F.md5("chunk")).alias("chunk"), "owner")
    copies = _chunk_rows(rows, whole=False).join(owners, "chunk").where("doc > owner")
    per_row = copies.groupBy("row").agg(F.collect_set("chunk").alias("gone"))
    joined = rows.join(per_row.hint("shuffle_hash"), "row", "left").select("text", "gone", *keep)
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    schema += "n_lines long, n_removed long, n_chunks long, n_removed_chunks long, kept string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                out = []
                for text, gone in zip(*[c.to_pylist() for c in part.columns[:2]]):
                    found = chunks(text)
                    left, seen, gone = [], set(), set(gone or ())
                    for lines in found:
                        key = _digest(b"\n".join(lines)) if len(lines) >= MIN_LINES else None
                        if key is None or (key not in gone and key not in seen):
                            left.append(lines)
                        seen.add(key)
                    n = sum(map(len, found))
                    kept = b"\n".join(line for lines in left for line in lines)
                    out.append((n, n - sum(map(len, left)), len(found), len(found) - len(left), kept.decode()))
                types = [*[pa.int64()] * 4, pa.string()]
                names = [*keep, "n_lines", "n_removed", "n_chunks", "n_removed_chunks", "kept"]
                made = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                yield pa.RecordBatch.from_arrays([*part.columns[2:], *made], names)

    return joined.mapInArrow(releasing(run), schema)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeated chunks cover, and a digest of the rest."""
    result = remove_repeats(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
    return result.select(
        "doc_id", "n_lines", "n_removed", "n_chunks", "n_removed_chunks", F.sha2("kept", 256).alias("kept_sha256")
    )

"""Benchmark passages in training text, found in a distributed positional inverted index.

The index is a written table. Its rows are shards: all postings of some consecutive documents,
as sorted term hashes, the end of each term's list, and word positions in the shard. A document
never spans shards, so a phrase is found within one row and postings are never shuffled.

A search takes test phrases in blocks of bounded size. In a shard a phrase starts from the
list of its rarest term, moved by the term's offset, and is intersected with the moved lists
of its other terms, rarest first. Exact phrases need all terms at their places; proximity
matches need every term within some words of the rarest one.

Edge cases: null and empty texts have no words; a null item id is written as an empty string;
items that repeat an id share it; rows that repeat a document id are documents of their own;
empty tables give an empty index or no matches; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import text as tx
from tipoff.session import shared_dir

WINDOW = 13
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 4 << 20  # test text searched for at once; what is broadcast is a small multiple

INDEX = "shard long, doc_ids array<long>, doc_words array<int>, terms binary, ends binary, positions binary"


def build_index(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the index of ``docs`` (doc_id, text) and read it back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        hashes: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        counts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, hashes, doc_ids, counts, held
            words = np.concatenate(hashes)
            order = np.argsort(words, kind="stable")
            words = words[order]
            first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else order
            ends = np.append(first[1:], len(words)).astype("<u4") if len(words) else order.astype("<u4")
            row = [
                pa.array([shard], pa.int64()),
                pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([np.concatenate(counts)], pa.list_(pa.int32())),
                *[pa.array([x.tobytes()], pa.binary()) for x in (words[first], ends, order.astype("<u4"))],
            ]
            shard, hashes, doc_ids, counts, held = shard + 1, [], [], [], 0
            return pa.RecordBatch.from_arrays(row, ["shard", "doc_ids", "doc_words", "terms", "ends", "positions"])

        for batch in batches:
            known = batch.column(0).to_pylist()
            for part in tx.slices(batch.column(1)):
                starts, ends, rows = tx.spans(part, tx.LETTERS_DIGITS)
                n = len(part.offsets) - 1
                hashes.append(tx.word_hashes(part, starts, ends, lower=True))
                doc_ids += known[part.first : part.first + n]
                counts.append(np.bincount(rows, minlength=n).astype(np.int32))
                held += len(starts)
                if held >= SHARD_WORDS:
                    yield flush()
        if doc_ids:
            yield flush()

    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/index"
    rows = docs.select("doc_id", "text").mapInArrow(tx.releasing(run), INDEX)
    # Small row groups: a reader's task holds a few shards at a time.
    rows.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return spark.read.schema(INDEX).parquet(path)


class Phrases(NamedTuple):
    """Distinct phrases of one length: terms as numbers into ``vocabulary``, and their items."""

    vocabulary: np.ndarray
    terms: np.ndarray
    items: list[list[str]]


def item_windows(rows: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[Phrases]:
    """The windows of test items, by length: whole items where they are shorter than a window."""
    by_length: dict[int, dict[bytes, set[str]]] = {}
    for part in tx.slices(pa.array([text for _, text in rows], pa.string())):
        starts, ends, at = tx.spans(part, tx.LETTERS_DIGITS)
        words = tx.word_hashes(part, starts, ends, lower=True)
        for i in np.unique(at):
            own = words[np.searchsorted(at, i) : np.searchsorted(at, i, "right")]
            item = rows[part.first + int(i)][0] or ""
            length = min(window, len(own))
            for k in range(len(own) - length + 1):
                by_length.setdefault(length, {}).setdefault(own[k : k + length].tobytes(), set()).add(item)
    found = []
    for length, windows in sorted(by_length.items()):
        matrix = np.frombuffer(b"".join(windows), np.uint64).reshape(-1, length)
        vocabulary, terms = np.unique(matrix, return_inverse=True)
        found.append(Phrases(vocabulary, terms.reshape(matrix.shape), [sorted(x) for x in windows.values()]))
    return found


class Shard:
    """One row of the index."""

    def __init__(self, doc_words: np.ndarray, terms: bytes, ends: bytes, positions: bytes) -> None:
        self.bounds = np.concatenate([[0], np.cumsum(doc_words, dtype=np.int64)])
        self.terms = np.frombuffer(terms, np.uint64)
        self.ends = np.frombuffer(ends, "<u4").astype(np.int64)
        self.positions = np.frombuffer(positions, "<u4")

    def lists(self, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and length of each term's list; length 0 where the shard lacks the term."""
        if not len(self.terms):
            return np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
        at = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        size = self.ends[at] - np.where(at > 0, self.ends[at - 1], 0)
        return at, np.where(self.terms[at] == vocabulary, size, 0)

    def list_of(self, at: int) -> np.ndarray:
        return self.positions[self.ends[at - 1] if at else 0 : self.ends[at]]

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, "right") - 1

    def phrases(self, phrases: Phrases) -> Iterator[tuple[int, np.ndarray]]:
        """(phrase number, its start positions) of every phrase that occurs."""
        at, size = self.lists(phrases.vocabulary)
        sizes = size[phrases.terms]
        length = phrases.terms.shape[1]
        for k in np.flatnonzero((sizes > 0).all(axis=1)):
            order = np.argsort(sizes[k], kind="stable")
            start = self.list_of(at[phrases.terms[k, order[0]]]).astype(np.int64) - order[0]
            start = start[start >= 0]
            for j in order[1:]:
                if not len(start):
                    break
                own = self.list_of(at[phrases.terms[k, j]])
                there = np.minimum(np.searchsorted(own, start + j), len(own) - 1)
                start = start[own[there] == start + j]
            if len(start):
                start = start[self.document(start) == self.document(start + length - 1)]
            if len(start):
                yield int(k), start

    def near(self, phrases: Phrases, slop: int) -> Iterator[tuple[int, np.ndarray]]:
        """(phrase number, positions of its rarest term with every other term within ``slop`` words)."""
        at, size = self.lists(phrases.vocabulary)
        sizes = size[phrases.terms]
        for k in np.flatnonzero((sizes > 0).all(axis=1)):
            order = np.argsort(sizes[k], kind="stable")
            place = self.list_of(at[phrases.terms[k, order[0]]]).astype(np.int64)
            for j in order[1:]:
                own = self.list_of(at[phrases.terms[k, j]]).astype(np.int64)
                doc = self.document(place)
                low = np.maximum(place - slop, self.bounds[doc])
                high = np.minimum(place + slop, self.bounds[doc + 1] - 1)
                place = place[np.searchsorted(own, low) < np.searchsorted(own, high, "right")]
            if len(place):
                yield int(k), place


MATCHES = "shard long, doc int, item string, start int, length int"


def search(index: DataFrame, blocks: list[list[Phrases]], slop: int | None = None) -> DataFrame:
    """Matches (shard, document number in it, item, first word, words); a scan per block.

    With ``slop``, proximity matches: ``start`` is the rarest term's word and ``length`` 1.
    """
    spark = index.sparkSession
    found = spark.createDataFrame([], MATCHES)
    columns = index.select("shard", "doc_words", "terms", "ends", "positions")
    for block in blocks:
        phrases = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], phrases=phrases) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    shard_id, doc_words, *data = [c[i] for c in batch.columns]
                    shard = Shard(doc_words.values.to_numpy(zero_copy_only=False), *[x.as_buffer() for x in data])
                    out: list[list[np.ndarray]] = [[], [], [], []]
                    for group in phrases.value:
                        length = group.terms.shape[1] if slop is None else 1
                        for k, start in shard.phrases(group) if slop is None else shard.near(group, slop):
                            doc = shard.document(start)
                            for item in group.items[k]:
                                out[0].append(doc.astype(np.int32))
                                out[1].append(np.full(len(start), item, object))
                                out[2].append((start - shard.bounds[doc]).astype(np.int32))
                                out[3].append(np.full(len(start), length, np.int32))
                    if out[0]:
                        doc, item, start, size = [np.concatenate(x) for x in out]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(doc), shard_id.as_py())), pa.array(doc), pa.array(item, pa.string()), pa.array(start), pa.array(size)],
                            ["shard", "doc", "item", "start", "length"],
                        )

        found = found.unionByName(columns.mapInArrow(tx.releasing(run), MATCHES))
    return found


def item_blocks(items: DataFrame, window: int = WINDOW) -> Iterator[list[Phrases]]:
    """Windows of test items (item_id, text), collected a block of about ``BLOCK_BYTES`` at a time."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    for i in range(n):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else rows
        yield item_windows([(r.item_id, r.text) for r in own.collect()], window)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: words, words inside test windows, the items found, and the verdict."""
    index = build_index(docs)
    matches = search(index, list(item_blocks(items, window)))
    # A document's ranges and items: ranges are merged within the document's own row.
    per_doc = matches.groupBy("shard", "doc", "start").agg(
        F.max("length").alias("length"), F.collect_set("item").alias("items")
    )
    ranges = F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("end"))))
    per_doc = per_doc.groupBy("shard", "doc").agg(
        ranges.alias("ranges"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    step = F.aggregate(
        "ranges",
        F.struct(F.lit(0).alias("hit"), F.lit(0).alias("at")),
        lambda s, r: F.struct(
            (s["hit"] + F.greatest(r["end"] - F.greatest(r["start"], s["at"]), F.lit(0))).alias("hit"),
            F.greatest(s["at"], r["end"]).alias("at"),
        ),
        lambda s: s["hit"],
    )
    hit = per_doc.select("shard", "doc", step.alias("hit"), "items")
    words = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("doc", "d"))
    words = words.select("shard", "doc", F.col("d.doc_ids").alias("doc_id"), F.col("d.doc_words").alias("n_words"))
    joined = words.join(hit, ["shard", "doc"], "left")
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    n_words = F.col("n_words").cast("long")
    return joined.select(
        "doc_id",
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= n_words)).alias("contaminated"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by ``benchmark``."""
    base = sf_dir.rstrip("/")
    return contamination(spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/benchmark.parquet"))

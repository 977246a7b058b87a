"""Repeated passages, counted exactly by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash among its runs of
``SEED`` words; equal windows have equal minimisers. Consecutive windows that share one travel
together: their words as one packed string, to the bucket of the minimiser. A task packs the
strings it has for a bucket into one compressed row and ships equal strings once, with the list
of their places. In the bucket windows are sorted; equal ones are confirmed byte by byte, and
the smallest document id decides who keeps them. What returns to a document are word ranges.

Minimisers in more than ``HOT_STRINGS`` strings (or a millionth of all, if that is more) take
another road that any number of machines can share: their windows are counted by a two-hash
key with partial aggregation in the map tasks. There are at most a million such minimisers,
whatever the input. Both roads decide alike.

Edge cases: null and empty texts have no words; a null document id sorts behind all others;
rows that repeat an id never remove from each other; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import text as tx
from tipoff.session import materialize

WINDOW = 50
SEED = 5
BUCKET_STRINGS = 40_000  # packed strings of a bucket, about 400 bytes each before compression
FLUSH_BYTES = 8 << 20  # text a task reads before it ships its rows
HOT_STRINGS = 50_000
HOT_LIMIT = 1_000_000


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    reach, out = 1, values
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[:-step], out[step:])
        reach += step
    return out


class Strings:
    """The super-k-mers of a slice: minimiser, row, first word and windows of each."""

    def __init__(self, part: tx.Slice, window: int, seed: int) -> None:
        self.starts, self.ends, self.rows = tx.spans(part, tx.BLANK_SEPARATED)
        self.words = tx.word_hashes(part, self.starts, self.ends)
        at = tx.window_starts(self.rows, window)
        if not len(at):
            self.minimiser, self.first, self.windows = np.zeros(0, np.uint64), at, at
            return
        seeds = np.arange(len(self.words) - seed + 1)
        least = _sliding_min(tx.window_hashes(self.words, seeds, seed), window - seed + 1)[at]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | (self.rows[at[1:]] != self.rows[at[:-1]])])
        where = np.flatnonzero(new)
        self.minimiser = tx.mix(least[where])
        self.first = at[where]
        self.windows = np.diff(np.append(where, len(at)))


def _packed(part: tx.Slice, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words joined by single blanks, and where each begins."""
    size = ends - starts + 1
    begin = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(begin[-1]) + np.repeat(starts - begin[:-1], size)
    source[begin[1:] - 1] = 0
    data = part.data[source]
    data[begin[1:] - 1] = 32
    return data.tobytes(), begin


_ROWS = "bucket long, texts binary, sizes binary, string binary, doc binary, row binary, first binary"


def _ship(docs: DataFrame, buckets: int, hot: np.ndarray, window: int, seed: int) -> DataFrame:
    names = ["bucket", "texts", "sizes", "string", "doc", "row", "first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        read = 0

        def flush() -> Iterator[pa.RecordBatch]:
            packer = zstandard.ZstdCompressor(level=1)
            for bucket, box in held.items():
                texts = list(box["texts"])
                row = [
                    packer.compress(b"\n".join(texts)),
                    np.array([len(t) for t in texts], np.int64).tobytes(),
                    np.array(box["string"], np.int64).tobytes(),
                    *[np.concatenate(box[c]).tobytes() for c in ("doc", "row", "first")],
                ]
                yield pa.RecordBatch.from_arrays([pa.array([bucket]), *[pa.array([x], pa.binary()) for x in row]], names)
            held.clear()

        for batch in batches:
            doc_ids, keys = tx.ids(batch, "doc_id"), tx.ids(batch, "row")
            for part in tx.slices(batch.column(2)):
                found = Strings(part, window, seed)
                if len(found.first):
                    use = np.flatnonzero(~np.isin(found.minimiser, hot)) if len(hot) else np.arange(len(found.first))
                    data, begin = _packed(part, found.starts, found.ends)
                    target = (found.minimiser[use] % np.uint64(buckets)).astype(np.int64)
                    use = use[order := np.argsort(target, kind="stable")]
                    target = target[order]
                    first = found.first[use]
                    lo, hi = begin[first], begin[first + found.windows[use] + window - 1] - 1
                    doc = doc_ids[part.first + found.rows[first]]
                    row = keys[part.first + found.rows[first]]
                    in_row = first - np.searchsorted(found.rows, found.rows[first])
                    cuts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else []
                    for a, b in zip(cuts, [*cuts[1:], len(target)]):
                        box = held.setdefault(int(target[a]), {"texts": {}, "string": [], "doc": [], "row": [], "first": []})
                        known = box["texts"]
                        for x, y in zip(lo[a:b].tolist(), hi[a:b].tolist()):
                            box["string"].append(known.setdefault(data[x:y], len(known)))
                        box["doc"].append(doc[a:b])
                        box["row"].append(row[a:b])
                        box["first"].append(in_row[a:b].astype(np.int64))
                read += len(part.data)
                if read >= FLUSH_BYTES:
                    yield from flush()
                    read = 0
        yield from flush()

    return docs.mapInArrow(run, _ROWS)


def _first_equal(data: bytes, part: tx.Slice, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all windows of the strings (rows of ``part``): string, and number of the first equal window.

    Hashes sort the windows; runs of windows that seem equal to earlier runs are compared byte
    by byte. Should a hash ever lie, windows are told apart by their bytes alone.
    """
    found = []
    for some in tx.parts(part):
        starts, ends, rows = tx.spans(some, tx.BLANK_SEPARATED)
        at = tx.window_starts(rows, window)
        hashes = tx.window_hashes(tx.word_hashes(some, starts, ends), at, window)
        byte = part.offsets[some.first]
        found.append((hashes, starts[at] + byte, ends[at + window - 1] + byte, rows[at] + some.first))
    hashes, lo, hi, string = [np.concatenate(x) for x in zip(*found)]
    order = np.argsort(hashes, kind="stable")
    in_order = hashes[order]
    new = np.concatenate([[True], in_order[1:] != in_order[:-1]]) if len(order) else np.zeros(0, bool)
    first = np.empty(len(hashes), np.int64)
    first[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    copy = np.flatnonzero(first != np.arange(len(hashes)))
    if len(copy):
        head = np.concatenate(
            [[True], (copy[1:] != copy[:-1] + 1) | (first[copy[1:]] != first[copy[:-1]] + 1)
             | (string[copy[1:]] != string[copy[:-1]]) | (string[first[copy[1:]]] != string[first[copy[:-1]]])]
        )
        begin = np.flatnonzero(head)
        end = np.append(begin[1:], len(copy)) - 1
        a, b = copy[begin], copy[end]
        same = all(
            data[w:x] == data[y:z]
            for w, x, y, z in zip(lo[a].tolist(), hi[b].tolist(), lo[first[a]].tolist(), hi[first[b]].tolist())
        )
        if not same:
            seen: dict[bytes, int] = {}
            first = np.array([seen.setdefault(data[x:y], i) for i, (x, y) in enumerate(zip(lo.tolist(), hi.tolist()))])
    return string, first


RANGES = "row long, first long, last long"


def _count(window: int):
    def run(table: pa.Table) -> pa.Table:
        unpacker = zstandard.ZstdDecompressor()
        texts, sizes, strings, docs, keys, firsts = [], [], [], [], [], []
        n = 0
        for r in table.to_batches():
            for packed, size, string, doc, key, first in zip(*[r.column(c).to_pylist() for c in ("texts", "sizes", "string", "doc", "row", "first")]):
                size = np.frombuffer(size, np.int64)
                texts.append(unpacker.decompress(packed, max_output_size=int(size.sum()) + len(size)))
                sizes.append(size)
                strings.append(np.frombuffer(string, np.int64) + n)
                n += len(size)
                docs.append(np.frombuffer(doc, np.int64))
                keys.append(np.frombuffer(key, np.int64))
                firsts.append(np.frombuffer(first, np.int64))
        data = b"\n".join(texts)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes) + 1)])
        offsets[-1] -= 1
        part = tx.Slice(0, offsets, np.frombuffer(data, np.uint8))
        string, doc, key, place = [np.concatenate(x) for x in (strings, docs, keys, firsts)]
        least = np.full(n, tx.MAX_ID)
        np.minimum.at(least, string, doc)
        of, first = _first_equal(data, part, window)
        owner = np.full(len(of), tx.MAX_ID)
        np.minimum.at(owner, first, least[of])
        owner = owner[first]
        bounds = np.searchsorted(of, np.arange(n + 1))
        low = np.minimum.reduceat(owner, bounds[:-1])
        high = np.maximum.reduceat(owner, bounds[:-1])
        windows = np.diff(bounds)
        whole = np.flatnonzero(doc > high[string])
        some = np.flatnonzero((doc > low[string]) & (doc <= high[string]))
        out = [(key[whole], place[whole], place[whole] + windows[string[whole]] + window - 1)]
        for i in some.tolist():
            s = string[i]
            gone = np.flatnonzero(owner[bounds[s] : bounds[s + 1]] < doc[i])
            cut = np.flatnonzero(np.diff(gone) > 1)
            begin, end = gone[np.append(0, cut + 1)], gone[np.append(cut, len(gone) - 1)]
            out.append((np.full(len(begin), key[i]), place[i] + begin, place[i] + end + window))
        row, begin, end = [np.concatenate(x) for x in zip(*out)]
        return pa.table([pa.array(x.astype(np.int64)) for x in (row, begin, end)], ["row", "first", "last"])

    return run


def _hot_ranges(docs: DataFrame, hot: np.ndarray, window: int, seed: int) -> DataFrame:
    """Ranges from windows whose minimiser is hot, by a key of two hashes per window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, keys = tx.ids(batch, "doc_id"), tx.ids(batch, "row")
            for part in tx.slices(batch.column(2)):
                found = Strings(part, window, seed)
                use = np.flatnonzero(np.isin(found.minimiser, hot))
                if not len(use):
                    continue
                at = np.concatenate([np.arange(f, f + n) for f, n in zip(found.first[use], found.windows[use])])
                h1 = tx.window_hashes(found.words, at, window)
                h2 = tx.window_hashes(tx.mix(found.words ^ np.uint64(0xD6E8FEB86659FD93)), at, window)
                row = found.rows[at]
                columns = [h1.view(np.int64), h2.view(np.int64), doc_ids[part.first + row], keys[part.first + row]]
                columns.append((at - np.searchsorted(found.rows, row)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h1", "h2", "doc", "row", "first"])

    windows = docs.mapInArrow(run, "h1 long, h2 long, doc long, row long, first long")
    owners = windows.groupBy("h1", "h2").agg(F.min("doc").alias("owner"), F.max("doc").alias("other"))
    owners = owners.where("owner < other").drop("other")
    copies = windows.join(owners, ["h1", "h2"]).where("doc > owner")
    return copies.select("row", "first", (F.col("first") + window).alias("last"))


def repeated_ranges(docs: DataFrame, window: int = WINDOW, seed: int = SEED, hot_strings: int | None = None) -> DataFrame:
    """(row, first, last): word ranges that documents with smaller ids hold as well.

    ``docs`` has (doc_id, row, text); ``row`` names a row of the table.
    """
    docs = docs.select("doc_id", "row", "text")

    def minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch.column(2)):
                found, n = np.unique(Strings(part, window, seed).minimiser, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], ["m", "n"])

    counts = docs.mapInArrow(minimisers, "m long, n long").groupBy("m").agg(F.sum("n").alias("n"))
    counts = materialize(counts.groupBy(F.when(F.col("n") >= (hot_strings or HOT_STRINGS), F.col("m")).alias("m")).agg(F.sum("n").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(hot_strings or HOT_STRINGS, total // HOT_LIMIT)
    hot = np.array([r.m for r in counts.where((F.col("n") >= least) & F.col("m").isNotNull()).select("m").collect()], np.int64)
    hot = np.sort(hot.view(np.uint64))
    buckets = max(1, -(-total // BUCKET_STRINGS))
    shipped = _ship(docs, buckets, hot, window, seed)
    ranges = shipped.groupBy("bucket").applyInArrow(_count(window), RANGES)
    if len(hot):
        ranges = ranges.unionByName(_hot_ranges(docs, hot, window, seed))
    return ranges


def drop_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` is the text of the words outside all ranges."""
    per_row = ranges.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    joined = docs.select("row", "doc_id", "text").join(per_row.hint("shuffle_hash"), "row", "left")
    schema = "doc_id long, n_words long, n_removed long, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n_words, n_removed, kept = [], [], []
                for text, ranges in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    words = (text or "").encode().split()
                    n_words.append(len(words))
                    if ranges:
                        depth = np.zeros(len(words) + 1, np.int64)
                        np.add.at(depth, [r["first"] for r in ranges], 1)
                        np.add.at(depth, [r["last"] for r in ranges], -1)
                        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
                    ["doc_id", "n_words", "n_removed", "kept"],
                )

    return joined.select("doc_id", "text", "ranges").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED, hot_strings: int | None = None) -> DataFrame:
    """Documents without the words of passages that documents with smaller ids hold as well."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    return drop_ranges(rows, repeated_ranges(rows, window, seed, hot_strings))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeated passages of 50 words cover, and what is left."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    result = remove_repeats(docs)
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

"""Exact Jaccard self-join of word shingles with set-relation skipping.

Documents with equal shingle sets are one node. Shingles are dealt by hash to buckets, packed;
a bucket tells which shingles only one node has. A node with more than a fifth of such
shingles has no partner and is done; the others keep their shared shingles, which is all
their overlaps can consist of, with how common each is.

Shingles are ordered rarest first, and two linked nodes share one of the first few (the
prefix). Nodes that are chained by shared prefix shingles form candidate groups; groups are
joined in parallel, large ones in tiles of node pairs, by an index over prefixes:

* its lists are cut in blocks by position; a block is skipped when no set in it can reach the
  needed overlap from that position on, and set sizes bound the rest;
* a set starts with the most recent set on its rarest list. If the two link, what is known of
  that set is taken over: all sets it is connected with need no comparison, and only sets
  beyond that component are looked at.

The result is the partition into components; links inside a known component are not listed.

Shingles are told apart by 48 bits of a hash besides the bits that choose their bucket, sets
by 64 bits.

Edge cases: null and blank texts have empty sets and link with nothing; a text of fewer than
five words is one shingle; a null document id sorts behind all others; rows that repeat an id
are one node each and count as that id; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import text as tx
from tipoff.llm.components import components, forest
from tipoff.session import materialize

SHINGLE = 5
BUCKET_SHINGLES = 2_000_000
TILE_SHINGLES = 4_000_000
FLUSH_BYTES = 8 << 20
POSITION_BLOCK = 16


def needed(a: int, b: int) -> int:
    """Least overlap of linked sets of these sizes: 100 o >= 80 (a + b - o)."""
    return -(-4 * (a + b) // 9)


def linked(overlap: int, a: int, b: int) -> bool:
    return overlap > 0 and 100 * overlap >= 80 * (a + b - overlap)


def _sets(part: tx.Slice, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a slice sorted by row, their rows, and the rows' bounds."""
    starts, ends, rows = tx.spans(part, tx.BLANK_SEPARATED)
    words = tx.word_hashes(part, starts, ends, lower=True)
    at = tx.window_starts(rows, shingle)
    n = len(part.offsets) - 1
    bounds = np.searchsorted(rows, np.arange(n + 1))
    short = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < shingle))
    first = np.concatenate([at, bounds[short]])
    size = np.concatenate([np.full(len(at), shingle), np.diff(bounds)[short]])
    hashes, row = tx.window_hashes(words, first, size), rows[first] if len(first) else first
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    if len(row):
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])])
        hashes, row = hashes[new], row[new]
    return hashes, row, np.searchsorted(row, np.arange(n + 1))


def _nodes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One number per set, equal for equal sets."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(tx.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)))])
    size = np.diff(bounds).astype(np.uint64)
    return tx.mix((sums[bounds[1:]] - sums[bounds[:-1]]) ^ tx.mix(size)).view(np.int64)


def _describe(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, node, n) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch.column(1)):
                hashes, _, bounds = _sets(part, shingle)
                n = len(part.offsets) - 1
                ids = batch.column(0).slice(part.first, n)
                sizes = np.diff(bounds).astype(np.int64)
                yield pa.RecordBatch.from_arrays([ids, pa.array(_nodes(hashes, bounds)), pa.array(sizes)], ["doc_id", "node", "n"])

    return docs.select("doc_id", "text").mapInArrow(tx.releasing(run), "doc_id long, node long, n long")


def _cut48(values: np.ndarray) -> bytes:
    """The upper six bytes of 64-bit values."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _join48(data: bytes) -> np.ndarray:
    """Those bytes as 64-bit values with the lower two bytes zero."""
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(np.uint64)


_PACKED = "bucket long, nodes binary, counts binary, tokens binary"
_PACKED_NAMES = ["bucket", "nodes", "counts", "tokens"]
RUN = 255  # shingles of a node in one run, whose length is packed in a byte


def _runs(nodes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Where runs of one node begin, and their lengths; longer runs are cut."""
    head = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))
    count = np.diff(np.append(head, len(nodes)))
    cuts = -(-count // RUN)
    if len(cuts) and cuts.max() > 1:
        head = np.repeat(head, cuts) + RUN * (np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts))
        count = np.diff(np.append(head, len(nodes)))
    return head, count.astype(np.uint8).tobytes()


def _unpack_nodes(nodes: bytes, counts: bytes) -> np.ndarray:
    return np.repeat(np.frombuffer(nodes, np.int64), np.frombuffer(counts, np.uint8))


def _buckets(target: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of every bucket of sorted targets."""
    cuts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])).tolist() if len(target) else []
    return list(zip(cuts, [*cuts[1:], len(target)]))


def _ship(docs: DataFrame, buckets: int, shingle: int) -> DataFrame:
    """Shingles by bucket: per row nodes, shingles of each here, and the shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # hashes, node per shingle
        seen: set[int] = set()
        read = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            hashes, node = [np.concatenate(x) for x in zip(*held)]
            target = (tx.mix(hashes) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(target, kind="stable")
            hashes, node, target = hashes[order], node[order], target[order]
            for a, b in _buckets(target):
                head, counts = _runs(node[a:b])
                row = [node[a:b][head].tobytes(), counts, _cut48(hashes[a:b])]
                yield pa.RecordBatch.from_arrays([pa.array([int(target[a])]), *[pa.array([x], pa.binary()) for x in row]], _PACKED_NAMES)
            held.clear()
            seen.clear()

        for batch in batches:
            for part in tx.slices(batch.column(0)):
                hashes, row, bounds = _sets(part, shingle)
                nodes = _nodes(hashes, bounds)
                use = np.zeros(len(nodes), bool)
                for i in np.flatnonzero(np.diff(bounds) > 0).tolist():  # equal sets go once
                    use[i] = (x := int(nodes[i])) not in seen
                    seen.add(x)
                pick = use[row] if len(row) else np.zeros(0, bool)
                if pick.any():
                    held.append((hashes[pick], nodes[row[pick]]))
                read += len(part.data)
                if read >= FLUSH_BYTES:
                    yield from flush()
                    read = 0
        yield from flush()

    return docs.select("text").mapInArrow(tx.releasing(run), _PACKED)


def _shared(buckets: int, buckets2: int):
    """Shingles of a bucket that several nodes have, repacked by node."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        nodes, tokens = [], []
        for r in table.select(["nodes", "counts", "tokens"]).to_batches():
            for a, b, c in zip(*[x.to_pylist() for x in r.columns]):
                nodes.append(_unpack_nodes(a, b))
                tokens.append(_join48(c))
        node, token = np.concatenate(nodes), np.concatenate(tokens)
        del nodes, tokens
        order = np.lexsort((node, token))
        node, token = node[order], token[order]
        del order
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (token[1:] != token[:-1])])
        node, token = node[new], token[new]
        head = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        holders = np.diff(np.append(head, len(token)))
        common = np.repeat(holders, holders)
        use = common > 1
        node, token, common = node[use], token[use], common[use]
        level = np.minimum(np.floor(8 * np.log2(common)), 255).astype(np.uint8)
        target = (tx.mix(node.view(np.uint64)) % np.uint64(buckets2)).astype(np.int64)
        order = np.lexsort((node, target))
        node, token, level, target = node[order], token[order], level[order], target[order]
        out = []
        for a, b in _buckets(target):
            first, counts = _runs(node[a:b])
            out.append((int(target[a]), node[a:b][first].tobytes(), counts, _cut48(token[a:b]), bucket, level[a:b].tobytes()))
        columns = list(zip(*out)) if out else [()] * 6
        types = [pa.int64(), *[pa.binary()] * 3, pa.int64(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], [*_PACKED_NAMES, "dealt", "levels"])

    return run


def _sizes(info: DataFrame, buckets2: int) -> DataFrame:
    """Set sizes by the bucket of their node, in the form of :func:`_shared` with sizes as tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size = (batch.column(i).to_numpy() for i in (0, 1))
            node, size = node[size > 0], size[size > 0]
            target = (tx.mix(node.view(np.uint64)) % np.uint64(buckets2)).astype(np.int64)
            order = np.argsort(target, kind="stable")
            node, size, target = node[order], size[order], target[order]
            for a, b in _buckets(target):
                row = [pa.array([x], pa.binary()) for x in (node[a:b].tobytes(), None, size[a:b].astype("<u4").tobytes())]
                yield pa.RecordBatch.from_arrays([pa.array([int(target[a])]), *row], _PACKED_NAMES)

    packed = info.select("node", "n").mapInArrow(tx.releasing(run), _PACKED)
    return packed.select("*", F.lit(None).cast("long").alias("dealt"), F.lit(None).cast("binary").alias("levels"))


SETS = "node long, n int, tokens binary, prefix int"


def _survivors(table: pa.Table) -> pa.Table:
    """Nodes whose shared shingles can make a link, rarest shingle first, and their prefix length."""
    nodes, tokens, levels, known, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)], [], []
    for r in table.to_batches():
        for a, b, c, bucket, e in zip(*[r.column(x).to_pylist() for x in (*_PACKED_NAMES[1:], "dealt", "levels")]):
            if b is None:
                known.append(np.frombuffer(a, np.int64))
                sizes.append(np.frombuffer(c, "<u4"))
                continue
            nodes.append(_unpack_nodes(a, b))
            tokens.append(_join48(c) | np.uint64(bucket % 65536))
            levels.append(np.frombuffer(e, np.uint8))
    node, token, level = [np.concatenate(x) for x in (nodes, tokens, levels)]
    if not len(node):
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.int32())], ["node", "n", "tokens", "prefix"])
    known, at = np.unique(np.concatenate(known), return_index=True)
    sizes = np.concatenate(sizes)[at].astype(np.int64)
    order = np.lexsort((token, level, node))
    node, token = node[order], token[order]
    head = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    count = np.diff(np.append(head, len(node)))
    n = sizes[np.searchsorted(known, node[head])]
    use = np.flatnonzero(5 * count >= 4 * n)
    prefix = n + (-4 * n // 5) + 1 - (n - count)
    return pa.table(
        [
            pa.array(node[head][use]), pa.array(n[use].astype(np.int32)),
            pa.array([token[a : a + c].tobytes() for a, c in zip(head[use].tolist(), count[use].tolist())], pa.binary()),
            pa.array(np.minimum(prefix, count)[use].astype(np.int32)),
        ],
        ["node", "n", "tokens", "prefix"],
    )


def _chain_links(sets: DataFrame, parts: int) -> DataFrame:
    """(a, b): neighbours on the lists of prefix shingles, as forests of the nodes."""
    names = ["part", "tokens", "nodes"]

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(t, np.uint64)[:p] for t, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            if not tokens:
                continue
            node = np.repeat(batch.column(0).to_numpy(), [len(t) for t in tokens])
            token = np.concatenate(tokens)
            target = (tx.mix(token) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(target, kind="stable")
            node, token, target = node[order], token[order], target[order]
            cuts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else []
            for a, b in zip(cuts, [*cuts[1:], len(target)]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(target[a])]), pa.array([token[a:b].tobytes()], pa.binary()), pa.array([node[a:b].tobytes()], pa.binary())], names
                )

    def chain(table: pa.Table) -> pa.Table:
        token = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()])
        node = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("nodes").to_pylist()])
        order = np.lexsort((node, token))
        token, node = token[order], node[order]
        same = token[1:] == token[:-1]
        pairs = np.unique(np.stack([node[:-1][same], node[1:][same]], axis=1), axis=0)
        tree = forest(list(map(tuple, pairs.tolist())))
        return pa.table([pa.array([x for x, _ in tree], pa.int64()), pa.array([y for _, y in tree], pa.int64())], ["a", "b"])

    packed = sets.select("node", "tokens", "prefix").mapInArrow(tx.releasing(lists), "part long, tokens binary, nodes binary")
    return packed.groupBy("part").applyInArrow(tx.releasing_group(chain), "a long, b long")


class Index:
    """Prefix lists of the sets joined so far, and the components they form."""

    def __init__(self, sizes: np.ndarray) -> None:
        self.sizes = sizes
        self.label = np.arange(len(sizes))
        self.lists: dict[int, dict[int, list[int]]] = {}

    def add(self, i: int, tokens: list[int], unique: int) -> None:
        for k, t in enumerate(tokens):
            self.lists.setdefault(t, {}).setdefault((unique + k) // POSITION_BLOCK, []).append(i)

    def unite(self, a: int, b: int) -> None:
        self.label[self.label == self.label[a]] = self.label[b]

    def nearest(self, tokens: list[int]) -> int | None:
        """The most recent set on the rarest list that has any."""
        for t in tokens:
            if t in self.lists:
                return max(block[-1] for block in self.lists[t].values())
        return None

    def candidates(self, i: int, tokens: list[int], unique: int) -> np.ndarray:
        """Sets beyond i's component that may link with it, by size and position."""
        n = int(self.sizes[i])
        found = np.zeros(len(self.sizes), bool)
        for k, t in enumerate(tokens):
            own = n - unique - k  # shingles of i from this one on
            for block, members in self.lists.get(t, {}).items():
                # Sizes ascend along a list: the last member is the largest of the block.
                largest = int(self.sizes[members[-1]])
                if 5 * largest < 4 * n or min(own, largest - block * POSITION_BLOCK) < needed(n, -(-4 * n // 5)):
                    continue
                found[members] = True
        found &= (5 * self.sizes >= 4 * n) & (self.label != self.label[i])
        return np.flatnonzero(found)


def join_sets(sizes: np.ndarray, tokens: list[np.ndarray], prefixes: np.ndarray, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (positions) that span the components of the sets; with ``side``, only links across it."""
    order = np.argsort(sizes, kind="stable")
    sizes, prefixes = sizes[order], prefixes[order]
    tokens = [tokens[i] for i in order]
    flat = [np.sort(t) for t in tokens]
    side = side[order] if side is not None else None
    index = Index(sizes)
    links = []

    def compare(i: int, j: int) -> bool:
        if side is not None and side[i] == side[j]:
            return False
        overlap = len(np.intersect1d(flat[i], flat[j], assume_unique=True))
        if not linked(overlap, int(sizes[i]), int(sizes[j])):
            return False
        links.append((int(order[i]), int(order[j])))
        index.unite(i, j)
        return True

    for i in range(len(sizes)):
        head = tokens[i][: prefixes[i]].tolist()
        unique = int(sizes[i]) - len(tokens[i])
        near = index.nearest(head)
        if near is not None:
            compare(i, near)
            left = index.candidates(i, head, unique)
            left = left[left != near][::-1]
            while len(left):
                j, left = int(left[0]), left[1:]
                if compare(i, j):
                    left = left[index.label[left] != index.label[i]]
        index.add(i, head, unique)
    return links


def _join_tiles(table: pa.Table) -> pa.Table:
    """Links of all candidate groups of a task, or of one tile of a large group."""
    groups: dict[tuple, list] = {}
    for r in table.to_batches():
        for row in zip(*[r.column(c).to_pylist() for c in ("grp", "lo", "hi", "salt", "node", "n", "tokens", "prefix")]):
            groups.setdefault(row[:3], []).append(row[3:])
    a, b = [], []
    for (_, lo, hi), rows in groups.items():
        rows.sort()
        salt, node, n, tokens, prefix = zip(*rows)
        sets = [np.frombuffer(t, np.uint64) for t in tokens]
        side = np.array(salt) if lo != hi else None
        for i, j in join_sets(np.array(n, np.int64), sets, np.array(prefix), side):
            a.append(node[i])
            b.append(node[j])
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def join_groups(sets: DataFrame, shingles: int, tile_shingles: int | None = None) -> DataFrame:
    """(a, b): links that span the components of ``sets``."""
    tile_shingles = tile_shingles or TILE_SHINGLES
    groups = components(_chain_links(sets, max(1, -(-shingles // BUCKET_SHINGLES))))
    # Groups are weighed and salted without their shingles, which travel to their nodes' places once.
    weighed = sets.select("node", (F.octet_length("tokens") / 8).alias("w")).join(groups, "node").withColumnRenamed("component", "grp")
    weights = weighed.groupBy("grp").agg(F.sum("w").alias("w"))
    # Groups above the size of a tile are salted in k parts and joined part by part.
    salts = weights.select("grp", F.greatest(F.lit(1), F.ceil(2 * F.col("w") / tile_shingles - 1)).cast("int").alias("k"))
    places = weighed.drop("w").join(salts, "grp").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    placed = sets.join(places, "node")
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")
    tiles = placed.select("*", other).withColumn("lo", F.least("salt", "other")).withColumn("hi", F.greatest("salt", "other"))
    tasks = max(1, -(-shingles // (tile_shingles // 4)))
    box = F.when(F.col("k") == 1, F.pmod(F.xxhash64("grp"), F.lit(tasks))).otherwise(F.xxhash64("grp", "lo", "hi"))
    columns = ("grp", "lo", "hi", "salt", "node", "n", "tokens", "prefix")
    return tiles.select(box.alias("box"), *columns).groupBy("box").applyInArrow(tx.releasing_group(_join_tiles), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, tile_shingles: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text), at a Jaccard of 0.8."""
    info = materialize(_describe(docs, shingle))
    total = info.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_SHINGLES))
    shared = _ship(docs, buckets, shingle).groupBy("bucket").applyInArrow(tx.releasing_group(_shared(buckets, buckets)), f"{_PACKED}, dealt long, levels binary")
    sets = materialize(shared.unionByName(_sizes(info, buckets)).groupBy("bucket").applyInArrow(tx.releasing_group(_survivors), SETS))
    held = sets.agg(F.sum(F.octet_length("tokens") / 8).cast("long")).first()[0] or 0
    links = join_groups(sets, held, tile_shingles)
    grouped = components(links)

    own = F.coalesce("doc_id", F.lit(tx.MAX_ID))
    reps = info.where("n > 0").groupBy("node").agg(F.min(own).alias("rep"))
    tops = grouped.join(reps, "node").groupBy("component").agg(F.min("rep").alias("top"))
    tops = grouped.join(tops, "component").select("node", "top")
    reps = reps.join(tops, "node", "left").select("node", F.coalesce("top", "rep").alias("top"))
    joined = info.join(reps, "node", "left")
    top = F.when(F.col("n") > 0, F.col("top")).otherwise(own)
    component = F.when(top == tx.MAX_ID, F.lit(None)).otherwise(top)
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document by the Jaccard similarity of five-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))

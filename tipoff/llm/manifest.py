"""Merkle manifest of a table by a butterfly exchange of subtree roots (op12).

A row's leaf is H over its fields in order, each ``-`` when null, else its UTF-8 byte count, ``:``
and its value (integers in decimal); H is the lowercase hex SHA-256 of its inputs joined, and
nodes join the hex text of their children. Within a group (here: a source) leaves ascend by id,
null first, equal ids by leaf. While more than one node is left, each aligned run of ``FANOUT``
nodes (the last one may be shorter, even one) becomes the H of its nodes; the node left at the end
is the group's root (a lone leaf is its own root). The roots of the groups, ordered by group key
(null first, then UTF-8 bytes), give the manifest's root the same way.

Spark plan: leaves are hashed in SQL and ranked by one range sort (a hot group spans many
partitions). Every aligned block of ``FANOUT ** BLOCK_LEVELS`` leaves of a group builds its own
subtree in one task, which also gives each leaf the siblings of its path inside the block. Then,
round by round, aligned groups of ``FANOUT`` blocks swap their current subtree roots: one row per
subtree root travels to the run it belongs to, every block fetches its run, hashes the parent
itself (the same parent is hashed by every block below it) and keeps the run's other members as
its proof at that level. After the last round every block holds the upper proof of its leaves and
the root, without a downward pass. The same code builds the tree over the groups' roots.

A proof is an array of (left, right): the hex text of the run's members before and after the
path's node at each level, from the leaf up to the manifest's root; folding a leaf through it
(H of left, node, right at each level) gives the root.

Edge cases: nulls in any field are ``-``; rows that repeat all fields give equal leaves in
adjacent places; a null id sorts first; very long texts are hashed whole; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tipoff.session import materialize

FANOUT = 16
BLOCK_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"
# Fixed: the letters tampering lower-cases.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and value."""
    value = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(*cols: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in cols]), 256)


def levels(n: Column) -> Column:
    """Levels of hashing above ``n`` nodes: 0 for one, else ceil(log_FANOUT n), counted exactly."""
    # FANOUT ** k >= n for the least k; integer powers avoid rounding of logarithms.
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(16)), F.lit(0), lambda acc, k: acc + F.when(F.pow(F.lit(FANOUT), k - 1) < n, 1).otherwise(0)
    )


def _levels_of(n: int) -> int:
    """Levels of hashing above ``n`` nodes: 0 for one, else ceil(log_FANOUT n)."""
    k = 0
    while FANOUT**k < n:
        k += 1
    return k


def positions(nodes: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``nodes`` with ``pos``: 0, 1, ... within each value of ``group`` (null first) in ``order``.

    One range sort over (group, order): a large group spans as many partitions as its rows need.
    Each task numbers the runs of equal group values in its sorted partition; the first run of a
    partition may continue one from earlier partitions, whose lengths the driver adds up from one
    summary row per partition. Nothing is joined on the group itself.
    """
    keys = [F.col(group).asc_nulls_first(), *order]
    ranked = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = StructType([*nodes.schema.fields, *StructType.fromDDL("_part int, _row long, _first boolean, _local long").fields])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        current, at, row, first = _NOTHING, 0, 0, True
        for batch in batches:
            rows, firsts, locals_ = [], [], []
            for value in batch.column(group).to_pylist():
                if current is _NOTHING or value != current:
                    first = current is _NOTHING
                    current, at = value, 0
                rows.append(row)
                firsts.append(first)
                locals_.append(at)
                at += 1
                row += 1
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * n, pa.int32()), pa.array(rows, pa.int64()), pa.array(firsts, pa.bool_()), pa.array(locals_, pa.int64())],
                schema=pa.schema([*batch.schema, pa.field("_part", pa.int32()), pa.field("_row", pa.int64()), pa.field("_first", pa.bool_()), pa.field("_local", pa.int64())]),
            )

    numbered = materialize(ranked.mapInArrow(number, schema))
    summary = (
        numbered.groupBy("_part")
        .agg(
            F.min_by(group, "_row").alias("first_group"),
            F.sum(F.col("_first").cast("long")).alias("first_run"),
            F.max_by(group, "_row").alias("last_group"),
            (F.max_by("_local", "_row") + 1).alias("last_run"),
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy("_part")
        .collect()
    )
    carries, run, last = [], 0, _NOTHING
    for r in summary:
        carry = run if last is not _NOTHING and r["first_group"] == last else 0
        carries.append((r["_part"], carry))
        run = carry + r["n"] if r["first_run"] == r["n"] else r["last_run"]
        last = r["last_group"]
    spark = numbered.sparkSession
    offsets = spark.createDataFrame(carries or [(0, 0)], "_part int, _carry long")
    placed = numbered.join(F.broadcast(offsets), "_part")
    pos = F.col("_local") + F.when(F.col("_first"), F.col("_carry")).otherwise(F.lit(0))
    return placed.withColumn("pos", pos).drop("_part", "_row", "_first", "_local", "_carry")


_NOTHING = object()


def _block_depth(block: int, count: int, block_levels: int) -> int:
    """Levels hashed inside a block: a group of one block is hashed down to one node."""
    return _levels_of(count) if block == 0 and count <= FANOUT**block_levels else block_levels


def _levels(hashes: list[str], depth: int) -> list[list[str]]:
    out = [hashes]
    for _ in range(depth):
        level = out[-1]
        out.append([_h("".join(level[j : j + FANOUT])) for j in range(0, len(level), FANOUT)])
    return out


def _block_roots(block_levels: int, group: str):
    def run(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", kind="stable")
        depth = _block_depth(int(keys[1]), len(rows), block_levels)
        root = _levels(rows["hash"].tolist(), depth)[-1][0]
        return pd.DataFrame({group: [keys[0]], "block": [int(keys[1])], "hash": [root]})

    return run


def _block_proofs(block_levels: int, group: str, key: str | None):
    """Every node's proof inside its block followed by the block's upper proof, and digests."""

    def run(keys: tuple, rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", kind="stable")
        hashes = rows["hash"].tolist()
        depth = _block_depth(int(keys[1]), len(rows), block_levels)
        levels = _levels(hashes, depth)
        above = list(upper["upper"].iloc[0]) if len(upper) else []
        steps = [(s["left"], s["right"]) for s in above]
        subroot, root = upper["subroot"].iloc[0], upper["root"].iloc[0]
        index = [p % FANOUT**block_levels for p in rows["pos"].tolist()]
        checks = rows["check"].tolist() if "check" in rows else hashes
        out = []
        for k, i in enumerate(index):
            path = []
            for level in levels[:-1]:
                run_at = i // FANOUT * FANOUT
                path.append(("".join(level[run_at:i]), "".join(level[i + 1 : run_at + FANOUT])))
                i //= FANOUT
            path += steps
            node = checks[k] if checks[k] is not None else hashes[k]
            for left, right in path:
                node = _h(left + node + right)
            digest = hashlib.sha256("".join(left + right for left, right in path).encode()).hexdigest()
            out.append((path, digest, node))
        result = pd.DataFrame({group: [keys[0]] * len(out), "pos": rows["pos"].to_numpy()})
        if key:
            result[key] = rows[key].to_numpy()
        result["hash"] = hashes
        result["subroot"] = subroot
        result["root"] = root
        result["proof"] = [[{"left": a, "right": b} for a, b in o[0]] for o in out]
        result["proof_sha256"] = [o[1] for o in out]
        result["folded_root"] = [o[2] for o in out]
        return result

    return run


def tree(placed: DataFrame, group: str, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per block of ``placed`` (group, pos, hash): its group's root and the block's upper proof.

    Blocks hash their own subtrees (pass one, one row out per block); then the blocks exchange
    subtree roots round by round until each knows the siblings above it and its group's root.
    """
    block = F.floor(F.col("pos") / FANOUT**block_levels).cast("long")
    kind = placed.schema[group].dataType.simpleString()
    roots = (
        placed.select(group, block.alias("block"), "pos", "hash")
        .groupBy(group, "block")
        .applyInPandas(_block_roots(block_levels, group), f"{group} {kind}, block long, hash string")
    )
    blocks = materialize(roots)
    per_group = blocks.groupBy(group).agg(F.count(F.lit(1)).alias("_blocks")).withColumn("_rounds", levels(F.col("_blocks")))
    blocks = materialize(_null_safe_join(blocks, per_group.drop("_blocks"), [group]).withColumn("upper", F.array().cast(PROOF)))
    rounds = max([r[0] or 0 for r in per_group.agg(F.max("_rounds")).collect()] + [0])
    for r in range(1, rounds + 1):
        blocks = materialize(_swap(blocks, group, r))
    return blocks.select(group, "block", F.col("hash").alias("subroot"), "upper")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    return left.join(right, [left[k].eqNullSafe(right[f"_r_{k}"]) for k in keys], how).drop(*[f"_r_{k}" for k in keys])


def _swap(blocks: DataFrame, group: str, r: int) -> DataFrame:
    """One round: aligned runs of FANOUT subtree roots are exchanged, each block hashes its parent."""
    span = FANOUT ** (r - 1)
    active = F.col("_rounds") >= r
    node = F.floor(F.col("block") / span).cast("long")
    senders = blocks.where(active & (F.col("block") % span == 0)).select(group, node.alias("node"), "hash")
    runs = senders.groupBy(group, F.floor(F.col("node") / FANOUT).cast("long").alias("run")).agg(
        F.array_sort(F.collect_list(F.struct("node", "hash"))).alias("members")
    )
    mine = blocks.withColumn("_node", node).withColumn("_run", F.floor(F.col("_node") / FANOUT).cast("long"))
    runs = runs.withColumnRenamed(group, f"_r_{group}")
    on = [mine[group].eqNullSafe(runs[f"_r_{group}"]), mine["_run"] == runs["run"], active]
    joined = mine.join(runs, on, "left")
    before = F.array_join(F.transform(F.filter("members", lambda m: m["node"] < F.col("_node")), lambda m: m["hash"]), "")
    after = F.array_join(F.transform(F.filter("members", lambda m: m["node"] > F.col("_node")), lambda m: m["hash"]), "")
    every = F.array_join(F.transform("members", lambda m: m["hash"]), "")
    step = F.array(F.struct(before.alias("left"), after.alias("right")))
    return joined.select(
        group,
        "block",
        F.when(active, F.sha2(every, 256)).otherwise(F.col("hash")).alias("hash"),
        "_rounds",
        F.when(active, F.concat("upper", step)).otherwise(F.col("upper")).alias("upper"),
    )


def fold(start: Column, proof: Column) -> Column:
    """The root a node gives through its proof."""
    return F.aggregate(proof, start, lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))


def manifest(
    docs: DataFrame, group: str = "source", key: str = "doc_id", check: Column | None = None, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """Leaf, group root (``subroot``), root, proof digest and folded root of every row of ``docs``.

    ``check`` is a second leaf per row (null: the leaf itself), folded through the row's proof
    into ``folded_root``. Texts are read once, for the leaves; key, group and the two leaves go
    on. Proofs stay inside the task of their block: only their digests leave it.
    """
    rows = docs.select(key, group, leaf(*[F.col(c) for c in FIELDS]).alias("hash"), (check if check is not None else F.lit(None).cast("string")).alias("check"))
    placed = materialize(positions(rows, group, [F.col(key).asc_nulls_first(), F.col("hash")]))
    blocks = tree(placed, group, block_levels)
    # The tree over the groups' roots: one node per group, in one group of its own.
    subroots = blocks.groupBy(group).agg(F.first("subroot").alias("hash")).withColumn("_tree", F.lit(""))
    top_nodes = materialize(positions(subroots, "_tree", [F.col(group).asc_nulls_first()]))
    top_blocks = tree(top_nodes.select("_tree", "pos", "hash"), "_tree", block_levels)
    top_blocks = top_blocks.withColumn("root", F.col("subroot"))
    top = (
        _cogroup(top_nodes.select("_tree", "pos", "hash", group), top_blocks, "_tree", group, block_levels)
        .select(group, F.col("proof").alias("top"), "root")
    )
    full = _null_safe_join(blocks, top, [group]).select(group, "block", "subroot", "root", F.concat("upper", "top").alias("upper"))
    done = _cogroup(placed, full, group, key, block_levels)
    return done.select(key, group, F.col("hash").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root")


def _cogroup(placed: DataFrame, blocks: DataFrame, group: str, key: str, block_levels: int) -> DataFrame:
    """Nodes of each block beside the block's upper proof, group root and root."""
    kind = placed.schema[group].dataType.simpleString()
    key_kind = placed.schema[key].dataType.simpleString()
    schema = f"{group} {kind}, pos long, {key} {key_kind}, hash string, subroot string, root string, proof {PROOF}, proof_sha256 string, folded_root string"
    block = F.floor(F.col("pos") / FANOUT**block_levels).cast("long")
    cols = [group, block.alias("block"), "pos", key, "hash"] + (["check"] if "check" in placed.columns else [])
    nodes = placed.select(*cols)
    return nodes.groupBy(group, "block").cogroup(blocks.groupBy(group, "block")).applyInPandas(_block_proofs(block_levels, group, key), schema)


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Manifest of ``documents``; rows whose crc32(doc_id) divides by 5 are checked with lower-cased text."""
    return checked(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))


def checked(docs: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Digests of the manifest of ``docs`` and the roots its tampered leaves fold to.

    Tampering lower-cases A-Z of the text where 5 divides the unsigned crc32 of the decimal id;
    a null id or text is never tampered.
    """
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    changed = leaf(*[F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS])
    built = manifest(docs, check=F.when(tampered, changed), block_levels=block_levels)
    return built.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root").withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )

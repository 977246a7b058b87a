"""Near-duplicate vectors by an epsilon grid order join.

Equal vectors are one class. Classes are laid on a grid whose cells are as wide as the largest
distance two linked unit vectors can have, along the leading principal directions (fitted on
at most ``SAMPLE_ROWS`` vectors; any directions give the same result). Sorted by cells, the
sequence is cut into blocks and blocks into intervals, each with its bounding box. The join
starts from the whole sequence and descends: a pair of intervals whose boxes are provably too
far apart is skipped, others split into the pairs of their parts. Pairs of the lowest
intervals are compared block by block in double precision. What leaves a task are link counts
per class and a spanning forest of its links, never the links themselves.

Edge cases: null vectors, zero vectors and those with null or non-finite components link with
nothing, nor do vectors of different lengths; equal vectors link; a null id takes part and sorts
behind all others; repeated ids are vectors of their own that share a component; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tipoff.llm.components import components, forest
from tipoff.llm.text import MAX_ID
from tipoff.session import materialize

COSINE = 0.9
SAMPLE_ROWS = 4096
GRID_DIMS = 4
BOX_DIMS = 16
BLOCK = 512
FAN_OUT = 8


def directions(sample: np.ndarray) -> np.ndarray:
    """Principal directions of unit vectors, strongest first, as columns."""
    centred = sample - sample.mean(axis=0)
    _, vectors = np.linalg.eigh(centred.T @ centred)
    return vectors[:, ::-1]


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows over a power of two near their largest component: no overflow, same cosines."""
    return x / np.exp2(np.floor(np.log2(np.abs(x).max(axis=1))))[:, None]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vectors with their class key, and one row per class of equal usable vectors."""
    v = F.col("v")
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(usable & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.withColumn("usable", usable)
    plain = F.transform(v, lambda x: x + 0.0)  # -0.0 and 0.0 are the same component
    rows = rows.withColumn("k1", F.when(F.col("usable"), F.xxhash64(plain)))
    rows = rows.withColumn("k2", F.when(F.col("usable"), F.xxhash64(F.lit(17), F.col("k1"), F.reverse(plain))))
    classes = (
        rows.where("usable")
        .groupBy("k1", "k2")
        .agg(
            F.min(F.coalesce("vec_id", F.lit(MAX_ID))).alias("rep"),
            F.count(F.lit(1)).alias("n"),
            F.first("v").alias("v"),
        )
    )
    return rows, classes


def _blocks(classes: DataFrame, turn: np.ndarray, epsilon: float) -> DataFrame:
    """Classes in grid order, cut into blocks with boxes; ``part`` and ``place`` give the sequence."""
    width = len(turn)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(2).to_pylist():
                x = _scaled(np.array([v], float))
                x = x / np.linalg.norm(x)
                y = (x @ turn if x.shape[1] == width else x)[0, :GRID_DIMS]
                out.append([x.shape[1], *np.floor(y / epsilon).astype(int).tolist(), *[0] * (GRID_DIMS - len(y))])
            columns = [pa.array(c, pa.int32()) for c in zip(*out)] if out else [pa.array([], pa.int32())] * (GRID_DIMS + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["rep", "n", "v", *names])

    names = ["dim", *[f"c{i}" for i in range(GRID_DIMS)]]
    schema = "rep long, n long, v array<double>, " + ", ".join(f"{c} int" for c in names)
    placed = classes.select("rep", "n", "v").mapInArrow(cells, schema)
    placed = placed.repartitionByRange(*names, "rep").sortWithinPartitions(*names, "rep")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        ids, counts, vectors, dim = [], [], [], None

        def block():
            nonlocal place, ids, counts, vectors
            x = _scaled(np.array(vectors, float))
            unit = x / np.linalg.norm(x, axis=1)[:, None]
            y = (unit @ turn if dim == width else unit)[:, :BOX_DIMS]
            row = [[part], [place], [dim], [len(ids)], [y.min(axis=0).tolist()], [y.max(axis=0).tolist()]]
            row += [[np.array(ids, np.int64).tobytes()], [np.array(counts, np.int64).tobytes()], [x.tobytes()]]
            place += 1
            ids, counts, vectors = [], [], []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, block_types)], block_names)

        for batch in batches:
            for rep, n, v in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if ids and (len(ids) == BLOCK or len(v) != dim):
                    yield block()
                dim = len(v)
                ids.append(rep)
                counts.append(n)
                vectors.append(v)
        if ids:
            yield block()

    block_names = ["part", "place", "dim", "size", "lo", "hi", "ids", "counts", "x"]
    floats = pa.list_(pa.float64())
    block_types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), floats, floats, *[pa.binary()] * 3]
    block_schema = (
        "part int, place long, dim int, size int, lo array<double>, hi array<double>, "
        "ids binary, counts binary, x binary"
    )
    return placed.mapInArrow(cut, block_schema)


def _union_box(df: DataFrame, *keys: str) -> DataFrame:
    """Boxes around the boxes of each group, component by component."""

    def fold(name: str, pick):
        return F.aggregate(
            F.collect_list(name),
            F.element_at(F.collect_list(name), 1),
            lambda a, b: F.zip_with(a, b, lambda x, y: pick(x, y)),
        ).alias(name)

    return df.groupBy(*keys).agg(fold("lo", F.least), fold("hi", F.greatest))


def _near(epsilon: float):
    """Condition: the boxes of two sides can hold vectors within epsilon."""
    gap = F.zip_with(
        F.zip_with("lo_a", "hi_b", lambda x, y: x - y),
        F.zip_with("lo_b", "hi_a", lambda x, y: x - y),
        lambda p, q: F.greatest(p, q, F.lit(0.0)),
    )
    return F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g) <= epsilon * epsilon


def _side(df: DataFrame, side: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{c}_{side}") for c in df.columns])


def _interval_pairs(blocks: DataFrame, epsilon: float) -> tuple[DataFrame, DataFrame]:
    """Numbered blocks, and pairs (id_a, id_b) of the lowest intervals that may hold links,
    found from the top down."""
    sizes = blocks.groupBy("part").agg(F.count(F.lit(1)).alias("m"))
    before = F.coalesce(F.sum("m").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per partition of the sort, not of the data.
    starts = sizes.withColumn("start", before).drop("m")
    numbered = blocks.join(F.broadcast(starts), "part").withColumn("seq", F.col("start") + F.col("place"))
    numbered = materialize(numbered.withColumn("interval", F.floor(F.col("seq") / FAN_OUT)))
    levels = [_union_box(numbered.select("dim", "interval", "lo", "hi"), "dim", "interval").withColumnRenamed("interval", "id")]
    count = numbered.agg(F.max("interval")).first()[0] + 1
    while count > FAN_OUT:
        parent = levels[-1].withColumn("id", F.floor(F.col("id") / FAN_OUT))
        levels.append(materialize(_union_box(parent, "dim", "id")))
        count = -(-count // FAN_OUT)
    top = levels[-1]  # at most FAN_OUT intervals per vector length
    pairs = _side(top, "a").join(_side(top, "b"), (F.col("dim_a") == F.col("dim_b")) & (F.col("id_a") <= F.col("id_b")))
    pairs = pairs.where(_near(epsilon)).select(F.col("dim_a").alias("dim"), "id_a", "id_b")
    for level in reversed(levels[:-1]):
        child = level.withColumn("up", F.floor(F.col("id") / FAN_OUT))
        left = pairs.withColumnsRenamed({"id_a": "up_a", "id_b": "up_b", "dim": "dim_a"})
        pairs = left.join(_side(child, "a"), ["dim_a", "up_a"])
        pairs = pairs.withColumn("dim_b", F.col("dim_a")).join(_side(child, "b"), ["dim_b", "up_b"])
        pairs = pairs.where((F.col("id_a") <= F.col("id_b")) & _near(epsilon))
        pairs = pairs.select(F.col("dim_a").alias("dim"), "id_a", "id_b")
    return numbered, materialize(pairs)


_FOUND = "kind int, a long, b long"


def _compare(cosine: float, epsilon: float):
    """Compares the blocks of two intervals; yields link counts (kind 0) and forest links (kind 1)."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        blocks = []
        for r in rows:
            x = np.frombuffer(r["x"], float).reshape(r["size"], -1)
            ids = np.frombuffer(r["ids"], np.int64)
            counts = np.frombuffer(r["counts"], np.int64)
            blocks.append((r["side"], r["seq"], x, np.linalg.norm(x, axis=1), ids, counts, np.array(r["lo"]), np.array(r["hi"])))
        blocks.sort(key=lambda b: (b[0], b[1]))
        own = rows[0]["id_a"] == rows[0]["id_b"]
        left = [b for b in blocks if b[0] == 0]
        right = left if own else [b for b in blocks if b[0] == 1]
        links: dict[int, int] = {}
        edges: list[tuple[int, int]] = []

        def add(ids: np.ndarray, sums: np.ndarray) -> None:
            for i in np.flatnonzero(sums):
                links[int(ids[i])] = links.get(int(ids[i]), 0) + int(sums[i])

        for p in left:
            for q in right:
                if own and q[1] < p[1]:
                    continue
                gap = np.maximum(np.maximum(p[6] - q[7], q[6] - p[7]), 0)
                if gap @ gap > epsilon * epsilon:
                    continue
                hit = (p[2] @ q[2].T) / (p[3][:, None] * q[3][None, :]) >= cosine
                if own and p[1] == q[1]:
                    np.fill_diagonal(hit, False)
                    add(p[4], hit @ q[5])
                else:
                    add(p[4], hit @ q[5])
                    add(q[4], p[5] @ hit)
                i, j = np.nonzero(hit)
                if len(i):
                    edges.extend(zip(p[4][i].tolist(), q[4][j].tolist()))
                    if len(edges) > 200_000:
                        edges[:] = forest(edges)
        tree = forest(edges)
        kinds = [0] * len(links) + [1] * len(tree)
        a = [*links, *[x for x, _ in tree]]
        b = [*links.values(), *[y for _, y in tree]]
        return pa.table([pa.array(kinds, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "a", "b"])

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding)."""
    # Unit vectors with that cosine are this far apart; the margin covers rounding.
    epsilon = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    rows, classes = _classes(vectors)
    rows = materialize(rows.drop("v"))
    classes = materialize(classes)
    sample = classes.orderBy("k1").limit(SAMPLE_ROWS).select("v").collect()
    alone = rows.select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if not sample:
        return alone
    width = max((len(r.v) for r in sample), key=[len(r.v) for r in sample].count)
    x = _scaled(np.array([r.v for r in sample if len(r.v) == width], float))
    turn = directions(x / np.linalg.norm(x, axis=1)[:, None])

    numbered, pairs = _interval_pairs(materialize(_blocks(classes, turn, epsilon)), epsilon)
    payload = numbered.select(F.col("interval").alias("id"), "dim", "seq", "size", "lo", "hi", "ids", "counts", "x")
    sides = pairs.select("dim", F.col("id_a").alias("id"), "id_a", "id_b", F.lit(0).alias("side")).unionByName(
        pairs.where("id_a < id_b").select("dim", F.col("id_b").alias("id"), "id_a", "id_b", F.lit(1).alias("side"))
    )
    tiles = sides.join(payload, ["dim", "id"])
    found = materialize(tiles.groupBy("dim", "id_a", "id_b").applyInArrow(_compare(cosine, epsilon), _FOUND))

    counts = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("others"))
    grouped = components(found.where("kind = 1").select("a", "b"))
    whole = classes.select("k1", "k2", "rep", "n").join(counts, "rep", "left")
    whole = whole.join(grouped.withColumnRenamed("node", "rep"), "rep", "left")
    whole = whole.select(
        "k1", "k2", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "rep").alias("top")
    )
    joined = rows.join(whole, ["k1", "k2"], "left")
    top = F.coalesce("top", "vec_id")
    top = F.when(top == MAX_ID, F.lit(None)).otherwise(top)
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        top.alias("component_id"),
        F.coalesce(F.col("vec_id") == top, F.col("vec_id").isNull() & top.isNull()).alias("kept"),
    )


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link counts and components of all ``embeddings``."""
    return near_duplicates(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))

"""Connected components of a link table, by rounds of joins on written tables.

Every round points the larger neighbours of a node, then its smaller ones, at the smallest
(large-star and small-star). Partial spanning forests inside each partition shrink the links
first. Links are written between rounds: lineage stays short and nothing is held by executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tipoff.llm.text import releasing
from tipoff.session import materialize


def forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node of its tree) for every node of the links that is not the smallest."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            low, high = (a, b) if a < b else (b, a)
            parent[high] = low
    return [(x, find(x)) for x in list(parent)]


# Links a task holds while it reduces them to a forest.
FOREST_LINKS = 500_000


def _shrink(links: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if len(held) >= FOREST_LINKS:
                small = forest(held)
                if len(small) > FOREST_LINKS // 2:
                    yield _links(small)
                    small = []
                held = small
        if held:
            yield _links(forest(held))

    return links.mapInArrow(releasing(run), "a long, b long")


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns): the smallest reachable node.

    Null ends and links of a node to itself are ignored. An empty table gives an empty one.
    """
    a, b = links.columns
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = materialize(_shrink(pairs))
    while True:
        # Large star: a node's larger neighbours move to the smallest of itself and all neighbours.
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).distinct()
        edges = materialize(small)
        # Done when every node has one link and no link's lower end is the upper end of another.
        roots = edges.select(F.col("b").alias("a")).distinct()
        open_nodes = edges.join(roots, "a", "left_semi").limit(1).count()
        repeated = edges.groupBy("a").count().where("count > 1").limit(1).count()
        if not open_nodes and not repeated:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(tops)

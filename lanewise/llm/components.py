"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.common import written
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hand every larger neighbour of a node the smallest node around."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hand a node and its smaller neighbours the smallest of these."""
    low = _smallest(edges)
    rest = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(low.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a batch as stars around its smallest nodes: shortens the paths between tasks."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            u, v = root(u), root(v)
            parent[max(u, v)] = min(u, v)
        stars = [(x, root(x)) for x in list(parent) if root(x) != x]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s[k] for s in stars], pa.int64()) for k in (0, 1)], names=["u", "v"]
        )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node reachable, for every node of a link to another node.

    Each round is written, so a lost executor repeats one round; rounds grow
    with the logarithm of the longest path. Stars are joined, never gathered.
    """
    ordered = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    edges = written(ordered.mapInArrow(_local_stars, "u long, v long").distinct(), "links")
    before, now = None, _state(edges)
    while now != before and now[0]:
        edges = written(_small_star(_large_star(edges)), "stars")
        before, now = now, _state(edges)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )

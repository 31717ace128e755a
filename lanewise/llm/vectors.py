"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them.

1. Equal vectors of one label become one row with its number of copies.
2. Centroids are fitted per label on a bounded sample; labels get cells in
   proportion to their vectors. Every vector is at home in the cell of its nearest
   centroid and visits the cells it lies close to the border of: with ``margin`` 1, the
   default, it visits every cell in which a linked vector can be at home, so that no
   link is lost; less margin prunes harder and loses links.
3. Homes and visitors of a cell are dealt over blocks; each pair of blocks is one
   matrix product. A home vector meets all its links in its own cell, so links are
   counted there once. Of the links themselves a task emits a spanning forest only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.llm.common import written
from lanewise.llm.components import components
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)


@dataclass(frozen=True)
class Cells:
    similarity: float = 0.93
    size: int = 400  # vectors of a cell, as a mean
    cells: int = 4096  # at most, over all labels: what is sent to every executor
    sample: int = 65536  # vectors the centroids are fitted on, at most
    rounds: int = 8
    margin: float = 1.0  # below 1 links are lost
    block: int = 2048
    seed: int = 7


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    _, size = np.frexp(np.abs(rows).max(axis=1, keepdims=True, initial=0))
    rows = np.ldexp(rows, -size)  # exact, so that squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit rows, in double precision, of a column of vectors of one length."""
    flat = pa.compute.list_flatten(column)
    flat = flat.to_numpy() if isinstance(flat, pa.ChunkedArray) else flat.to_numpy(zero_copy_only=False)
    return unit(flat.reshape(len(column), -1))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Unit centroids; a centroid that loses all its vectors moves to the worst-served one."""
    centroids = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near, best = _nearest(x, centroids)
        order = np.argsort(near, kind="stable")
        starts = np.searchsorted(near[order], np.arange(k))
        sums = np.add.reduceat(x[order], np.minimum(starts, len(x) - 1), axis=0)
        empty = np.bincount(near, minlength=k) == 0
        worst = np.argsort(best, kind="stable")[: int(empty.sum())]
        sums[empty] = x[worst]
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centroids)
    return centroids


def _nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    near, best = np.empty(len(x), np.int64), np.empty(len(x))
    step = max(1, (1 << 22) // len(centroids))
    for at in range(0, len(x), step):
        dots = x[at : at + step] @ centroids.T
        near[at : at + step] = dots.argmax(axis=1)
        best[at : at + step] = dots.max(axis=1)
    return near, best


def fit(classes: DataFrame, cells: Cells) -> dict[tuple[str, int], np.ndarray]:
    """Centroids by (label, dimensions). The sample is bounded and chosen by hash, alike in every layout."""
    counts = {
        (r["label"], r["dims"]): r["count"]
        for r in classes.groupBy("label", "dims").count().where(F.col("count") > cells.size).orderBy(F.desc("count")).limit(cells.cells // 2).collect()
    }
    total = sum(counts.values())
    if not total:
        return {}
    size = max(cells.size, -(-total // (cells.cells // 2)))
    share = min(1.0, cells.sample / total)
    picked = (
        classes.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
        .select("id", "label", "dims", "vector")
        .orderBy(F.xxhash64("id"), "id")
        .limit(2 * cells.sample)
        .toArrow()
        .sort_by("id")
    )
    label, dims = picked.column("label").to_pylist(), picked.column("dims").to_pylist()
    rows: dict[tuple[int, int], list[int]] = {}
    for i, key in enumerate(zip(label, dims)):
        if key in counts:
            rows.setdefault(key, []).append(i)
    vectors = picked.column("vector")
    out = {}
    for key in sorted(rows):
        x = matrix(vectors.take(pa.array(rows[key])))
        k = min(-(-counts[key] // size), len(x))
        if k > 1:
            out[key] = spherical_kmeans(x, k, cells.rounds, np.random.default_rng(cells.seed))
    return out


def deal(classes: DataFrame, centroids: dict, cells: Cells) -> DataFrame:
    """Each vector at home in one cell and visiting others: label, dims, cell, home, id, copies, vector."""
    sent = classes.sparkSession.sparkContext.broadcast(centroids)
    reach = np.sqrt(2 - 2 * cells.similarity) * cells.margin

    kind = classes.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders: dict[tuple[str, int], np.ndarray] = {}

        def met(key, part):
            """Row, cell and whether at home; products are made some rows at a time."""
            near = sent.value.get(key)
            if near is None:
                yield np.arange(len(part)), np.zeros(len(part), np.int32), np.ones(len(part), bool)
                return
            if key not in borders:
                borders.clear()
                borders[key] = np.sqrt(np.maximum(0, 2 - 2 * (near @ near.T))) * reach + 1e-7  # the root is exact to 1e-8
            apart = borders[key]
            step = max(1, (1 << 20) // len(near))
            for at in range(0, len(part), step):
                dots = matrix(part.column("vector").slice(at, step)) @ near.T
                best = dots.argmax(axis=1)
                short = dots[np.arange(len(dots)), best][:, None] - dots
                row, cell = np.nonzero(short <= apart[best])
                yield at + row, cell, cell == best[row]

        for batch in batches:
            keys = list(zip(batch.column("label").to_pylist(), batch.column("dims").to_pylist()))
            by_key: dict[tuple[str, int], list[int]] = {}
            for i, key in enumerate(keys):
                by_key.setdefault(key, []).append(i)
            for key, at in by_key.items():
                part = batch.take(pa.array(at))
                for row, cell, home in met(key, part):
                    picked = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(picked.column(c) for c in ("label", "dims", "id", "copies", "vector")),
                            pa.array(cell.astype(np.int32)),
                            pa.array(home),
                        ],
                        names=["label", "dims", "id", "copies", "vector", "cell", "home"],
                    )

    return classes.select("id", "label", "dims", "copies", "vector").mapInArrow(
        run, f"label string, dims int, id long, copies long, vector {kind}, cell int, home boolean"
    )


def compare(dealt: DataFrame, cells: Cells) -> DataFrame:
    """id, links (rows linked with a copy of it, without its own copies), root: a vector it is connected to."""
    key = ["label", "dims", "cell"]
    sizes = dealt.groupBy(*key).agg(
        F.sum(F.col("home").cast("long")).alias("homes"), F.count("*").alias("all")
    )
    sizes = sizes.where("homes > 0").select(
        *key,
        F.ceil(F.col("homes") / cells.block).cast("int").alias("h"),
        F.ceil(F.col("all") / cells.block).cast("int").alias("v"),
    )
    rows = dealt.join(sizes, key)
    own_h = F.pmod(F.xxhash64("id"), "h").cast("int")
    own_v = F.pmod(F.xxhash64("id"), "v").cast("int")
    columns = [*key, "i", "j", "meets", "id", "copies", "vector"]
    homes = (
        rows.where("home")
        .withColumn("i", own_h)
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("v") - 1)))
        .withColumn("meets", F.lit(False))
    )
    visitors = (
        rows.withColumn("j", own_v)
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("h") - 1)))
        .withColumn("meets", F.lit(True))
    )
    least = cells.similarity

    def run(group: pa.Table) -> pa.Table:
        meets = group.column("meets").to_numpy()
        ids, copies = group.column("id").to_numpy(), group.column("copies").to_numpy()
        x = matrix(group.column("vector"))
        h, v = np.flatnonzero(~meets), np.flatnonzero(meets)
        linked = x[h] @ x[v].T >= least
        linked &= ids[h][:, None] != ids[v][None, :]
        count = linked @ copies[v]
        some = np.flatnonzero(linked.any(axis=1))
        a, root = _forest(linked, ids[h], ids[v], some)
        return pa.table(
            {
                "id": pa.array([*ids[h][some], *a], pa.int64()),
                "links": pa.array([*count[some], *[0] * len(a)], pa.int64()),
                "root": pa.array([*ids[h][some], *root], pa.int64()),
            }
        )

    met = homes.select(columns).unionByName(visitors.select(columns))
    return met.groupBy(*key, "i", "j").applyInArrow(run, "id long, links long, root long")


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray, rows: np.ndarray):
    """For each connected part of a block: its vectors, each with one of them."""
    a, root = [], []
    open_rows = np.zeros(len(left), bool)
    open_rows[rows] = True
    open_columns = linked.any(axis=0)
    for r in rows.tolist():
        if not open_rows[r]:
            continue
        open_rows[r] = False
        front = np.array([r])
        while len(front):
            columns = np.flatnonzero(linked[front].any(axis=0) & open_columns)
            open_columns[columns] = False
            a += right[columns].tolist()
            root += [int(left[r])] * len(columns)
            front = np.flatnonzero(linked[:, columns].any(axis=1) & open_rows)
            open_rows[front] = False
            a += left[front].tolist()
            root += [int(left[r])] * len(front)
    return a, root


def near_duplicates(
    table: DataFrame,
    cells: Cells = Cells(),
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per input row: the id, n_links, component_id and kept.

    Vectors are compared within equal labels only. Rows with a null id, label or
    vector, and vectors that are empty, zero or hold null or non-finite numbers,
    link with nothing and are kept; so is every vector of another length than all
    others. Repeated rows count as different vectors with the same content. Labels of
    any type are compared as text, doubles stay doubles. Other columns are ignored; an
    empty table gives an empty one.
    """
    v = F.col("vector")
    single = table.schema[vector].dataType.elementType == T.FloatType()
    rows = table.select(
        F.col(id).alias("id"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<float>" if single else "array<double>").alias("vector"),
    )
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit_for = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & v.isNotNull()
        & (F.size(v) > 0)
        & F.coalesce(~bad, F.lit(False))
        & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    )
    keyed = rows.withColumn("fit", fit_for).withColumn(
        "key", F.struct(F.xxhash64("label", "vector").alias("x"), F.xxhash64("vector", "label").alias("y"))
    )
    good = keyed.where("fit")
    classes = written(
        good.groupBy("key", "label")
        .agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        .withColumn("dims", F.size("vector")),
        "vectors",
    )
    dealt = written(deal(classes, fit(classes, cells), cells), "cells")
    met = written(compare(dealt, cells), "met")
    known = components(met.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    counted = met.groupBy("id").agg(F.sum("links").alias("links"))
    per_class = (
        classes.select("key", "id", "copies")
        .join(counted, "id", "left")
        .join(known.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    linked = good.select("id", "key").join(per_class, "key").select("id", "n_links", "component_id")
    alone = keyed.where(~F.col("fit")).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.union(alone).select(
        F.col("id").alias(id),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )

"""Exact nearest vectors by cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewise.session import ship_with_tasks
from lanewise.sources.tables import require

ship_with_tasks(__name__)

QUERY_BATCH = 32_768  # queries a task holds at most
QUERY_BLOCK = 512  # queries of one matrix product
DECIMALS = 12  # copies of a vector must tie, wherever they lie in a batch


def centroids(vectors: DataFrame, label: str, vec: str) -> DataFrame:
    """Mean vector per label: component sums combine on the map side."""
    require(vectors, label, vec)
    parts = vectors.select(label, F.posexplode(vec).alias("_i", "_x"))
    means = parts.groupBy(label, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    # one element per dimension, however many vectors there are
    gathered = means.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("_i", "_m"))).alias(vec))
    return gathered.select(F.col(label).alias("query_id"), F.col(f"{vec}._m").alias(vec))


def cosine_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    vec_id: str = "vec_id",
    vec: str = "embedding",
    batch: int = QUERY_BATCH,
) -> DataFrame:
    """The ``k`` most similar vectors of each query (``query_id``, ``vec``), exactly.

    Up to ``batch`` queries are sent to the tasks, which scan the vectors once where they
    lie. More stay a table: they are dealt over blocks of at most ``batch``, and every
    vector is shuffled once to each block. Either way a task multiplies Arrow batches of
    vectors with the queries it holds and passes on its best ``k`` of each; the final
    ranking sees tasks x queries x k rows, never all scores. Null vectors and queries
    give no row, nor do vectors of length zero.
    """
    require(vectors, vec_id, vec)
    kinds = dict(vectors.dtypes) | dict(queries.dtypes)
    schema = f"query_id {kinds['query_id']}, {vec_id} {kinds[vec_id]}, score double"
    usable = vectors.select(vec_id, vec).where(F.col(vec).isNotNull())
    asked = queries.select("query_id", vec).where(F.col(vec).isNotNull())
    n = asked.count()
    if n <= batch:
        found = usable.mapInPandas(_best_of_task(usable, asked.collect(), k), schema)
    else:
        dealt = _dealt(usable, asked, -(-n // batch))
        found = dealt.mapInArrow(_best_of_blocks(vec_id, vec, k), schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), vec_id)
    ranked = found.withColumn("place", F.row_number().over(best).cast("bigint"))
    return ranked.where(F.col("place") <= k)


def _dealt(vectors: DataFrame, queries: DataFrame, blocks: int) -> DataFrame:
    """Queries and vectors side by side: in every (block, slot) its queries, then a share of the vectors.

    A block of queries meets all vectors, spread over slots.
    """
    vec_id, vec = vectors.columns
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = max(1, -(-parts // blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    kinds = dict(vectors.dtypes) | {"query_id": dict(queries.dtypes)["query_id"]}
    none = lambda c: F.lit(None).cast(kinds[c]).alias(c)
    values = F.col(vec).cast("array<double>").alias(vec)
    asked = queries.select(
        own("query_id", blocks).alias("_block"), "query_id", none(vec_id), values, F.lit(False).alias("_meets")
    ).select("*", every(slots).alias("_slot"))
    given = vectors.select(
        own(vec_id, slots).alias("_slot"), none("query_id"), vec_id, values, F.lit(True).alias("_meets")
    ).select("*", every(blocks).alias("_block"))
    both = asked.unionByName(given).repartition(parts, "_block", "_slot")
    return both.sortWithinPartitions("_block", "_slot", "_meets")


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)


def best_k(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``scores`` the ``k`` highest, ties by the smaller id."""
    if scores.shape[1] > k:
        edge = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        # copies of a vector tie; every query keeps all of its ties up to here
        ahead = (scores >= edge[:, None]).any(axis=0)
        ids, scores = ids[:, ahead] if ids.ndim == 2 else ids[ahead], scores[:, ahead]
    ids = np.broadcast_to(ids, scores.shape)
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


class Best:
    """The best ``k`` of the vectors seen so far, for each of a set of queries."""

    def __init__(self, names: np.ndarray, unit: np.ndarray, k: int):
        self.names, self.unit, self.k = names, unit, k
        self.blocks = [slice(at, at + QUERY_BLOCK) for at in range(0, len(names), QUERY_BLOCK)]
        self.best = [None] * len(self.blocks)

    def see(self, ids: np.ndarray, matrix: np.ndarray) -> None:
        ok = np.linalg.norm(matrix, axis=1) > 0
        ids, rows = ids[ok], _unit(matrix[ok]).T
        for b, part in enumerate(self.blocks):
            found = best_k(ids, np.round(self.unit[part] @ rows, DECIMALS), self.k)
            if self.best[b] is not None:
                both = [np.concatenate(pair, axis=1) for pair in zip(self.best[b], found)]
                found = best_k(*both, self.k)
            self.best[b] = found

    def frames(self, vec_id: str) -> Iterator[pd.DataFrame]:
        for kept, part in zip(self.best, self.blocks):
            if kept is not None and kept[0].size:
                names = np.repeat(self.names[part], kept[0].shape[1])
                yield pd.DataFrame({"query_id": names, vec_id: kept[0].ravel(), "score": kept[1].ravel()})


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def _best_of_task(vectors: DataFrame, queries: list, k: int):
    vec_id, vec = vectors.columns
    names = np.array([q["query_id"] for q in queries])
    matrix = _unit(np.array([q[vec] for q in queries], dtype="float64")) if queries else None
    sent = vectors.sparkSession.sparkContext.broadcast((names, matrix))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Best(*sent.value, k)
        for pdf in batches:
            if len(pdf) and len(best.names):
                best.see(pdf[vec_id].to_numpy(), _matrix(pdf[vec]))
        yield from best.frames(vec_id)

    return scan


def _best_of_blocks(vec_id: str, vec: str, k: int):
    """Arrow, not pandas: rows of queries hold a null id, which pandas would widen to a float."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, names, rows, best = None, [], [], None

        def found() -> Iterator[pa.RecordBatch]:
            for pdf in best.frames(vec_id) if best is not None else ():
                yield pa.RecordBatch.from_pydict({c: pdf[c].to_numpy() for c in ("query_id", vec_id, "score")})

        for batch in batches:
            place = np.stack([batch.column(c).cast(pa.int32()).to_numpy() for c in ("_block", "_slot", "_meets")], 1)
            cuts = 1 + np.flatnonzero((place[1:] != place[:-1]).any(axis=1))
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if first == last:
                    continue
                part, at = batch.slice(first, last - first), tuple(place[first, :2].tolist())
                if at != here:
                    yield from found()
                    here, names, rows, best = at, [], [], None
                matrix = part.column(vec).flatten().to_numpy(zero_copy_only=False).reshape(last - first, -1)
                if not place[first, 2]:
                    names.append(part.column("query_id").to_numpy(zero_copy_only=False))
                    rows.append(matrix)
                elif names:
                    if best is None:
                        best = Best(np.concatenate(names), _unit(np.concatenate(rows)), k)
                    best.see(part.column(vec_id).to_numpy(zero_copy_only=False), matrix)
        yield from found()

    return scan

"""Near-duplicate texts: an LSH forest over word shingles, links confirmed on the full sets.

1. Every text becomes its set of shingles and a signature of minimum hashes.
   Texts with equal sets are one class, held by its smallest id.
2. The forest holds each class once per tree; a tree orders the signature from
   another position on. All trees are one globally sorted table, cut by range, so no
   region, however crowded, needs to fit one task.
3. In this order, neighbours with a long common prefix are candidates. A region
   starts at ``depth`` common values and is cut deeper while it holds more than
   ``region`` classes. Pairs whose signatures agree too little are left out.
4. Links are confirmed on the full sets. In crowded regions the first pass tests
   a spanning forest and the best of the candidates only. A second pass tests the best
   candidates between different components of a region. A third connects all that may
   still be linked and compares the full sets within what it connected. So groups of
   thousands cost a few tests each, and no pass writes a row for every pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewise.llm.common import text_batches, written
from lanewise.llm.components import components
from lanewise.plans.lookups import attach
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Forest:
    words: int = 5  # of a shingle
    similarity: int = 80  # percent
    trees: int = 16
    values: int = 96  # of a signature
    depth: int = 4  # common values of a region at least
    region: int = 192  # classes compared with each other at most
    slack: float = 0.18  # how far an estimate may lie below the threshold

    @property
    def least(self) -> int:
        """Equal values two signatures must have to be tested."""
        return int(self.values * (self.similarity / 100 - self.slack))

    def tree_start(self, tree: int) -> int:
        return tree * self.values // self.trees


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Texts to sorted arrays of 64-bit shingle hashes; words are remembered up to a bound."""

    def __init__(self, words: int, remembered: int = 150_000):
        import xxhash

        self.words, self.remembered, self.hash = words, remembered, xxhash.xxh3_64_intdigest
        self.known: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > self.remembered:
            self.known.clear()
        known, digest = self.known, self.hash
        hashes = np.fromiter(
            [known[w] if w in known else known.setdefault(w, digest(w)) for w in words],
            np.uint64,
            len(words),
        )
        n = min(self.words, len(words))
        if n < self.words:
            # the whole sequence is the only shingle; its length keeps it apart from others
            hashes = np.concatenate([hashes, np.full(self.words - n, 0x5EED, np.uint64)])
            n = self.words
        total = np.zeros(len(hashes) - n + 1, np.uint64)
        for k in range(n):
            total = _mixed(total * MIX + hashes[k : len(hashes) - n + 1 + k])
        return np.unique(total)


def _multipliers(values: int) -> np.ndarray:
    return _mixed(np.arange(1, values + 1, dtype=np.uint64) * MIX) | np.uint64(1)


def _signatures(sets: list[np.ndarray], values: int) -> np.ndarray:
    """One row of 16-bit minimum hashes per set, as big-endian numbers; sets are not empty."""
    out = np.empty((len(sets), values), ">u2")
    first = 0
    while first < len(sets):
        last, total = first, 0
        while last < len(sets) and (last == first or total + len(sets[last]) <= 1 << 17):
            total += len(sets[last])
            last += 1
        flat = np.concatenate(sets[first:last])
        starts = np.cumsum([0] + [len(s) for s in sets[first : last - 1]])
        for j, a in enumerate(_multipliers(values)):
            lowest = np.minimum.reduceat(flat * a, starts)
            out[first:last, j] = _mixed(lowest) >> np.uint64(48)
        first = last
    return out


def sketch(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, n_shingles, digest and signature of every row; the last two are null without words."""
    words, values = forest.words, forest.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        shingles = Shingles(words)
        for batch in text_batches(batches):
            sets = [shingles.of(t.as_py()) for t in batch.column("text")]
            full = [s for s in sets if len(s)]
            rows = iter(_signatures(full, values)) if full else iter(())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                        pa.binary(),
                    ),
                    pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "signature"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, signature binary"
    )


def _pairs_of_region(orders, first, last, least, best=3):
    """Candidate pairs in rows [first, last): all, or if they are many a spanning forest and the best of each row."""
    n = last - first
    a, b, score = [], [], []
    block = orders[first:last]
    for i in range(n - 1):
        same = np.count_nonzero(block[i + 1 :] == block[i], axis=1)
        hit = np.flatnonzero(same >= least)
        if len(hit):
            a.append(np.full(len(hit), first + i))
            b.append(first + i + 1 + hit)
            score.append(same[hit])
    if not a:
        return [], False
    a, b, score = np.concatenate(a), np.concatenate(b), np.concatenate(score)
    if len(a) <= 2 * n:
        return list(zip(a.tolist(), b.tolist())), False
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    chosen, taken = [], np.zeros(last, np.int64)
    for k in np.argsort(-score, kind="stable").tolist():
        i, j = int(a[k]), int(b[k])
        x, y = root(i), root(j)
        if x != y or taken[i] < best or taken[j] < best:
            parent[x] = y
            taken[i] += 1
            taken[j] += 1
            chosen.append((i, j))
    return chosen, True


def _regions(common: np.ndarray, first: int, last: int, depth: int, most: int, size: int):
    """Cut rows [first, last), which share ``depth`` values, until at most ``size`` are left in each."""
    if last - first <= size:
        yield first, last
    elif depth == most:
        # equal orders throughout: windows that overlap by half chain them all
        for at in range(first, last, size // 2):
            yield at, min(at + size, last)
            if at + size >= last:
                break
    else:
        cuts = [first, *(first + 1 + np.flatnonzero(common[first : last - 1] <= depth)).tolist(), last]
        for x, y in zip(cuts, cuts[1:]):
            if y - x > 1:
                yield from _regions(common, x, y, depth + 1, most, size)


def _candidates_in(ids, trees, orders, forest: Forest):
    """Index pairs and crowded rows of a sorted run of the forest."""
    if len(ids) < 2:
        return [], set()
    differ = orders[1:] != orders[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), forest.values)
    common[trees[1:] != trees[:-1]] = -1
    cuts = [0, *(1 + np.flatnonzero(common < forest.depth)).tolist(), len(ids)]
    pairs, crowded = [], set()
    for first, last in zip(cuts, cuts[1:]):
        if last - first > forest.region:
            crowded.update(range(first, last))
        if last - first > 1:
            for x, y in _regions(common, first, last, forest.depth, forest.values, forest.region):
                found, many = _pairs_of_region(orders, x, y, forest.least)
                pairs += found
                if many:
                    crowded.update(range(x, y))
    return pairs, crowded


OUT = "a long, b long, border int, tree int, ordering binary, more boolean"


def _out(a, b, border=None, tree=None, ordering=None, more=None):
    n = len(a)
    empty = [None] * n
    return pa.RecordBatch.from_arrays(
        [
            pa.array(a, pa.int64()),
            pa.array(b, pa.int64()),
            pa.array(empty if border is None else border, pa.int32()),
            pa.array(empty if tree is None else tree, pa.int32()),
            pa.array(empty if ordering is None else ordering, pa.binary()),
            pa.array(empty if more is None else [more] * n, pa.bool_()),
        ],
        names=["a", "b", "border", "tree", "ordering", "more"],
    )


def _columns(table, values: int):
    orders = np.frombuffer(b"".join(table.column("ordering").to_pylist()), ">u2").astype(np.uint16)
    return (
        table.column("id").to_numpy(),
        table.column("tree").to_numpy(),
        orders.reshape(-1, values),
    )


def _marked(ids, pairs, crowded):
    """Pairs of ids; a crowded row is marked by a pair with itself."""
    found = {(int(min(ids[x], ids[y])), int(max(ids[x], ids[y]))) for x, y in pairs if ids[x] != ids[y]}
    found |= {(int(ids[x]),) * 2 for x in crowded}
    return sorted(found)


def grow(classes: DataFrame, forest: Forest) -> DataFrame:
    """Every row once per tree, with the signature in the tree's order."""

    def rolled(tree: int):
        at = forest.tree_start(tree) * 2
        return F.concat(
            F.substring("signature", at + 1, forest.values * 2 - at), F.substring("signature", 1, at)
        )

    orders = F.array(*[rolled(t) for t in range(forest.trees)])
    kept = [c for c in classes.columns if c != "signature"]
    return classes.select(*kept, F.posexplode(orders).alias("tree", "ordering"))


def candidates(classes: DataFrame, forest: Forest) -> DataFrame:
    """Pairs a, b of ids that may be linked, and (a, a) for ids of crowded regions.

    ``classes``: id, signature.
    """
    values = forest.values
    trees = grow(classes, forest)
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = trees.repartitionByRange(parts, "tree", "ordering", "id").sortWithinPartitions(
        "tree", "ordering", "id"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        held, first_run = None, True
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 20_000:
                continue
            # what shares a region with the last row waits for more rows
            begin = _last_region(held, forest)
            if begin:
                yield from emit(held.slice(0, begin), here if first_run else None, None)
                held, first_run = held.slice(begin), False
        if held is not None and held.num_rows:
            yield from emit(held, here if first_run else None, here)

    half = forest.region // 2

    def emit(table, head, tail):
        ids, tree, orders = _columns(table, values)
        pairs, crowded = _candidates_in(ids, tree, orders, forest)
        ends = []
        for border, at in ((None if head is None else head - 1, 0), (tail, len(ids) - 1)):
            if border is None or border < 0:
                continue
            region = np.flatnonzero((tree == tree[at]) & (orders[:, : forest.depth] == orders[at, : forest.depth]).all(1))
            # only the rows next to the border are compared across it; where there are more,
            # or the region fills the task, all its rows on both sides are left to later passes
            more = len(region) > half or (len(region) == len(ids) and head is not None and tail is not None)
            if more:
                crowded.update(region.tolist())
            ends.append((border, region[:half] if at == 0 else region[-half:], more))
        found = _marked(ids, pairs, crowded)
        yield _out([p[0] for p in found], [p[1] for p in found])
        for border, picked, more in ends:
            yield _out(
                ids[picked],
                ids[picked],
                np.full(len(picked), border),
                tree[picked],
                [orders[i].astype(">u2").tobytes() for i in picked],
                more,
            )

    def across(batch: pa.Table) -> pa.Table:
        batch = batch.rename_columns({"a": "id"}).sort_by(
            [("tree", "ascending"), ("ordering", "ascending"), ("id", "ascending")]
        )
        ids, tree, orders = _columns(batch, values)
        pairs, crowded = _candidates_in(ids, tree, orders, forest)
        for at in np.flatnonzero(batch.column("more").to_numpy()).tolist():
            same = (tree == tree[at]) & (orders[:, : forest.depth] == orders[at, : forest.depth]).all(1)
            crowded.update(np.flatnonzero(same).tolist())
        found = _marked(ids, pairs, crowded)
        return pa.table(
            {"a": pa.array([p[0] for p in found], pa.int64()), "b": pa.array([p[1] for p in found], pa.int64())}
        )

    found = written(ordered.mapInArrow(run, OUT), "candidates")
    inside = found.where("border is null").select("a", "b")
    borders = found.where("border is not null").groupBy("border").applyInArrow(across, "a long, b long")
    return inside.union(borders).distinct()


def _last_region(table, forest: Forest) -> int:
    """Where the region of the last row begins; 0 if the whole table is one region.

    A region larger than the buffer is cut at the buffer's half, so memory stays bounded.
    """
    tail = table.column("tree").to_numpy()
    orders = table.column("ordering").to_pylist()
    prefix = orders[-1][: 2 * forest.depth]
    at = len(orders) - 1
    while at and tail[at - 1] == tail[-1] and orders[at - 1][: 2 * forest.depth] == prefix:
        at -= 1
    return at or (len(orders) // 2 if len(orders) > 60_000 else 0)


def across_labels(
    classes: DataFrame, forest: Forest, best: int | None = None, chunk: int = 2048, visitors: int = 2048
) -> DataFrame:
    """Pairs a, b of ids of different labels that may be linked, from whole regions.

    With ``best``, so many of a row in a chunk, those of the nearest signatures. Without,
    a spanning forest of all such pairs of a chunk: rows that may be linked are connected.
    Either way what a task gives grows with its rows, not with its pairs.

    ``classes``: id, signature, label. In a region, rows outside its largest label
    visit all rows. Rows are dealt over chunks and visitors over blocks, and each chunk
    meets each block, so a region of any size is compared whole, at its first depth,
    by tasks of bounded size.
    """
    keyed = grow(classes, forest).withColumn("prefix", F.substring("ordering", 1, 2 * forest.depth))
    by_label = keyed.groupBy("tree", "prefix", "label").count()
    regions = written(
        by_label.groupBy("tree", "prefix")
        .agg(F.sum("count").alias("n"), F.max("count").alias("largest"), F.max_by("label", F.struct("count", "label")).alias("major"))
        .where("n > largest"),
        "regions",
    )
    rows = (
        attach(keyed, regions, ["tree", "prefix"])
        .withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int"))
        .withColumn("blocks", F.ceil((F.col("n") - F.col("largest")) / visitors).cast("int"))
    )
    own = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    at_home = (
        rows.withColumn("visits", F.lit(False)).withColumn("chunk", own("chunks")).withColumn("block", every("blocks"))
    )
    visiting = (
        rows.where("label <> major")
        .withColumn("visits", F.lit(True))
        .withColumn("block", own("blocks"))
        .withColumn("chunk", every("chunks"))
    )
    columns = ["tree", "prefix", "chunk", "block", "visits", "id", "label", "ordering"]
    return (
        at_home.select(columns)
        .unionByName(visiting.select(columns))
        .groupBy("tree", "prefix", "chunk", "block")
        .applyInArrow(_visits(forest, best), "a long, b long")
        .distinct()
    )


class Groups:
    """Ids joined into groups; a link inside a group is not kept."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.place = np.unique(ids, return_inverse=True)
        self.group = np.arange(len(self.ids))
        self.a, self.b = [], []

    def join(self, row: int, others: np.ndarray) -> None:
        """Link a row with others, all given by their places among the ids."""
        places = self.place[others]
        mine, here = self.group[self.place[row]], self.place[row]
        groups, first = np.unique(self.group[places], return_index=True)
        new = groups != mine
        for other in places[first[new]].tolist():
            self.a.append(int(min(self.ids[here], self.ids[other])))
            self.b.append(int(max(self.ids[here], self.ids[other])))
        if new.any():
            self.group[np.isin(self.group, groups[new])] = mine

    def table(self) -> pa.Table:
        return pa.table({"a": pa.array(self.a, pa.int64()), "b": pa.array(self.b, pa.int64())})


def _visits(forest: Forest, best: int | None):
    values, least = forest.values, forest.least

    def run(group: pa.Table) -> pa.Table:
        ids, _, orders = _columns(group, values)
        labels, visits = group.column("label").to_numpy(), group.column("visits").to_numpy()
        home = np.flatnonzero(~visits)
        at_home = orders[home]
        a, b, groups = [], [], Groups(ids)
        for i in np.flatnonzero(visits).tolist():
            same = np.count_nonzero(at_home == orders[i], axis=1)
            near = np.flatnonzero((same >= least) & (labels[home] != labels[i]))
            if best is None:
                groups.join(i, home[near])
                continue
            hit = home[near[np.argsort(-same[near], kind="stable")[:best]]]
            a.append(np.minimum(ids[hit], ids[i]))
            b.append(np.maximum(ids[hit], ids[i]))
        if best is None:
            return groups.table()
        none = np.empty(0, np.int64)
        return pa.table({"a": np.concatenate([none, *a]), "b": np.concatenate([none, *b])})

    return run


def linked_within(groups: DataFrame, labelled: DataFrame, docs: DataFrame, forest: Forest, block: int = 300_000) -> DataFrame:
    """Links, by full sets, between ids of different labels that are in one group.

    ``groups``: node, component; ``labelled``: id, label. Every set is shuffled once for
    each block of its group, never once a pair: in a group, ids outside its largest label
    visit all ids, both sides are dealt over blocks of about ``block`` shingles, and a task
    counts the shared shingles of two blocks by an inverted index. Of the links it finds it
    gives a spanning forest, so a group of any size is confirmed whole by bounded tasks.
    """
    nodes = groups.select(F.col("node").alias("id"), F.col("component").alias("part")).join(labelled, "id")
    sets = _sets(groups.select(F.col("node").alias("id")), docs, forest)
    nodes = nodes.join(sets, "id")
    size = F.sum(F.size("shingles").cast("long"))
    by_label = nodes.groupBy("part", "label").agg(size.alias("size"))
    parts = (
        by_label.groupBy("part")
        .agg(F.sum("size").alias("all"), F.max("size").alias("largest"), F.max_by("label", F.struct("size", "label")).alias("major"), F.count("*").alias("labels"))
        .where("labels > 1")
        .select(
            "part",
            "major",
            F.ceil(F.col("all") / block).cast("int").alias("m"),
            F.ceil((F.col("all") - F.col("largest")) / block).cast("int").alias("v"),
        )
    )
    rows = attach(nodes, parts, ["part"])
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["part", "i", "j", "visits", "id", "label", "shingles"]
    at_home = rows.withColumns({"visits": F.lit(False), "i": own("m")}).withColumn("j", every("v"))
    visiting = rows.where("label <> major").withColumns({"visits": F.lit(True), "j": own("v")}).withColumn("i", every("m"))
    met = at_home.select(columns).unionByName(visiting.select(columns))
    return met.groupBy("part", "i", "j").applyInArrow(_shared(forest), "a long, b long").distinct()


def _shared(forest: Forest):
    percent = forest.similarity

    def run(group: pa.Table) -> pa.Table:
        ids, visits = group.column("id").to_numpy(), group.column("visits").to_numpy()
        labels = group.column("label").to_numpy()
        sets = group.column("shingles").combine_chunks()
        ends, flat = sets.offsets.to_numpy(), sets.values.to_numpy()
        sizes = np.diff(ends)
        owner = np.repeat(np.arange(len(ids)), sizes)
        inside = ~visits[owner]
        order = np.argsort(flat[inside], kind="stable")
        index, owners = flat[inside][order], owner[inside][order]
        groups = Groups(ids)
        for i in np.flatnonzero(visits).tolist():
            own = flat[ends[i] : ends[i + 1]]
            first, last = np.searchsorted(index, own, "left"), np.searchsorted(index, own, "right")
            n = last - first
            at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            shared = np.bincount(owners[at], minlength=len(ids))
            linked = (100 * shared >= percent * (sizes[i] + sizes - shared)) & ~visits & (labels != labels[i])
            groups.join(i, np.flatnonzero(linked))
        return groups.table()

    return run


def thinned(docs: DataFrame, wanted: DataFrame, bits: int = 1 << 24) -> DataFrame:
    """Most of the rows of ``docs`` whose doc_id is not in ``wanted`` left out, before any text is shuffled.

    The ids wanted set bits of a map of fixed size (``bits``, in words of 32), which
    is broadcast. Other ids may share a bit, so a join must follow.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    word = F.shiftright(place, 5).cast("int")
    bit = F.expr(f"1L << cast(pmod(xxhash64(doc_id), {bits}) % 32 AS int)")
    words = wanted.select(word.alias("__word"), bit.alias("bit")).groupBy("__word").agg(F.bit_or("bit").alias("mask"))
    found = docs.withColumn("__word", word).join(F.broadcast(words), "__word")
    return found.where(F.col("mask").bitwiseAND(bit) != 0).select(docs.columns)


def _sets(ids: DataFrame, docs: DataFrame, forest: Forest) -> DataFrame:
    """id and sorted shingles of the documents of ``ids``, and of a few others."""
    words = forest.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in text_batches(batches):
            found = [shingles.of(t.as_py()).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], names=["id", "shingles"]
            )

    thin = thinned(docs.select("doc_id", "text"), ids.withColumnRenamed("id", "doc_id"))
    return written(thin.mapInArrow(run, "id long, shingles array<bigint>"), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame, forest: Forest) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    percent = forest.similarity
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
    sets = _sets(ends.distinct(), docs, forest)
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    return (
        pairs.where("a <> b")
        .join(left, "a")
        .join(right, "b")
        .withColumn("shared", F.size(F.array_intersect("left", "right")))
        .where(100 * F.col("shared") >= percent * (F.size("left") + F.size("right") - F.col("shared")))
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    ``docs``: doc_id, text; other columns are ignored. Texts without words (null,
    empty, blank) are linked with nothing. Rows of one doc_id count as one
    document; rows without doc_id get no component and are kept. An empty table
    gives an empty one.
    """
    seen = written(sketch(docs, forest), "sketches")
    full = seen.where("digest is not null and doc_id is not null")
    classes = full.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.min_by("signature", "doc_id").alias("signature")
    )
    one = written(classes, "classes")

    pairs = written(candidates(one.select("id", "signature"), forest), "pairs")
    texts = docs.where("doc_id is not null")
    first = written(confirmed(pairs.where("a <> b"), texts, forest), "links")
    known = components(first)
    crowded = pairs.where("a = b").select(F.col("a").alias("id"))
    if crowded.limit(1).count():
        tested, linked = pairs, first
        rest = written(one.join(crowded, "id", "left_semi"), "crowded")
        for best in (3, None):
            labelled = rest.join(known.withColumnRenamed("node", "id"), "id", "left").select(
                "id", "signature", F.coalesce("component", "id").alias("label")
            )
            labelled = written(labelled, "labelled")
            more = written(across_labels(labelled, forest, best), "pairs")
            if best is None:
                new = linked_within(written(components(more), "groups"), labelled.select("id", "label"), texts, forest)
            else:
                new = confirmed(more.join(tested, ["a", "b"], "left_anti"), texts, forest)
            new = written(new, "links")
            if new.limit(1).count():
                tested, linked = tested.union(more), linked.union(new)
                known = components(linked)

    root = (
        one.select("digest", "id")
        .join(known.withColumnRenamed("node", "id"), "id", "left")
        .select("digest", F.coalesce("component", "id").alias("component_id"))
    )
    classed = full.join(root, "digest").select("doc_id", "n_shingles", "component_id")
    alone = seen.where("digest is null or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return classed.union(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def keep_one(docs: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """One document of each group, that of the smallest doc_id, with its own columns.

    Of rows of one doc_id that with the least text stays (null is least), of equal texts
    one with the least hash of its other columns; rows without doc_id all stay.
    """
    found = near_duplicates(docs, forest)
    kept = found.where("kept and doc_id is not null").select("doc_id").distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy("doc_id").orderBy("text", F.xxhash64("doc_id", *others))
    placed = docs.join(kept, "doc_id", "left_semi").withColumn("__place", F.row_number().over(order))
    return placed.where("__place = 1").select(docs.columns).unionByName(docs.where("doc_id is null"))

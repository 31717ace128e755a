"""Near-duplicates of texts and vectors against brute force, components, the pipeline, and the SQL."""

from __future__ import annotations

import random

import numpy as np
import oracle
import pytest

import corpus_pipeline
from lanewise.llm import neardup, packing, quality, secrets, toxicity, vectors
from lanewise.llm.common import vocabulary_file
from lanewise.llm.components import components
from lanewise.llm.queries import QUERIES, SQL


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(300, 360)] + [(500, k) for k in range(501, 700)]
    links += [(rng.randrange(100), rng.randrange(100)) for _ in range(60)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    want = closure({x for p in links for x in p}, links)
    assert {k: v for k, v in want.items() if k in got} == got
    assert all(want[k] == k for k in want if k not in got)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- texts


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_components(docs, n):
    sets = {d: shingle_set(t, n) for d, t in docs.items()}
    links = []
    items = [(d, s) for d, s in sets.items() if s]
    for i, (a, s) in enumerate(items):
        for b, t in items[:i]:
            if 4 * len(s) <= 5 * len(t) and 4 * len(t) <= 5 * len(s):
                both = len(s & t)
                if 100 * both >= 80 * (len(s) + len(t) - both):
                    links.append((a, b))
    return closure(docs, links)


def copies(seed):
    """Unrelated texts, near copies, exact copies, and one crowded family around a base."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(60)]
    for t in texts[:20]:
        w = t.split()
        for k in rng.sample(range(60), rng.randint(1, 4)):
            w[k] = "x" + str(rng.random())
        texts.append(" ".join(w))
    texts += texts[5:8] * 4 + [texts[0].upper()]
    base = rng.choices(words, k=80)
    for _ in range(260):
        w = list(base)
        for k in rng.sample(range(80), rng.choice([2, 4, 5, 6, 9])):
            w[k] = "y" + str(rng.random())
        texts.append(" ".join(w))
    return dict(enumerate(texts + [None, "", " \n", "one", "one", "one two"]))


@pytest.mark.parametrize("words, region", [(2, 192), (2, 24), (5, 192)])
def test_near_texts(spark, words, region):
    docs = copies(words)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    rows = neardup.near_duplicates(frame, neardup.Forest(words=words, region=region)).collect()
    want = brute_components(docs, words)
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert all(r["kept"] == (want[r["doc_id"]] == r["doc_id"]) for r in rows)
    assert all(r["n_shingles"] == len(shingle_set(docs[r["doc_id"]], words)) for r in rows)


def test_near_texts_odd_input(odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs, neardup.Forest()).collect()
    assert len(rows) == odd_docs.count()
    assert {(r["doc_id"], r["component_id"]) for r in rows} >= {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (None, None)}
    one = neardup.keep_one(odd_docs, neardup.Forest())
    assert one.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in one.collect()) == [0, 1, 3, 4, 5, 6, 7, 8]
    assert neardup.keep_one(no_docs, neardup.Forest()).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_of_one_id_the_least_text_stays(spark, partitions):
    rows = [(1, "b b b", "x"), (1, "a a a", "y"), (1, None, "z"), (2, "c c", "p"), (2, "c c", "q"), (None, "d", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(partitions)
    kept = {(r["doc_id"], r["text"], r["source"]) for r in neardup.keep_one(docs, neardup.Forest()).collect()}
    assert (1, None, "z") in kept and (None, "d", "r") in kept and len(kept) == 3
    again = {(r["doc_id"], r["text"], r["source"]) for r in neardup.keep_one(docs.repartition(3), neardup.Forest()).collect()}
    assert kept == again


def crowd(rows, forest, seed):
    """Signatures that share the first region of tree 0 and nothing else, as an array."""
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 1 << 16, size=(rows, forest.values))
    x[:, : forest.depth] = 7
    return x


def signed(spark, x):
    rows = [(i, bytearray(v.astype(">u2").tobytes()), i) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, signature binary, label long")


def brute_meetings(x, forest):
    """Pairs that agree enough and share a region of any tree at its first depth."""
    out = set()
    for i in range(len(x)):
        same = x[:i] == x[i]
        near = same.sum(axis=1) >= forest.least
        for t in range(forest.trees):
            at = (forest.tree_start(t) + np.arange(forest.depth)) % forest.values
            out |= {(int(k), i) for k in np.flatnonzero(near & same[:, at].all(axis=1))}
    return out


def test_pairs_of_a_crowded_and_another_region(spark):
    """Pairs that share the crowded region at its first depth only, and later regions too."""
    forest = neardup.Forest()
    x = crowd(100, forest, 4)
    for i in range(0, 20, 2):
        x[i + 1] = x[i]
        x[i + 1, 4:6] += 1
    got = neardup.across_labels(signed(spark, x), forest, visitors=16).collect()
    want = brute_meetings(x, forest)
    assert len(want) == 10
    assert {(r["a"], r["b"]) for r in got} == want


def test_pairs_of_a_crowded_region_only(spark):
    """Pairs that meet in one crowded region, at its first depth, and in no other."""
    forest = neardup.Forest()
    x = crowd(100, forest, 5)
    alone = [forest.depth, *(forest.tree_start(t) for t in range(1, forest.trees))]
    for i in range(0, 20, 2):
        x[i + 1] = x[i]
        x[i + 1, alone] += 1
    got = neardup.across_labels(signed(spark, x), forest, chunk=24, visitors=16).collect()
    want = brute_meetings(x, forest)
    assert len(want) == 10
    assert {(r["a"], r["b"]) for r in got} == want


def alike(rows, seed):
    """Unlinked texts that are similar all the same: about 0.7 of their words are those of one base."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for _ in range(rows):
        w = list(base)
        for k in rng.sample(range(120), 12):
            w[k] = f"x{rng.random()}"
        texts.append(" ".join(w))
    return texts


def test_rows_given_grow_with_the_rows(spark):
    """Hundreds of texts that are all similar and never linked."""
    forest = neardup.Forest(words=2)
    given = []
    for n in (150, 300, 600):
        docs = spark.createDataFrame(list(enumerate(alike(n, 1))), "doc_id long, text string")
        seen = neardup.sketch(docs, forest).selectExpr("doc_id AS id", "signature", "doc_id AS label")
        pairs = neardup.across_labels(seen, forest, chunk=64, visitors=64)
        rows = neardup.near_duplicates(docs, forest).collect()
        assert all(r["kept"] for r in rows) and len(rows) == n
        given.append(pairs.count())
    # a forest in each meeting of blocks; all pairs would be 44,850 and 179,700
    assert given[1] <= 3 * 16 * 300 * 300 / 64 and given[2] < 100_000


def test_links_among_many_that_are_only_similar(spark):
    texts = alike(260, 2)
    rng = random.Random(3)
    for t in texts[:60]:
        w = t.split()
        for k in rng.sample(range(120), rng.randint(1, 3)):
            w[k] = f"y{rng.random()}"
        texts.append(" ".join(w))
    docs = dict(enumerate(texts))
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for region in (24, 192):
        rows = neardup.near_duplicates(frame, neardup.Forest(words=2, region=region)).collect()
        assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(docs, 2)


@pytest.mark.parametrize("partitions", [211, 24, 3])
def test_no_pair_is_lost_at_the_borders_of_ranges(spark, partitions):
    """Pairs that meet in one region only; the ranges cut such regions anywhere."""
    forest = neardup.Forest(region=24)
    rng = np.random.default_rng(partitions)
    x = rng.integers(0, 1 << 16, size=(8 * 60, forest.values))
    alone = [forest.depth, *(forest.tree_start(t) for t in range(1, forest.trees))]
    for k in range(8):
        at = slice(60 * k, 60 * k + 60)
        x[at, : forest.depth] = 9000 * k
        for i in range(60 * k, 60 * k + 60, 2):
            x[i + 1] = x[i]
            x[i + 1, alone] += 1
    table = signed(spark, x).select("id", "signature")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = neardup.candidates(table, forest).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    pairs = {(r["a"], r["b"]) for r in found if r["a"] != r["b"]}
    crowded = {r["a"] for r in found if r["a"] == r["b"]}
    want = brute_meetings(x, forest)
    assert len(want) >= 240
    assert all(p in pairs or (p[0] in crowded and p[1] in crowded) for p in want)


def test_near_query(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op6_minhash_near_dedup"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(docs, 2)


# --- vectors


def brute_vectors(rows, least):
    good = [
        (i, v, label)
        for i, v, label in rows
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    links, counts = [], {i: 0 for i, _, _ in rows}
    for k, (a, v, la) in enumerate(good):
        for b, w, lb in good[:k]:
            if la == lb and len(v) == len(w):
                x, y = np.float32(v).astype(float), np.float32(w).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links.append((a, b))
                    counts[a] += 1
                    counts[b] += 1
    return counts, closure(counts, links)


def test_near_vectors(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    rows = []
    for i in range(500):
        v = centres[i % 40] + rng.normal(size=16) * rng.choice([0.1, 0.25, 0.5])
        rows.append((i, v.astype(np.float32).tolist(), int(i % 3 > 0)))
    same = rows[0][1]
    rows += [(1000 + i, same, 1) for i in range(60)] + [(2000, [2 * x for x in same], 1), (2001, same, 0)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [None] + [1.0] * 15, 1), (3003, [float("nan")] * 16, 1)]
    rows += [(3004, same, None), (3005, [], 1), (3006, [1.0, 2.0], 1), (3007, [float("inf")] * 16, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    counts, roots = brute_vectors(rows, 0.93)
    for cells in (vectors.Cells(size=40, margin=1.0), vectors.Cells(size=40, margin=1.0, block=16)):
        got = vectors.near_duplicates(frame.withColumn("kept", frame["vec_id"]), cells).collect()
        assert len(got) == len(rows)
        assert {r["vec_id"]: r["n_links"] for r in got} == counts
        assert {r["vec_id"]: r["component_id"] for r in got} == roots
    found = sum(r["n_links"] for r in vectors.near_duplicates(frame, vectors.Cells(size=40)).collect())
    assert 0.95 * sum(counts.values()) <= found <= sum(counts.values())
    assert vectors.near_duplicates(frame.where("false")).count() == 0


def test_near_vectors_by_default_lose_no_link(spark):
    """Vectors on a low-dimensional spread, where many links cross the borders of cells."""
    rng = np.random.default_rng(3)
    x = (rng.uniform(-1, 1, size=(1500, 2)) * 1.5) @ rng.normal(size=(2, 16)) + rng.normal(size=16)
    x = x.astype(np.float32)
    unit = vectors.unit(x)
    linked = (unit @ unit.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    frame = spark.createDataFrame(
        [(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int"
    )
    got = vectors.near_duplicates(frame, vectors.Cells(size=75)).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(linked.sum(axis=1).tolist()))
    roots = closure(range(len(x)), np.argwhere(np.triu(linked)).tolist())
    assert {r["vec_id"]: r["component_id"] for r in got} == roots


def test_near_vectors_of_doubles_under_any_labels(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(20, 3))[np.arange(120) % 20] + rng.normal(size=(120, 3)) * 0.4
    sizes = [10.0 ** (-200, 0, 200)[i % 3] for i in range(120)]
    kinds = ["a", "b c", "99999999999", "1"]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = [kinds[i % 4] for i in range(120)]
    linked = (unit @ unit.T >= 0.93) & np.equal.outer(label, label) & ~np.eye(120, dtype=bool)
    rows = [(i, [float(c) * sizes[i] for c in v], label[i]) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = vectors.near_duplicates(frame, vectors.Cells(size=8)).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(linked.sum(axis=1).tolist()))
    numbered = frame.selectExpr("vec_id", "embedding", "CAST(hash(label) AS long) * 3000000000 AS label")
    assert sorted(vectors.near_duplicates(numbered, vectors.Cells(size=8)).collect()) == sorted(got)


def test_kmeans_centroids_are_unit():
    x = vectors.unit(np.random.default_rng(0).normal(size=(300, 8)))
    c = vectors.spherical_kmeans(x, 7, 8, np.random.default_rng(1))
    assert c.shape == (7, 8) and np.allclose((c * c).sum(axis=1), 1)


# --- SQL and pipeline


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, sf_dir, name):
    con = oracle.connect(sf_dir)
    assert oracle.spark_rows(QUERIES[name](spark, sf_dir)) == oracle.duck_rows(con, SQL[name])


def test_pipeline_against_plain_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    left = {r["doc_id"]: r["text"] for r in docs.collect() if model.score(r["text"]) < 0.5}
    judged = quality.judge(docs).select("doc_id", "quality.kept").collect()
    left = {d: left[d] for d, kept in judged if kept and d in left}
    left = _roots(left)
    for d, text in left.items():
        for s, e, _ in reversed(secrets.find(text)):
            text = text[:s] + "[SECRET]" + text[e:]
        left[d] = text
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(left)
    expect = spark.createDataFrame(list(left.items()), "doc_id long, text string")
    ids = {}
    for r in packing.packed(expect, vocabulary_file("word_bpe_49k.json")).collect():
        ids.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    join = lambda parts: {d: b"".join(x for _, x in sorted(p)) for d, p in parts.items()}
    assert join(got) == join(ids)


def _roots(docs):
    found = brute_components(docs, 5)
    return {d: t for d, t in docs.items() if found[d] == d}


def test_stages_keep_columns(spark, sf_dir, odd_docs, no_docs):
    for frame in (odd_docs, no_docs):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            assert docs.columns == frame.columns
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert "sequence_id" in pieces.columns and pieces.count() >= 0


def test_vector_query_equals_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table]
    counts, roots = brute_vectors(rows, 0.93)
    got = QUERIES["op10_embedding_near_dedup"](spark, sf_dir).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == {
        i: (counts[i], roots[i], roots[i] == i) for i, *_ in rows
    }

"""Winnowing against a naive form, its match guarantee, and the query against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewise.llm import winnow
from lanewise.llm.queries import QUERIES
from lanewise.llm.winnow import Winnow, Winnower

MASK = (1 << 64) - 1


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def naive(text, w):
    """Hash every run by itself and look at every window."""
    inverse = pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def run(codes):
        return mixed(sum(mixed(ord(c) + 1) * pow(inverse, j, 1 << 64) for j, c in enumerate(codes)) & MASK)

    if not text:
        return []
    if len(text) < w.gram:
        return [(mixed((run(text) + len(text)) & MASK), 0)]
    hashes = [run(text[i : i + w.gram]) for i in range(len(text) - w.gram + 1)]
    width, kept = min(w.window, len(hashes)), []
    for at in range(len(hashes) - width + 1):
        least = min(hashes[at : at + width])
        place = max(i for i in range(at, at + width) if hashes[i] == least)
        if not kept or kept[-1] != (least, place):
            kept.append((least, place))
    return kept


def pairs(found):
    return list(zip(found[0].tolist(), found[1].tolist()))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aab c\n\U0001f600é", max_size=90), st.integers(1, 6), st.integers(1, 9))
def test_winnowing_equals_the_naive_form(text, gram, window):
    w = Winnow(gram, window)
    found = Winnower(w).of(text)
    assert pairs(found) == naive(text, w)
    assert winnow.unpacked(winnow.packed(found))[1].tolist() == found[1].tolist()
    assert (winnow.unpacked(winnow.packed(found))[0] == found[0] & ~np.uint64(0xFF)).all()


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choices("abcdefgh ", k=3000)) + "x" * 500
    whole = pairs(Winnower(Winnow()).of(text))
    monkeypatch.setattr(winnow, "BLOCK", 100)
    assert pairs(Winnower(Winnow()).of(text)) == whole == naive(text, Winnow())


@pytest.mark.parametrize("seed", range(20))
def test_shared_passages_are_always_met(seed):
    rng = random.Random(seed)
    w = Winnow()
    noise = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    shared = noise(w.guarantee)
    a, b = noise(rng.randrange(200)) + shared + noise(100), noise(rng.randrange(200)) + shared
    x, y = a.index(shared), b.index(shared)
    met = winnow.matches(Winnower(w).of(a), Winnower(w).of(b))
    assert any(p - x == q - y and 0 <= p - x <= len(shared) - w.gram for p, q in met)


def test_fingerprints_of_odd_rows(spark, odd_docs, no_docs):
    found = winnow.fingerprints(odd_docs).collect()
    want = {}
    for r in odd_docs.collect():
        want.setdefault(r["doc_id"], []).append(r["text"] or "")
    assert sorted((r["doc_id"] is None, r["doc_id"], r["n_chars"]) for r in found) == sorted(
        (k is None, k, len(t)) for k, texts in want.items() for t in texts
    )
    for r in found:
        kept = naive(want[r["doc_id"]][0][:400], Winnow()) if r["n_chars"] <= 400 else None
        if kept is not None:
            assert [h & MASK for h in r["hashes"]] == [h for h, _ in kept]
            assert r["positions"] == [p for _, p in kept]
    assert winnow.fingerprints(no_docs).collect() == []


def brute(rows):
    """By descending id, ties by text; null ids last, in the order of Spark's hash of their text."""
    out = []
    w = Winnower(Winnow())
    for i, (doc, text, _) in enumerate(rows):
        then = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + then[:half]
        own, other, next = (w.of(t) for t in (text, new, then))
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        sets = [set(x[0].tolist()) for x in (own, other, next)]
        out.append(
            (doc, len(text), new, winnow.packed(own), winnow.packed(other), like(*sets[:2]), like(sets[0], sets[2]))
        )
    return sorted(out, key=repr)


def ordered(spark, rows):
    hashed = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h"
    )
    found = [tuple(r) for r in hashed.collect()]
    return sorted((r for r in found if r[0] is not None), key=lambda r: (-r[0], r[1])) + sorted(
        (r for r in found if r[0] is None), key=lambda r: (r[2], r[1])
    )


@pytest.mark.parametrize("per_range", [256, 1, 3])
def test_next_texts_across_ranges(spark, odd_docs, monkeypatch, per_range):
    monkeypatch.setattr(winnow, "RANGE_ROWS", per_range)
    monkeypatch.setattr(winnow, "_FAN", 2)
    rng = random.Random(3)
    rows = [(rng.randrange(-(2**63), 2**63), "word " * rng.randrange(9) + str(rng.random())) for _ in range(40)]
    rows += [(None, f"text {i}" * 5) for i in range(12)] + [(None, None)] * 2 + [(5, "b" * 50), (5, "a" * 50), (6, None)]
    rows += [(2**63 - 1, "highest"), (-(2**63), "lowest")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in winnow.against_next(docs).collect()), key=repr)
    assert got == brute(ordered(spark, rows))


def test_next_texts_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted((tuple(r) for r in winnow.against_next(odd_docs).collect()), key=repr)
    assert got == brute(ordered(spark, rows))
    assert winnow.against_next(no_docs).collect() == []
    one = spark.createDataFrame([(4, "ab")], "doc_id long, text string")
    assert [tuple(r)[:3] for r in winnow.against_next(one).collect()] == [(4, 2, "aa")]


def test_query_equals_brute_force(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    rows = sorted(((r["doc_id"], r["text"] or "", 0) for r in table), key=lambda r: -r[0])
    want = {r[0]: r for r in brute(rows)}
    got = QUERIES["op12_document_fingerprints"](spark, sf_dir).collect()
    assert len(got) == len(want)
    for r in got:
        _, n, new, own, other, near_edited, near_next = want[r["doc_id"]]
        assert tuple(r) == (
            r["doc_id"], n, hashlib.sha256(new.encode()).hexdigest(), own, other, near_edited, near_next
        )
    by_text = {}
    for r in table:
        by_text.setdefault(r["text"], set()).add(want[r["doc_id"]][3])
    assert all(len(v) == 1 for v in by_text.values())

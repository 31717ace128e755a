"""Rank-one updates against a dense solver, and whitening against brute force."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewise.llm import whitening
from lanewise.llm.queries import QUERIES
from lanewise.llm.whitening import Spectrum, Whitening, rank_one

OUT = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


def scatter(x):
    away = x - x.mean(axis=0)
    return away.T @ away


def cases():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 12))
    yield "spread", x
    yield "fewer rows than dimensions", x[:5]
    yield "copies", np.repeat(x[:4], 40, axis=0)
    yield "one direction", np.outer(np.arange(50.0), np.ones(6))
    yield "equal eigenvalues", np.eye(8)[rng.integers(0, 8, 160)] * 100
    yield "few distinct values", rng.integers(-1, 2, (400, 10)).astype(float)
    yield "very uneven", x[:, :6] * np.logspace(0, -8, 6)
    yield "constant", np.ones((20, 5))
    yield "one dimension", x[:, :1]


@pytest.mark.parametrize("name, x", list(cases()), ids=[n for n, _ in cases()])
def test_updates_equal_a_dense_solver(name, x):
    parts = []
    for part in np.array_split(x, 3):
        s = Spectrum.empty(x.shape[1])
        for row in part:
            s.add(row)
        parts.append(Spectrum.of_bytes(s.to_bytes(), x.shape[1]))
    whole = parts[0]
    for other in parts[1:]:
        whole.join(other)
    want = scatter(x)
    scale = max(np.abs(want).max(), 1e-300)
    assert whole.n == len(x) and np.allclose(whole.mean, x.mean(axis=0), atol=1e-12)
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(x.shape[1])).max() < 1e-12
    assert np.abs(whole.vectors * whole.values @ whole.vectors.T - want).max() / scale < 1e-12
    assert (np.diff(whole.values) >= 0).all()


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.sampled_from([0.0, 1e-9, 0.5, 1.0, 1.0 + 1e-15, 1.0 + 1e-9, 3.0, 1e6]), min_size=1, max_size=7),
    st.lists(st.sampled_from([0.0, 1e-12, 1e-6, -0.3, 1.0, -2.0, 1e3]), min_size=7, max_size=7),
    st.sampled_from([1e-6, 0.5, 1.0, 1e4]),
)
def test_one_update_of_any_spectrum(values, v, rho):
    values, v = np.sort(values), np.array(v[: len(values)])
    vectors, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(len(values),) * 2))
    want = vectors * values @ vectors.T + rho * np.outer(v, v)
    got, turned = rank_one(values, vectors, v, rho)
    scale = max(np.abs(want).max(), 1e-300)
    assert np.abs(turned.T @ turned - np.eye(len(values))).max() < 1e-13
    assert np.abs(turned * got @ turned.T - want).max() / scale < 1e-13


def brute(ids, x, count=32):
    """x: Python integers. Signs are those of the largest entry of a component."""
    n, dims = len(x), len(x[0])
    sums = [sum(r[k] for r in x) for k in range(dims)]
    away = [[n * v - s for v, s in zip(r, sums)] for r in x]
    y = np.array(away, float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = values.sum()
    white = y @ vectors[:, :count] / np.sqrt(np.maximum(values[:count], 1e-300))
    out = {}
    for i, r in enumerate(away):
        for k in range(min(count, dims)):
            if values[k] > 1e-12 * trace:
                out[ids[i], k + 1] = (n, sum(v * v for v in r), white[i, k], values[k] / trace)
    return out


def check(rows, id, want):
    got = {(r[id], r["component"]): r for r in rows}
    assert got.keys() == want.keys() and len(rows) == len(want)
    flip = {}
    for (i, k), (n, deviation, white, explained) in sorted(want.items(), key=lambda e: -abs(e[1][2])):
        r = got[i, k]
        sign = flip.setdefault(k, math.copysign(1, white * r["whitened"]))
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert r["explained"] == pytest.approx(explained, rel=1e-9)
        assert r["whitened"] == pytest.approx(sign * white, abs=1e-7)
        assert r["identity_error"] < 1e-9


def test_query_equals_brute_force(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/embeddings.parquet").to_pylist()
    good = [r for r in table if r["embedding"] is not None and all(v is not None and math.isfinite(v) for v in r["embedding"])]
    x = [[math.floor(64 * v) + 1000000 for v in r["embedding"]] for r in good]
    rows = QUERIES["op13_embedding_whitening"](spark, sf_dir).collect()
    check(rows, "vec_id", brute([r["vec_id"] for r in good], x))


def odd(spark):
    """Nulls, NaN, other lengths, copies, and columns named like outputs."""
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=3) * 9]) for i in range(30)]
    rows += [(40, rows[0][1]), (41, rows[0][1]), (None, [1.0, 2.0, 3.0]), (50, [0.0, 0.0, 0.0])]
    bad = [(60, None), (61, []), (62, [1.0, None, 2.0]), (63, [nan, 1.0, 2.0]), (64, [inf, 1.0, 2.0]), (65, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    for name in ("n", "x", "id", "component", "whitened", "deviation"):
        frame = frame.selectExpr("*", f"vec_id AS {name}")
    return frame, rows


@pytest.mark.parametrize("partitions", [1, 40])
def test_whitening_of_odd_rows(spark, partitions):
    frame, rows = odd(spark)
    got = whitening.whiten(frame.repartition(partitions)).collect()
    assert got and list(got[0].asDict()) == ["vec_id", *OUT]
    x = [[math.floor(64 * v) + 1000000 for v in r[1]] for r in rows]
    check(got, "vec_id", brute([r[0] for r in rows], x))


def test_nothing_to_whiten(spark):
    frame, _ = odd(spark)
    assert whitening.whiten(frame.where("false")).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).collect() == []


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, float(i % 3)]) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(frame).collect()
    assert {r["component"] for r in got} == {1, 2}
    x = [[math.floor(64 * v) + 1000000 for v in r[1]] for r in rows]
    check(got, "vec_id", brute([r[0] for r in rows], x))


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(i) * 1e9, float(i % 7) * 1e12]) for i in range(20)] + [(99, [1e300, -1e300])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    most = Whitening().largest
    x = [[int(max(-most, min(most, math.floor(64 * v)))) + 1000000 for v in r[1]] for r in rows]
    want = brute([r[0] for r in rows], x)
    got = whitening.whiten(frame).collect()
    assert {(r["vec_id"], r["component"]): r["deviation"] for r in got} == {
        k: v[1] if v[1] < 1 << 63 else None for k, v in want.items()
    }

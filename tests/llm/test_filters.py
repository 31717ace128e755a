"""The filter audit against SQL on the tables and a brute-force form on odd rows."""

from __future__ import annotations

import random
import re
from itertools import permutations

import oracle
import pytest
from pyspark.sql import functions as F

from lanewise.llm import filters
from lanewise.llm.queries import QUERIES, SQL

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_query_equals_sql(spark, sf_dir):
    con = oracle.connect(sf_dir)
    name = "op11_filter_interactions"
    df = QUERIES[name](spark, sf_dir)
    assert oracle.type_differences(df, con, SQL[name]) == []
    assert oracle.spark_rows(df) == oracle.duck_rows(con, SQL[name])


def brute(docs, labels):
    """docs: (id, text, source); every order is applied to the rows one filter at a time."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        earlier = any((t or "") == text and j is not None and i is not None and j < i for j, t, _ in docs)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None,
            "E": earlier,
        }
        rows.append((source or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = sum(f in r[1] for r in mine)
                shapley[f] += len(removed)
                out[part, order, step] = [
                    len(left),
                    len(removed),
                    failing - len(removed),
                    sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in removed),
                    sum(r[3] for r in removed),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return out


def audited(spark, docs, labels):
    rows = filters.interactions(filters.combinations(docs, labels)).collect()
    found = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in rows}
    assert len(found) == len(rows) and all(r["filter"] == r["filter_order"][r["step"] - 1] for r in rows)
    return found


def sample():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)] + ["THE", "$", "a#b", "ünï"]
    texts = [" ".join(rng.choices(words[: rng.choice([20, 404])], k=rng.randrange(5, 90))) for _ in range(25)]
    docs = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in rng.sample(range(-500, 500), 90)]
    docs += [(None, texts[0], "a"), (None, texts[0], "a"), (700, texts[0], "a"), (700, texts[0], "a"), (700, texts[1], "a")]
    docs += [(801, None, "b"), (802, "", "b"), (803, " \t\n", "b"), (804, "x " * 40_000, "c"), (None, None, None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _, _ in docs[:60] if i is not None]
    return docs, labels + labels[:5] + [(labels[0][0], 1, 1), (None, 1, 1), (999_999, 1, 1)]


@pytest.mark.parametrize("copies, heavy", [(filters.COPIES, filters.HEAVY), (1, filters.HEAVY), (1, 3)])
def test_odd_rows_equal_brute_force(spark, monkeypatch, copies, heavy):
    monkeypatch.setattr(filters, "COPIES", copies)
    monkeypatch.setattr(filters, "HEAVY", heavy)
    docs, labels = sample()
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(6)
    for name in ("id", "part", "hash", "bits", "n", "spread", "good", "toxic", "quality", "first", "salt"):
        frame = frame.selectExpr("*", f"doc_id AS `{name}`")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "doc_id AS id")
    assert audited(spark, frame, marks) == brute(docs, labels)


def test_unequal_texts_of_one_hash(spark, monkeypatch):
    """Only the exact text makes a copy."""
    rows = [(1, "a", "p"), (2, "b", "p"), (3, "a", "p"), (4, "c", "p"), (5, "b", "q")]
    frame = spark.createDataFrame(rows, "id long, text string, part string").withColumn("hash", F.lit(7).cast("long"))
    assert sorted(r["id"] for r in filters.earlier_copies(frame).collect()) == [3, 5]


def test_texts_that_stand_alone_are_not_joined(spark):
    rows = [(i, f"text {i // 2 if i < 10 else i}", "p") for i in range(200)]
    frame = spark.createDataFrame(rows, "id long, text string, part string").withColumn("hash", F.xxhash64("text"))
    assert sorted(r["id"] for r in filters.earlier_copies(frame).collect()) == [1, 3, 5, 7, 9]


def test_empty_tables(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audited(spark, no_docs, labels) == {}
    one = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert audited(spark, one, labels) == brute([(1, None, None)], [])

"""Cut keys against plain windows, on random data with ties, nulls and skew."""

from __future__ import annotations

import random

import pytest
from oracle import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanewise.operators import aggregates as A
from lanewise.operators import customers as U
from lanewise.operators import joins as J
from lanewise.operators import windows as W
from lanewise.plans import cells, lanes
from lanewise.plans.cells import counted_cells
from lanewise.plans.lanes import (
    CHUNK,
    Lane,
    heavy_keys,
    lay_out,
    number_cell,
    with_back,
    with_moving,
    with_previous,
    with_running,
)
from lanewise.plans.lookups import attach
from lanewise.plans.spans import explode_span
from lanewise.sources.tables import literal


def skewed(spark, seed: int, n: int = 300):
    """A third of the rows belongs to key 0; one key is null; values repeat."""
    rng = random.Random(seed)
    data = [
        (
            rng.choice([0, 1, 2, 3, 4, None]) if rng.random() > 1 / 3 else 0,
            rng.randint(-40, 40),
            i,
            rng.choice([None, *range(-5, 6)]),
        )
        for i in range(n)
    ]
    return literal(spark, data, "k int, t int, i int, v int")


LANES = [
    Lane(("k",), ("t", "i"), "t div 3", min_rows=20),
    Lane(("k",), ("t", "i"), ("t", "i div 50"), min_rows=0),
    Lane(("k",), ("t", "i"), "t", min_rows=10**6),
    Lane((), ("t", "i"), "t div 5"),
    Lane((), ("t", "i"), ("t", "i div 20")),
    Lane((), ("t", "i"), "t", bounded=True),
    Lane((), ("t", "i")),
    Lane(("k",), ("t", "i"), min_rows=20),
    Lane(("k",), ("t", "i"), min_rows=10**6),
]


@pytest.fixture(autouse=True)
def small_cells(monkeypatch):
    """Counted cells of a few rows, and summaries of summaries from a few cells on."""
    monkeypatch.setattr(cells, "ROWS", 8)
    monkeypatch.setattr(cells, "PICKED", 3)
    monkeypatch.setattr(cells, "CHECKED", 0)
    monkeypatch.setattr(lanes, "SPAN", 4)


@pytest.mark.parametrize("lane", LANES, ids=range(len(LANES)))
@pytest.mark.parametrize("seed", [1, 2])
def test_lane_primitives_match_plain_windows(spark, lane, seed):
    df = skewed(spark, seed)
    w = Window.partitionBy(*lane.key).orderBy("t", "i")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    laid = lay_out(df, lane)
    got = with_previous(laid, lane, {"prev": "v"})
    got = with_running(
        got,
        lane,
        {
            "total": ("sum", "v"),
            "n": ("count", "v"),
            "low": ("min", "v"),
            "high": ("max", "v"),
            "latest": ("last", "v"),
        },
    )
    plain = df.select(
        "i",
        F.lag("v").over(w).alias("prev"),
        F.sum("v").over(upto).alias("total"),
        F.count("v").over(upto).alias("n"),
        F.min("v").over(upto).alias("low"),
        F.max("v").over(upto).alias("high"),
        F.last("v", ignorenulls=True).over(upto).alias("latest"),
    )
    assert rows(got.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("lane", LANES, ids=range(len(LANES)))
@pytest.mark.parametrize("n", [1, 2, 7])
def test_looking_back_matches_plain_windows(spark, lane, n):
    df = skewed(spark, 3)
    w = Window.partitionBy(*lane.key).orderBy("t", "i")
    moved = with_moving(lay_out(df, lane), lane, "v", n, "mean")
    plain = df.select("i", F.avg("v").over(w.rowsBetween(-(n - 1), 0)).alias("mean"))
    digits = F.round("mean", 9).alias("mean")
    assert rows(moved.select("i", digits)) == rows(plain.select("i", digits))
    back = with_back(lay_out(df, lane), lane, "v", n, "back")
    ordered = F.transform("back", lambda b: b["v"])
    got = {r[0]: list(r[1]) for r in back.select("i", ordered).collect()}
    frame = F.collect_list(F.struct("v")).over(w.rowsBetween(-n, -1)).alias("b")
    want = {r["i"]: [x["v"] for x in reversed(r["b"])] for r in df.select("i", frame).collect()}
    assert got == want


def test_runs_and_sessions_match_plain_windows(spark):
    df = skewed(spark, 4).withColumn("ts", F.timestamp_seconds(F.col("t") * 1000))
    w = Window.partitionBy("k").orderBy("t", "i")
    brk = (F.col("t") - F.lag("t").over(w) > 1).cast("int")
    plain = df.withColumn("b", F.coalesce(brk, F.lit(0))).select("i", F.sum("b").over(w))
    for min_rows in (0, 20, 10**6):
        lane = Lane(("k",), ("t", "i"), "t div 3", min_rows=min_rows)
        got = W.sessionize(df, lane, "ts", 1000)
        assert rows(got.select("i", "session")) == rows(plain)


def test_heavy_keys_are_bounded_and_repeatable(spark):
    df = skewed(spark, 5)
    assert rows(heavy_keys(df, ("k",), 80, 10)) == [(0,)]
    ties = literal(spark, [(i % 4,) for i in range(40)], "k int")
    assert rows(heavy_keys(ties, ("k",), 0, 2)) == [(0,), (1,)]
    assert rows(heavy_keys(ties, ("k",), 10, 2)) == []


def test_keys_beyond_the_bound_are_still_right(spark):
    df = skewed(spark, 6)
    lane = Lane(("k",), ("t", "i"), "t div 3", min_rows=0, max_heavy=2)
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    got = W.running_sum(df, lane, "v").select("i", "running")
    assert rows(got) == rows(df.select("i", F.sum("v").over(w)))
    cut = lay_out(df, lane).where(f"{CHUNK} is not null").select("k").distinct().count()
    assert cut == 2


@pytest.mark.parametrize("min_rows", [0, 20, 10**6])
def test_a_null_key_is_a_key_and_is_cut(spark, min_rows):
    df = skewed(spark, 9).withColumn("k", F.nullif("k", F.lit(0)))
    lane = Lane(("k",), ("t", "i"), "t div 3", min_rows=min_rows)
    w = Window.partitionBy("k").orderBy("t", "i")
    plain = df.select("i", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(W.running_sum(df, lane, "v").select("i", "running")) == rows(plain)
    before = df.withColumn("prev", F.lag("v").over(w)).where("v > prev").select("i", "prev")
    assert rows(W.increases(df, lane, "v").select("i", "prev")) == rows(before)
    ranked = W.dense_rank_by(df, ("k",), "v", "_down div 2", min_rows=min_rows).where("v is not null")
    w = Window.partitionBy("k").orderBy(F.desc("v"))
    assert rows(ranked.select("i", "rank")) == rows(df.where("v is not null").select("i", F.dense_rank().over(w)))
    cut = lay_out(df, lane).where(f"k is null and {CHUNK} is not null").count()
    assert (cut > 0) == (min_rows < 50)


def test_numbers_beyond_all_bounds(spark):
    odd = [float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.5, -2.5, 7.0, None]
    df = literal(spark, [(i, i % 2, x) for i, x in enumerate(odd * 2)], "i int, k int, v double")
    known = df.where("v is not null")
    for key, min_rows in (((), 0), (("k",), 0), (("k",), 10**6)):
        got = W.dense_rank_by(known, key, "v", number_cell("_down", 2), min_rows=min_rows)
        w = Window.partitionBy(*key).orderBy(F.desc("v"))
        assert rows(got.select("i", "rank")) == rows(known.select("i", F.dense_rank().over(w)))
    smaller = J.theta_counts(df, df, "v", "v", number_cell("_val", 2)).select("i", "n_smaller")
    right = known.select(F.col("v").alias("w"))
    want = known.join(right, F.col("v") > F.col("w"), "left").groupBy("i").agg(F.count("w"))
    assert {r[0]: r[1] for r in smaller.collect()} == {**{8: 0, 17: 0}, **dict(map(tuple, want.collect()))}
    pairs = J.theta_join(df.select("i", "v"), right, "v", "w")
    assert pairs.count() == known.join(right, F.col("v") > F.col("w")).count()


def test_large_integers_keep_their_order(spark):
    big = 2**53
    left = literal(spark, [(big + 1,), (big,), (None,)], "v bigint")
    right = literal(spark, [(big,), (big - 1,)], "w bigint")
    assert rows(J.theta_join(left, right, "v", "w")) == [(big, big - 1), (big + 1, big - 1), (big + 1, big)]


def test_pairs_of_one_small_file_are_made_in_many_tasks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(J, "PAIRS", 1000, raising=False)
    skewed(spark, 21).selectExpr("i", "double(v) v").coalesce(1).write.parquet(f"{tmp_path}/left")
    skewed(spark, 22).selectExpr("i as j", "double(v) w").coalesce(1).write.parquet(f"{tmp_path}/right")
    left, right = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("left", "right"))
    pairs = J.theta_join(left, right, "v", "w")
    assert pairs.select(F.spark_partition_id()).distinct().count() > 4
    want = rows(left.join(right, F.col("v") > F.col("w")))
    assert rows(pairs) == want
    # a right side too large to be broadcast
    assert rows(J.theta_join(left, right, "v", "w", max_bytes=0)) == want


def test_pairs_in_tiles_are_those_of_a_plain_join(spark, monkeypatch):
    monkeypatch.setattr(J, "RUN", 4, raising=False)
    monkeypatch.setattr(J, "STRIP", 2, raising=False)
    odd = [float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.5, -2.5, 7.0, 7.0, 1e300, None]
    some = [*odd, *[7.0] * 30, *range(-20, 40)]
    left = literal(spark, [(i, x if x is None else float(x)) for i, x in enumerate(some)], "i int, v double")
    right = left.selectExpr("i div 2 as j", "v + 0.5 as w").unionByName(left.selectExpr("i as j", "v as w"))
    for which in ("true", "j in (3, 4, 5)", "j = 10", "false"):
        few = right.where(which)
        want = rows(left.join(few, F.col("v") > F.col("w")).select("i", "j"))
        for pairs in (400, 1 << 25):
            monkeypatch.setattr(J, "PAIRS", pairs)
            assert rows(J.theta_join(left, few, "v", "w").select("i", "j")) == want, (which, pairs)


def test_files_of_pairs_are_small(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(J, "PAIRS", 1 << 20)
    left = spark.range(0, 1000, 1, 2).selectExpr("id as i", "rand(5) as v")
    right = spark.range(0, 3000, 1, 2).selectExpr("id as j", "rand(6) as w")
    left.write.parquet(f"{tmp_path}/left")
    right.write.parquet(f"{tmp_path}/right")
    left, right = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("left", "right"))
    J.theta_join(left, right, "v", "w").write.parquet(f"{tmp_path}/pairs")
    read, plain = spark.read.parquet(f"{tmp_path}/pairs"), left.join(right, F.col("v") > F.col("w"))
    total = [F.count("*"), F.sum(F.xxhash64("i", "v", "j", "w").cast("decimal(20)"))]
    pairs = read.agg(*total).first()
    assert pairs == plain.agg(*total).first()
    size = sum(p.stat().st_size for p in (tmp_path / "pairs").glob("*.parquet"))
    assert size < pairs[0], f"{size} bytes for {pairs[0]} pairs"


@pytest.mark.parametrize("min_rows", [0, 20, 10**6])
def test_tied_order_values_share_a_total(spark, min_rows):
    df = skewed(spark, 10).withColumn("k", F.nullif("k", F.lit(1)))
    lane = Lane(("k",), ("t",), "t div 3", min_rows=min_rows)
    w = Window.partitionBy("k").orderBy("t")  # the default frame is a RANGE
    got = W.running_sum_tied(df, lane, "v").select("i", "running")
    assert rows(got) == rows(df.select("i", F.sum("v").over(w)))


def test_pivot_loses_no_category(spark):
    acts = [(1, "view", 10), (1, "brandnew", 5), (2, None, 3)]
    df = literal(spark, acts, "user bigint, action string, cnt bigint")
    assert rows(A.pivot_sum(df, ["user"], "action", "cnt", ["view"])) == [(1, 10, 5), (2, 0, 3)]
    found = A.pivot_sum(df, ["user"], "action", "cnt")
    assert found.columns == ["user", "null", "brandnew", "view"]
    assert rows(found) == [(1, 0, 5, 10), (2, 3, 0, 0)]
    with pytest.raises(ValueError, match="more than 2"):
        A.pivot_sum(df, ["user"], "action", "cnt", most=2)


def test_empty_input(spark):
    df = literal(spark, [], "k int, t int, i int, v int")
    for lane in LANES:
        assert rows(W.running_sum(df, lane, "v")) == []
        assert rows(W.increases(df, lane, "v")) == []
        assert rows(W.moving_avg(df, lane, "v", 3)) == []


def test_missing_column_fails_before_any_job(spark):
    df = literal(spark, [(1,)], "k int")
    with pytest.raises(ValueError, match="missing columns"):
        lay_out(df, LANES[0])


def test_dense_rank_with_and_without_key_agree(spark):
    df = skewed(spark, 7).where("v is not null").withColumn("one", F.lit(1))
    overall = W.dense_rank_by(df, (), "v", "_down div 2").select("i", "rank")
    keyed = W.dense_rank_by(df, ("one",), "v", "_down div 2", min_rows=0).select("i", "rank")
    plain = df.select("i", F.dense_rank().over(Window.orderBy(F.desc("v"))))
    assert rows(overall) == rows(keyed) == rows(plain)


@pytest.mark.parametrize("n", [0, 3, 5, 23])
def test_equal_groups_match_ntile(spark, n):
    df = literal(spark, [(i % 3, i) for i in range(n)], "m int, id int")
    got = U.equal_groups(df, ("m", "id"), ("m", "id div 2"), 5, "g").select("id", "g")
    assert rows(got) == rows(df.select("id", F.ntile(5).over(Window.orderBy("m", "id"))))


@pytest.mark.parametrize("n", [0, 1, 3, 5, 23, 60])
def test_border_groups_match_ntile(spark, n):
    """Crowded values, single values, nulls in a metric and in the key, fewer rows than groups."""
    made = [(None if i % 7 == 3 else i % 3, -i, 5, i * 37 % n if i else None) for i in range(n)]
    df = literal(spark, made, "m int, only int, same int, id int")
    metrics = {"g1": "m", "g2": "only", "g3": "same"}
    got = U.border_groups(df, metrics, "id", 5)
    plain = [F.ntile(5).over(Window.orderBy(c, "id")).cast("bigint").alias(a) for a, c in metrics.items()]
    assert rows(got.select("id", *metrics)) == rows(df.select("id", *plain))


def test_border_groups_neither_sort_nor_shuffle_the_table(spark):
    df = literal(spark, [(i % 2, i) for i in range(40)], "m int, id int")
    plan = U.border_groups(df, {"g": "m"}, "id", 4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


@pytest.mark.parametrize("max_bytes", [0, 10_000])
def test_attach_both_ways(spark, max_bytes):
    df = skewed(spark, 8)
    lookup = literal(spark, [(0, "a"), (1, "b")], "k int, name string")
    for how in ("inner", "left", "left_anti"):
        got = attach(df, lookup, ["k"], how, max_bytes=max_bytes, salts=4)
        assert rows(got) == rows(df.join(lookup, ["k"], how))
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            attach(df, lookup, ["k"], how, max_bytes=max_bytes)
    unnamed = literal(spark, [(None, "c")], "k int, name string")
    got = attach(df.withColumn("k", F.nullif("k", F.lit(0))), unnamed, ["k"], max_bytes=max_bytes, salts=4)
    assert got.count() == df.where("k = 0 or k is null").count()


def test_spans_longer_than_a_block(spark):
    df = literal(spark, [("a", 1, 200_000), ("b", 5, 4), ("c", 7, 7)], "k string, a int, b int")
    got = explode_span(df, "a", "b", "n").groupBy("k").agg(
        F.count("*"), F.min("n"), F.max("n"), F.countDistinct("n")
    )
    assert rows(got) == [("a", 200_000, 1, 200_000, 200_000), ("c", 1, 7, 7, 1)]


def cell_sizes(df, order):
    """Rows by counted cell; checks that cells follow the order."""
    found = counted_cells(df, order)
    numbered = df.withColumn("cell", F.lit(0) if found is None else found)
    spans = numbered.groupBy("cell").agg(
        F.count("*").alias("n"), F.min(F.struct(*order)).alias("low"), F.max(F.struct(*order)).alias("high")
    )
    found = spans.orderBy("cell").withColumn("next", F.lead("low").over(Window.orderBy("cell")))
    assert found.where("high >= next").count() == 0
    return [r["n"] for r in found.collect()]


def test_cells_hold_about_equal_numbers_of_rows(spark, monkeypatch):
    monkeypatch.setattr(cells, "ROWS", 500)
    monkeypatch.setattr(cells, "PICKED", 16)
    n = 20_000
    rows = spark.range(n).select("id", (F.col("id") % 3).alias("few"), F.exp(F.col("id") / 50).alias("steep"))
    for order in (("id",), ("steep",), ("few", "id")):
        sizes = cell_sizes(rows, order)
        assert sum(sizes) == n and max(sizes) <= cells.CROWDED * 500 and len(sizes) >= n / 1000


def test_all_rows_in_one_minute_are_still_spread(spark, monkeypatch):
    monkeypatch.setattr(cells, "ROWS", 500)
    monkeypatch.setattr(cells, "PICKED", 16)
    at = F.lit("2024-01-01 00:00:10").cast("timestamp_ntz")
    burst = spark.range(10_000).select("id", F.when(F.col("id") % 10 > 0, at).otherwise(at + F.expr("make_dt_interval(id)")).alias("ts"))
    sizes = cell_sizes(burst, ("ts", "id"))
    assert max(sizes) <= cells.CROWDED * 500
    total = W.running_sum(burst, Lane((), ("ts", "id")), "id")
    want = burst.withColumn("running", F.sum("id").over(Window.orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(total.select("id", "running")) == rows(want.select("id", "running"))


def test_cells_of_any_type(spark):
    data = [
        (i, None if i % 7 == 0 else float("nan") if i % 11 == 0 else i / 3 - 9, f'{"ä" * (i % 3)}"\\{i % 5}', i % 2 == 0)
        for i in range(200)
    ] + [(200, float("inf"), "z", None), (201, float("-inf"), None, True)]
    df = literal(spark, data, "i int, x double, s string, b boolean").withColumns(
        {"d": F.expr("try_cast(x AS decimal(12,3))"),
         "day": F.date_add(F.lit("2024-01-01"), F.col("i") % 9), "f": F.col("x").cast("float")}
    )
    for order in (("x", "i"), ("s", "b", "i"), ("d", "i"), ("day", "i"), ("f", "i"), ("b", "i")):
        sizes = cell_sizes(df, order)
        assert sum(sizes) == 202 and len(sizes) > 5, order


def test_equal_tuples_stay_together(spark):
    same = spark.range(400).select(F.lit(1).alias("t"), (F.col("id") % 2).alias("i"))
    assert sum(cell_sizes(same, ("t", "i"))) == 400
    assert cell_sizes(same.where("false"), ("t", "i")) == []


def test_carries_of_many_cells_pass_two_levels(spark):
    df = skewed(spark, 7, 600)
    lane = Lane((), ("t", "i"), "t")
    got = with_running(lay_out(df, lane), lane, {"s": ("sum", "v"), "m": ("min", "v"), "l": ("last", "v"), "c": ("count", "v")})
    w = Window.orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("i", F.sum("v").over(w), F.min("v").over(w), F.last("v", True).over(w), F.count("v").over(w))
    assert rows(got.select("i", "s", "m", "l", "c")) == rows(want)
    number = W.sessionize(
        df.withColumn("ts", F.timestamp_seconds("t")), Lane((), ("ts", "i"), "unix_seconds(ts)"), "ts", 0
    )
    gaps = df.withColumn("new", (F.col("t") > F.lag("t").over(Window.orderBy("t", "i"))).cast("int"))
    want = gaps.select("i", F.coalesce(F.sum("new").over(Window.orderBy("t", "i")), F.lit(0)))
    assert rows(number.select("i", "session")) == rows(want)


def test_intervals_of_positions_are_the_pairs(spark):
    df = skewed(spark, 11, 90)
    left = df.select(F.col("i").alias("l"), F.col("v").alias("lv"))
    right = df.select(F.col("i").alias("r"), (F.col("t") % 6).alias("rv")).where("r % 4 > 0")
    right = right.withColumn("rv", F.when(F.col("r") % 5 > 0, F.col("rv")))
    ranked = J.with_positions(right, "rv", "r")
    asked = J.theta_counts(left, right, "lv", "rv").withColumn("first", F.lit(1))
    got = J.at_positions(asked, ranked, "first", "n_smaller")
    want = left.join(right, F.col("lv") > F.col("rv"))
    assert rows(got.select("l", "r")) == rows(want.select("l", "r"))
    assert rows(ranked.select("position")) == rows(spark.range(1, ranked.count() + 1))

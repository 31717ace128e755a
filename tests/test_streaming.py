"""Streams over several files: lateness, restarts, repeated batches, state."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from oracle import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanewise.operators import governance as G
from lanewise.sources.tables import literal
from lanewise.streaming import windows as W
from lanewise.streaming import late as L
from lanewise.streaming import medallion as M
from lanewise.streaming import stateful
from lanewise.streaming.medallion import read_gold, run_medallion
from lanewise.streaming.runs import EVENT_SCHEMA, event_stream, new_folder, run_available
from lanewise.streaming.stateful import stream_increases

START = dt.datetime(2024, 1, 1)


def event(i: int, minute: float, user: int = 1, kind: str = "view", value: float = 1.0):
    return (i, START + dt.timedelta(minutes=minute), user, kind, value, '{"k": %d}' % i)


class Feed:
    """A source folder that files are added to, one run after another."""

    def __init__(self, spark):
        self.spark, self.home = spark, new_folder(spark, "feed")

    def add(self, *events):
        df = literal(self.spark, events, EVENT_SCHEMA).coalesce(1)
        df.write.mode("append").parquet(f"{self.home}/src")

    def run(self, build):
        stream = build(event_stream(self.spark, f"{self.home}/src"))
        return run_available(stream, f"{self.home}/checkpoint", f"{self.home}/table")

    def table(self):
        return self.spark.read.parquet(f"{self.home}/table")


@pytest.fixture
def feed(spark):
    return Feed(spark)


def test_windows_close_once_and_late_rows_are_counted(feed):
    def build(s):
        return W.click_counts(s, ["event_type"], "10 minutes", "10 minutes")

    feed.add(event(1, 1), event(2, 5), event(3, 35))
    first = feed.run(build)
    feed.add(event(4, 2), event(5, 26), event(6, 60))  # minute 2 is late, minute 26 is not
    second = feed.run(build)
    assert W.late_rows(first.progress) == 0
    assert W.late_rows(second.progress) == 1
    minute = (F.unix_seconds("window_start") - int(START.replace(tzinfo=dt.timezone.utc).timestamp())) / 60
    assert rows(feed.table().select(minute.cast("int"), "n")) == [(0, 2), (20, 1), (30, 1)]


def test_late_rows_are_a_table(spark, feed):
    """Every row is in time or late, once: over restarts, batches sent again, rows without a time."""
    feed.add(event(1, 1), event(2, 60), event(1, 2))
    stream = event_stream(spark, f"{feed.home}/src", files_per_trigger=1)
    home = f"{feed.home}/split"

    def go():
        L.split_late(stream, home, f"{feed.home}/splitting", "10 minutes")
        return run_available(
            W.stream_dedup(L.in_time(stream, home), ["event_id"], "10 minutes"),
            f"{feed.home}/checkpoint",
            f"{feed.home}/table",
        )

    go()
    assert L.late_table(stream, home).count() == 0
    feed.add((3, None, 1, "view", 1.0, "{}"), event(4, 50), event(5, 50.001), event(6, 90))
    feed.add(event(7, 79), event(8, 81))
    second = go()
    late = L.late_table(stream, home)
    assert rows(late.select("event_id", "batch")) == [(4, 1), (7, 2)]
    assert late.columns == [*stream.columns, "batch"]
    assert rows(feed.table().select("event_id")) == [(i,) for i in (1, 2, 3, 5, 6, 8)]
    assert W.late_rows(second.progress) == 0
    go()  # nothing new
    assert late.count() == 2 and feed.table().count() == 6


def test_late_rows_of_a_batch_sent_again(spark, feed):
    """All micro-batches come again under their own numbers: marked ones stay, others are written over."""
    feed.add(event(1, 60))
    stream = event_stream(spark, f"{feed.home}/src", files_per_trigger=1)
    home = f"{feed.home}/split"
    L.split_late(stream, home, f"{feed.home}/first", "10 minutes")
    files = sorted(L.late_table(stream, home).inputFiles())
    feed.add(event(2, 10), event(3, 70))
    # a batch that failed after its rows were written and before its mark
    literal(spark, [event(9, 5)], EVENT_SCHEMA).withColumns(
        {"late": F.lit(True), "ts": F.col("ts").cast("timestamp")}
    ).write.partitionBy("late").parquet(f"{home}/rows/batch=1")
    L.split_late(stream, home, f"{feed.home}/again", "10 minutes")
    late = L.late_table(stream, home)
    assert rows(late.select("event_id", "batch")) == [(2, 1)]
    written = spark.read.parquet(f"{home}/rows")
    assert rows(written.select("event_id")) == [(1,), (2,), (3,)]
    assert set(files) <= set(written.inputFiles())


def test_sliding_windows_overlap(feed):
    feed.add(event(1, 20), event(2, 200))
    feed.run(lambda s: W.sliding_counts(s, [], "1 hour", "15 minutes", "1 hour"))
    assert feed.table().where("n = 1").count() == 4


def test_sessions_split_past_the_gap_only(feed):
    feed.add(event(1, 0), event(2, 30), event(3, 60.001), event(4, 500))
    feed.run(lambda s: W.stream_sessions(s, "user_id"))
    assert rows(feed.table().select("n")) == [(1,), (2,)]


def test_dedup_across_runs(feed):
    def build(s):
        return W.stream_dedup(s, ["event_id"])

    feed.add(event(1, 0), event(1, 0), event(2, 1))
    feed.run(build)
    feed.add(event(2, 1), event(3, 2))
    feed.run(build)
    assert rows(feed.table().select("event_id")) == [(1,), (2,), (3,)]


def test_nothing_is_written_twice_without_new_files(feed):
    feed.add(event(1, 0), event(2, 300))
    for _ in range(2):
        feed.run(lambda s: W.click_counts(s, [], "10 minutes", "10 minutes"))
    assert feed.table().count() == 1


def test_increases_follow_event_time_not_arrival(feed):
    def build(s):
        return stream_increases(s, "user_id", "event_id", "value", watermark="1 hour")

    feed.add(event(1, 0, value=5.0), event(3, 20, value=7.0), event(9, 30, user=2, value=1.0))
    feed.run(build)
    feed.add(event(2, 10, value=6.0), event(4, 30, value=6.5), event(5, 300, value=1.0))
    feed.run(build)
    feed.add(event(6, 310, value=2.0), event(7, 900, value=0.0))
    feed.run(build)
    assert rows(feed.table()) == [(1, 2, 6.0, 5.0), (1, 3, 7.0, 6.0), (1, 6, 2.0, 1.0)]


def test_increases_of_many_waiting_rows(spark, feed, monkeypatch):
    """Many rows of one key wait, in one bucket and over many, and come out as a plain window has them."""
    monkeypatch.setattr(stateful, "CHUNK", 64)
    rng = random.Random(9)
    events = [event(i, rng.choice([5, 5.5, rng.uniform(0, 300)]), value=rng.choice([1.0, 2.0, 3.5, None])) for i in range(2000)]
    build = lambda s: stream_increases(s, "user_id", "event_id", "value", watermark="6 hours")
    for at in range(0, 2000, 700):
        feed.add(*events[at : at + 700])
        feed.run(build)
    assert feed.table().count() == 0  # all of it waits
    events += [event(9000, 500, user=2), event(9001, 60 * 24 * 9, user=2, value=0.0)]
    feed.add(*events[2000:])
    feed.run(build)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    seen = literal(spark, events[:-1], EVENT_SCHEMA).withColumn("prev", F.lag("value").over(w))
    assert rows(feed.table()) == rows(seen.where("value > prev").select("user_id", "event_id", "value", "prev"))


def test_a_timer_reads_no_bucket_ahead_of_the_watermark(monkeypatch):
    """A million rows wait behind one due row; only the bucket of that one is read."""

    class Map(dict):
        reads: list = []

        def getValue(self, k):
            self.reads.append(k)
            return self[k]

        updateValue, removeKey, containsKey = dict.__setitem__, dict.__delitem__, dict.__contains__

        def iterator(self):
            return iter(list(self.items()))

    class Value:
        held = None
        exists = lambda self: self.held is not None
        get = lambda self: self.held
        update = lambda self, v: setattr(self, "held", v)

    class Handle:
        timers: list = []
        maps: dict = {}
        getMapState = lambda self, name, *_: self.maps.setdefault(name, Map())
        getValueState = lambda self, *_: Value()
        registerTimer = lambda self, ms: self.timers.append(ms)

    class Now:
        getCurrentWatermarkInMs = lambda self: 10

    n, minute = 1_000_000, 60_000_000
    handle, state = Handle(), stateful.Increases()
    state.init(handle)
    us = np.concatenate([[5_000, 7_000], minute + np.arange(n) * 3600]).astype("int64")
    waiting = pd.DataFrame({"us": us, "row_id": np.arange(n + 2), "val": np.arange(n + 2) * 1.0})
    assert list(state.handleInputRows(("k",), iter([waiting]), Now())) == []
    assert len(handle.maps["buckets"]) == 61
    handle.maps["rows"].reads.clear()
    (got,) = state.handleExpiredTimer(("k",), Now(), None)
    assert got.values.tolist() == [["k", 1, 1.0, 0.0]]
    assert {b for b, *_ in handle.maps["rows"].reads} == {0} and handle.timers[-1] == 60_000
    assert sum(len(v[0]) for v in handle.maps["rows"].values()) == n * stateful.ROW.itemsize


def test_scattered_rows_cost_few_state_calls(monkeypatch):
    """Rows minutes apart share entries, few or many, whatever their order of arrival, and come out in order."""
    calls = []

    class Map(dict):
        def updateValue(self, k, v):
            calls.append(k)
            self[k] = v

        def removeKey(self, k):
            calls.append(k)
            del self[k]

        getValue, containsKey = dict.__getitem__, dict.__contains__
        iterator = lambda self: iter(list(self.items()))

    class Value:
        held = None
        exists = lambda self: self.held is not None
        get = lambda self: self.held
        clear = lambda self: self.update(None)

        def update(self, v):
            calls.append("value")
            self.held = v

    class Handle:
        timers: list = []
        getMapState = lambda self, *_: Map()
        getValueState = lambda self, *_: Value()
        registerTimer = lambda self, ms: self.timers.append(ms)

    class Now:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    monkeypatch.setattr(stateful, "CHUNK", 256)
    rng = np.random.default_rng(4)
    minutes = 20_000
    for n in (200, 5000):
        # of one minute more rows than an entry holds; some rows before all that came first
        us = rng.choice(np.arange(minutes), n, replace=False) * 60_000_000
        us[: n // 10] = 7000 * 60_000_000 + np.arange(n // 10)
        rows = pd.DataFrame({"us": us, "row_id": np.arange(n), "val": rng.integers(0, 50, n) * 1.0})
        rows = rows.sort_values("us", ascending=False, ignore_index=True).sample(frac=1.0, random_state=1)
        state = stateful.Increases()
        state.init(Handle())
        calls.clear()
        parts = [rows[k * n // 4 : (k + 1) * n // 4] for k in range(4)]
        for part in parts:
            assert list(state.handleInputRows(("k",), iter([part]), None)) == []
        assert Handle.timers[-1] <= -(-rows["us"].min() // 1000)
        got = []
        for ms in (minutes * 20_000, minutes * 60_000):
            got += [r for pdf in state.handleExpiredTimer(("k",), Now(ms), None) for r in pdf.values.tolist()]
        ordered = rows.sort_values(["us", "row_id"])
        prev = ordered["val"].shift()
        up = ordered[ordered["val"] > prev]
        assert got == [["k", *r] for r in zip(up["row_id"], up["val"], prev[ordered["val"] > prev])]
        # a call for each row and more without shared entries
        assert len(calls) < (12 if n == 200 else n // 4)


def test_silence_of_any_length_is_no_new_start(feed):
    def build(s):
        return stream_increases(s, "user_id", "event_id", "value", watermark="1 minute")

    day = 24 * 60
    feed.add(event(1, 0, value=1.0), event(2, 39 * day, user=2, value=0.0))
    feed.run(build)
    feed.add(event(3, 40 * day, value=2.0), event(4, 41 * day, user=2, value=0.0))
    feed.run(build)
    assert rows(feed.table()) == [(1, 3, 2.0, 1.0)]


def test_progress_of_every_batch_is_kept(feed, spark):
    for i in range(8):
        feed.add(event(i, i))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "4")
    try:
        unique = W.stream_dedup(event_stream(spark, f"{feed.home}/src", files_per_trigger=1), ["event_id"])
        run = run_available(unique, f"{feed.home}/checkpoint", f"{feed.home}/table")
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert sum(p.numInputRows for p in run.progress) == 8


def test_medallion_goes_on_where_it_stopped(spark):
    home = new_folder(spark, "medallion")
    everything = [event(i, 7 * i, user=i % 3, kind="view" if i % 2 else "click") for i in range(40)]
    for part in (everything[:25], everything[20:]):  # five events arrive twice
        literal(spark, part, EVENT_SCHEMA).write.mode("append").parquet(f"{home}/src")
        run_medallion(spark, f"{home}/src", f"{home}/out", f"{home}/checkpoint")
    want = G.gold(G.silver(literal(spark, everything, EVENT_SCHEMA)))
    assert rows(read_gold(spark, f"{home}/out").select(*want.columns)) == rows(want)


def test_medallion_takes_late_and_corrected_events(spark):
    home = new_folder(spark, "medallion")
    day = 24 * 60
    first = [event(1, 0, value=1.0), event(2, 10 * day, value=1.0)]
    later = [event(3, 5 * day, value=2.0), (1, START + dt.timedelta(minutes=1), 1, "view", 5.0, '{"k": 1}')]
    for part in (first, later):
        literal(spark, part, EVENT_SCHEMA).write.mode("append").parquet(f"{home}/src")
        run_medallion(spark, f"{home}/src", f"{home}/out", f"{home}/checkpoint", files_per_trigger=1)
    want = rows(G.gold(G.silver(literal(spark, first + later, EVENT_SCHEMA))))
    assert rows(read_gold(spark, f"{home}/out")) == want


def folders(spark, home):
    """Data files by layer, batch and day."""
    found = {}
    for layer in ("silver", "gold"):
        table = spark.read.parquet(f"{home}/out/{layer}").select("batch", "day", F.input_file_name().alias("f"))
        for r in table.distinct().collect():
            found.setdefault((layer, r["batch"], str(r["day"])), set()).add(r["f"])
    return found


def add(spark, home, *events):
    literal(spark, events, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{home}/src")
    return run_medallion(spark, f"{home}/src", f"{home}/out", f"{home}/checkpoint")


def test_a_small_file_rewrites_its_own_days_only(spark):
    home, day = new_folder(spark, "medallion"), 24 * 60
    add(spark, home, *[event(i, i * day, user=i % 4) for i in range(20)])
    before = folders(spark, home)
    # one new event of day 3; event 8 moves from day 8 to day 11
    later = [event(100, 3 * day + 5, user=9), (8, START + dt.timedelta(days=11), 0, "click", 2.0, None)]
    served = add(spark, home, *later)
    after = folders(spark, home)
    fresh = {k: v for k, v in after.items() if k not in before}
    assert {k: v for k, v in after.items() if k in before} == before
    assert {d for _, n, d in fresh} == {"2024-01-04", "2024-01-12"} and {n for _, n, _ in fresh} == {1}
    # day 8 lost its only event: listed as written, without a folder
    assert {str(d) for d, n in M.written_days(spark, f"{home}/out").items() if n == 1} == {
        "2024-01-04", "2024-01-09", "2024-01-12"
    }
    everything = [event(i, i * day, user=i % 4) for i in range(20)] + later
    want = G.silver(literal(spark, everything, EVENT_SCHEMA))
    assert rows(served) == rows(G.gold(want))
    assert rows(M.read_silver(spark, f"{home}/out").select(*want.columns)) == rows(want)


def test_a_repeated_batch_changes_nothing(spark):
    out, day = f"{new_folder(spark, 'medallion')}/out", 24 * 60
    batches = [
        [event(i, i * day // 2, user=i) for i in range(6)],
        [event(3, 9 * day, user=3, value=7.0), event(50, day, user=8)],
        [event(3, 2 * day, user=5), event(51, 9 * day, user=1)],
    ]
    tables = [literal(spark, b, EVENT_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp")) for b in batches]
    seen = []
    for n, table in enumerate(tables):
        M.merge_batch(table, n, out)
        seen.append((rows(read_gold(spark, out)), rows(M.read_silver(spark, out))))
        M.merge_batch(table, n, out)  # the same batch, again
        assert (rows(read_gold(spark, out)), rows(M.read_silver(spark, out))) == seen[-1]
    assert seen[-1][0] == rows(G.gold(G.silver(literal(spark, sum(batches, []), EVENT_SCHEMA))))


def test_a_batch_that_failed_halfway_is_invisible(spark, monkeypatch):
    out = f"{new_folder(spark, 'medallion')}/out"
    tables = [
        literal(spark, b, EVENT_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
        for b in ([event(1, 0), event(2, 5)], [event(1, 3000, value=9.0)])
    ]
    M.merge_batch(tables[0], 0, out)
    before = rows(read_gold(spark, out))
    write = M._write

    def fails(df, path, *by):
        if path.endswith("/ids"):
            raise OSError("lost")
        write(df, path, *by)

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(M, "_write", fails)
        M.merge_batch(tables[1], 1, out)
    assert rows(read_gold(spark, out)) == before
    M.merge_batch(tables[1], 1, out)
    assert rows(read_gold(spark, out)) == rows(G.gold(G.silver(tables[0].unionByName(tables[1]))))


def test_vacuum_deletes_what_was_written_again(spark):
    home, day = new_folder(spark, "medallion"), 24 * 60
    add(spark, home, *[event(i, i * day) for i in range(4)])
    served = rows(add(spark, home, event(9, day)))
    assert M.vacuum(spark, f"{home}/out") == 2
    assert M.vacuum(spark, f"{home}/out") == 0
    assert rows(read_gold(spark, f"{home}/out")) == served
    assert rows(add(spark, home, event(10, day)))[1][2] == 3


def test_users_of_longer_spans_come_from_sketches(spark):
    out, start = f"{new_folder(spark, 'medallion')}/out", dt.datetime(2024, 1, 1)
    span = spark.range(60_000).select(
        F.col("id").alias("event_id"),
        (F.lit(start).cast("timestamp") + F.expr("make_dt_interval(cast(id % 21 AS int))")).alias("ts"),
        (F.col("id") % 7000).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"),
        F.lit(None).cast("string").alias("props"),
    )
    M.merge_batch(span.where("event_id % 2 = 0"), 0, out)
    M.merge_batch(span.where("event_id % 2 = 1"), 1, out)
    got = {str(r["week"]): r["users"] for r in M.read_users(spark, out).collect()}
    exact = span.groupBy(F.to_date(F.date_trunc("week", "ts")).alias("w")).agg(F.countDistinct("user_id").alias("n"))
    want = {str(r["w"]): r["n"] for r in exact.collect()}
    assert got.keys() == want.keys() and len(want) == 3
    assert all(abs(got[w] - want[w]) <= 0.06 * want[w] for w in want)

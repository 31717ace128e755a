"""Worked examples with known answers.

The input rows and the answers are fixed values.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from oracle import rows
from pyspark.sql import functions as F

from lanewise.functions import strings as S
from lanewise.operators import aggregates as A
from lanewise.operators import calendars as C
from lanewise.operators import corpus as X
from lanewise.operators import joins as J
from lanewise.operators import projections as P
from lanewise.operators import sequences as Q
from lanewise.operators import windows as W
from lanewise.plans.lanes import Lane, day_cell, minute_cell
from lanewise.sources.tables import as_view, catalog_table, literal


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def moment(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def sequence_of(spark, text: str):
    return literal(spark, [(1, i, c) for i, c in enumerate(text)], "k int, i int, c string")


BY_POSITION = Lane(("k",), ("i",), "i div 2")


@pytest.fixture(params=[False, True], ids=["light", "heavy"])
def cut(request):
    if request.param:
        request.getfixturevalue("all_heavy")


def test_tables(spark):
    df = literal(spark, [(1, "a")], "id bigint, name string")
    assert rows(as_view(df, "golden_t")) == rows(catalog_table(spark, "golden_t")) == [(1, "a")]


def test_signed_sum(spark):
    tx = [
        (1, "credit", 30.0),
        (1, "debit", 90.0),
        (2, "credit", 50.0),
        (3, "debit", 57.0),
        (2, "debit", 90.0),
    ]
    df = literal(spark, tx, "id bigint, type string, amount double")
    assert rows(A.signed_sum(df, ["id"], "type", "amount", "debit")) == [
        (1, -60.0),
        (2, -40.0),
        (3, -57.0),
    ]


def test_signed_sum_strict_leaves_other_kinds_out(spark):
    df = literal(spark, [(1, "fee", 5), (1, None, 7), (1, "credit", 1)], "id int, t string, a int")
    assert rows(A.signed_sum(df, ["id"], "t", "a", "debit")) == [(1, 13)]
    assert rows(A.signed_sum(df, ["id"], "t", "a", "debit", "credit")) == [(1, 1)]


def test_overlapping(spark, cut):
    logins = [
        (1, "2021-02-01 08:00:00", "2021-02-01 11:30:00"),
        (1, "2021-02-01 09:00:00", "2021-02-01 09:30:00"),
        (2, "2021-02-01 20:30:00", "2021-02-01 22:00:00"),
        (3, "2021-02-01 16:00:00", "2021-02-01 16:59:59"),
        (3, "2021-02-01 17:00:00", "2021-02-01 17:59:59"),
    ]
    data = [(a, moment(b), moment(c)) for a, b, c in logins]
    df = literal(spark, data, "account bigint, log_in timestamp, log_out timestamp")
    lane = Lane(("account",), ("log_in", "log_out"), minute_cell("log_in"))
    assert rows(W.overlapping(df, lane, "log_in", "log_out")) == [(1,)]


SALARIES = [(1, "A", 1000), (1, "A", 1001), (2, "B", 2000), (2, "B", 2001), (2, "B", 2002)]


def test_running_sums(spark, cut):
    df = literal(spark, SALARIES, "id bigint, name string, salary bigint")
    by_name = W.running_sum(df, Lane(("name",), ("salary",), "salary div 2"), "salary")
    assert rows(by_name.select("name", "running")) == [
        ("A", 1000),
        ("A", 2001),
        ("B", 2000),
        ("B", 4001),
        ("B", 6003),
    ]
    overall = W.running_sum(df, Lane((), ("id", "salary"), ("id", "salary div 2")), "salary")
    assert [r[0] for r in rows(overall.select("running"))] == [1000, 2001, 4001, 6002, 8004]


def test_dense_rank(spark, cut):
    df = literal(spark, SALARIES, "id bigint, name string, salary bigint")
    got = dict(rows(W.dense_rank_by(df, (), "salary", "_down div 2").select("salary", "rank")))
    assert got == {2002: 1, 2001: 2, 2000: 3, 1001: 4, 1000: 5}


def test_min_max(spark):
    emp = [("a", 2, 80000), ("b", 2, 80000), ("c", 2, 70000), ("d", 4, 70000)]
    df = literal(spark, emp, "emp string, dept bigint, salary bigint")
    assert rows(A.min_max(df, ["dept"], "salary")) == [(2, 70000, 80000), (4, 70000, 70000)]


def test_moving_avg(spark, cut):
    prices = [(1, 100), (2, 110), (3, 105), (4, 115), (5, 120), (6, 125)]
    df = literal(spark, [(d, "A", p) for d, p in prices], "day bigint, product string, price bigint")
    lane = Lane(("product",), ("day",), "day div 2")
    got = rows(W.moving_avg(df, lane, "price", 6).select("day", "moving"))
    assert got == [(1, 100.0), (2, 105.0), (3, 105.0), (4, 107.5), (5, 110.0), (6, 112.5)]


def test_moving_avg_without_key(spark):
    emp = [(5000, "2024-01-01"), (6000, "2024-02-15"), (5500, "2024-03-10"), (6200, "2024-04-05")]
    df = literal(spark, [(s, day(d)) for s, d in emp], "salary int, hired date")
    got = W.moving_avg(df, Lane((), ("hired",), day_cell("hired")), "salary", 3)
    assert rows(got.select(F.round("moving", 6))) == [(5000.0,), (5500.0,), (5500.0,), (5900.0,)]
    assert P.within_months(df, "hired", "2024-12-31").count() == 4


def test_explode(spark):
    users = [(1, ["a", "b"]), (2, ["x"]), (3, ["y", "z", "w"]), (4, []), (5, None)]
    df = literal(spark, users, "id bigint, tags array<string>")
    flat = [(1, "a"), (1, "b"), (2, "x"), (3, "w"), (3, "y"), (3, "z")]
    assert rows(C.explode_col(df, ["id"], "tags", "tag")) == flat
    outer = rows(C.explode_col(df, ["id"], "tags", "tag", outer=True))
    assert outer == [*flat, (4, None), (5, None)]


def test_clean_nulls(spark):
    df = literal(spark, [(None, None), (1, " "), (2, "x")], "id int, tags string")
    assert rows(P.clean_nulls(df)) == [(0, "NA"), (1, "NA"), (2, "x")]
    assert rows(P.clean_nulls(df, blanks=False))[1] == (1, " ")


def test_sessionize(spark, cut):
    stamps = ["2021-01-01 10:00:00", "2021-01-01 10:20:00", "2021-01-01 11:00:00"]
    df = literal(spark, [(1, moment(t)) for t in stamps], "user bigint, ts timestamp")
    lane = Lane(("user",), ("ts",), minute_cell("ts"))
    assert [r[0] for r in rows(W.sessionize(df, lane, "ts").select("session"))] == [0, 0, 1]


def test_sessionize_sees_fractions_of_a_second(spark, cut):
    stamps = ["2021-01-01 10:00:00.0", "2021-01-01 10:30:00.000", "2021-01-01 11:00:00.000001"]
    df = literal(spark, [(1, moment(t)) for t in stamps], "user bigint, ts timestamp")
    lane = Lane(("user",), ("ts",), minute_cell("ts"))
    assert [r[0] for r in rows(W.sessionize(df, lane, "ts").select("session"))] == [0, 0, 1]


def test_calendar_and_gaps(spark):
    df = literal(spark, [(1, day("2021-01-01")), (1, day("2021-01-04"))], "id bigint, d date")
    every = [(1, day(f"2021-01-0{i}")) for i in range(1, 5)]
    assert rows(C.calendar(df, ["id"], "d")) == every
    assert rows(C.missing_dates(df, ["id"], "d")) == every[1:3]
    gaps = [(1, day("2022-03-01")), (1, day("2022-03-02")), (1, day("2022-03-04"))]
    df = literal(spark, gaps, "id int, d date")
    assert rows(C.missing_dates(df, ["id"], "d")) == [(1, day("2022-03-03"))]


def test_pivot(spark):
    acts = [(1, "view", 10), (1, "click", 4), (2, "view", 3)]
    df = literal(spark, acts, "user bigint, action string, cnt bigint")
    got = A.pivot_sum(df, ["user"], "action", "cnt", ["view", "click"], other=None)
    assert rows(got) == [(1, 10, 4), (2, 3, 0)]
    got = A.pivot_sum(df, ["user"], "action", "cnt", ["view", "click"], fill=None, other=None)
    assert rows(got) == [(1, 10, 4), (2, 3, None)]


def test_distinct_per(spark):
    dev = [(1, "iOS"), (2, "Android"), (3, "iOS"), (2, "Android")]
    df = literal(spark, dev, "device bigint, os string")
    for approximate in (False, True):
        got = A.distinct_per(df, ["os"], "device", approximate=approximate)
        assert rows(got) == [("Android", 1), ("iOS", 2)]


def test_unique_and_duplicates(spark):
    df = literal(spark, [("apple", 20), ("orange", 15), ("apple", 30)], "product string, q int")
    assert rows(A.unique_values(df, ["product"])) == [("apple",), ("orange",)]
    assert rows(A.duplicates(df, ["product"])) == [("apple", 2)]
    assert rows(A.duplicates(df, ["q"])) == []


def test_theta_join(spark):
    left = literal(spark, [(1, 10), (2, 20), (3, 30), (4, None)], "id int, v int")
    right = literal(spark, [(1, 15), (2, 25), (3, 35), (4, None)], "rid int, w int")
    got = J.theta_join(left, right, "v", "w").select("id", "v", "w")
    assert rows(got) == [(2, 20, 15), (3, 30, 15), (3, 30, 25)]
    one = literal(spark, [(1, 15)], "rid int, w int")
    assert rows(J.theta_join(left, one, "v", "w").select("id")) == [(2,), (3,)]


def test_join_counts_with_nulls(spark):
    t1 = literal(spark, [(10,), (10,), (None,)], "id int")
    t2 = literal(spark, [(10,), (None,)], "id int")
    got = {h: J.join_counts(t1, t2, ["id"], h).first()[0] for h in ("inner", "left", "right", "full")}
    assert got == {"inner": 2, "left": 3, "right": 3, "full": 4}
    assert got == {h: t1.join(t2, "id", h).count() for h in got}
    assert J.join_counts(t1.where("id > 10"), t2, ["id"], "inner").first()[0] == 0


def test_nth_highest(spark):
    df = literal(spark, [(v,) for v in (3000, 4000, 4000, 5000, 6000)], "salary int")
    assert rows(W.nth_highest(df, [], "salary", 3)) == [(4000,)]
    assert rows(W.nth_by_offset(df, "salary", 3)) == [(4000,)]
    assert rows(W.nth_by_offset(df, "salary", 9)) == []


def test_always_increasing(spark, cut):
    cases = {"NY": (100, 150, 200), "LA": (80, 85, 83), "CHI": (120, 120, 120), "SF": (0, 1, 2)}
    data = [(c, day(f"2023-03-0{i}"), n) for c, ns in cases.items() for i, n in enumerate(ns, 1)]
    df = literal(spark, data, "city string, d date, cases int")
    lane = Lane(("city",), ("d",), day_cell("d"))
    assert rows(A.always_increasing(df, lane, "cases")) == [("NY",)]


def test_chain_counts(spark, cut):
    rides = [
        ("d1", "09:00", "A", "B"),
        ("d1", "09:30", "B", "C"),
        ("d1", "11:00", "D", "E"),
        ("d2", "08:00", "X", "Y"),
        ("d2", "08:50", "Y", "Z"),
    ]
    df = literal(spark, rides, "driver string, start string, a string, b string")
    lane = Lane(("driver",), ("start",), "cast(substr(start, 1, 2) as bigint)")
    assert rows(A.chain_counts(df, lane, "a", "b")) == [("d1", 3, 1), ("d2", 2, 1)]


def test_daily_balance(spark):
    tx = [
        ("deposit", 100, "2022-07-01"),
        ("withdrawal", 20, "2022-07-01"),
        ("deposit", 50, "2022-07-31"),
        ("withdrawal", 30, "2022-08-01"),
        ("deposit", 200, "2022-08-15"),
    ]
    df = literal(spark, [(t, a, day(d)) for t, a, d in tx], "type string, amount int, ts date")
    df = df.withColumn("signed", A.signed("type", "amount", "withdrawal"))
    for reset, want in ((None, [80, 130, 100, 300]), ("month", [80, 130, -30, 170])):
        got = W.daily_balance(df, "ts", "signed", reset)
        assert [r[1] for r in rows(got)] == want


NUMBERS = [(1, 1), (2, 1), (3, 2), (4, 2), (5, 2), (6, 3), (7, 4), (8, 4), (9, 4)]


@pytest.mark.parametrize("width", [1, 2, 4, 100])
def test_repeated_run(spark, width):
    df = literal(spark, NUMBERS, "id int, numbers int")
    lane = Lane((), ("id",), f"id div {width}")
    assert rows(W.repeated_run(df, lane, "numbers", 3)) == [(5, 2), (9, 4)]


@pytest.mark.parametrize("width", [1, 2, 100])
def test_increases(spark, width):
    temps = [("2024-03-01", 20), ("2024-03-02", 22), ("2024-03-03", 19), ("2024-03-04", 25)]
    df = literal(spark, [(day(d), t) for d, t in temps], "day date, temp int")
    lane = Lane((), ("day",), f"{day_cell('day')} div {width}")
    assert rows(W.increases(df, lane, "temp")) == [
        (day("2024-03-02"), 22, 20),
        (day("2024-03-04"), 25, 19),
    ]


def test_date_islands(spark):
    seen = {"A": (1, 2, 4), "B": (1, 3, 4), "C": (1, 2, 3, 3)}
    data = [(c, day(f"2024-10-0{i}")) for c, days in seen.items() for i in days]
    df = literal(spark, data, "channel string, d date")
    got = [(c, str(a)[-2:], str(b)[-2:]) for c, a, b in rows(W.date_islands(df, ["channel"], "d"))]
    assert got == [
        ("A", "01", "02"),
        ("A", "04", "04"),
        ("B", "01", "01"),
        ("B", "03", "04"),
        ("C", "01", "03"),
    ]


def test_casts(spark):
    df = spark.sql("select 1.2333234248012834012834012309481092348 as v")
    got = P.cast_profile(df, "v").first()
    assert got["as_decimal_10_4"] == got["as_decimal_18_4"] == Decimal("1.2333")
    assert got["as_decimal_38_10"] == Decimal("1.2333234248")
    assert got["as_float"] == pytest.approx(1.2333235, abs=1e-6)
    assert got["as_double"] == pytest.approx(1.2333234248012834)


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_string_functions(spark):
    assert value(spark, S.without(F.lit("hello"), "o")) == "hell"
    assert value(spark, S.is_anagram(F.lit("listen"), F.lit("silent"))) is True
    assert value(spark, S.is_anagram(F.lit("aab"), F.lit("abb"))) is False
    assert value(spark, S.is_rotation(F.lit("abcde"), F.lit("cdeab"))) is True
    assert value(spark, S.is_rotation(F.lit("abcde"), F.lit("abced"))) is False
    assert value(spark, S.is_palindrome(F.lit("madam"))) is True
    assert value(spark, S.rotation_key(F.lit("cdeab"))) == "abcde"
    assert value(spark, S.rotation_key(F.lit(""))) == ""
    assert value(spark, S.reversed_labels(F.lit("www.a.org"))) == "org.a.www"


@pytest.mark.parametrize(
    "text,ok",
    [("({[]})", True), ("({[)]}", False), ("", True), ("(", False), (")(", False), ("a(b)c", True)],
)
def test_brackets(spark, text, ok):
    assert value(spark, S.brackets_balanced(F.lit(text))) is ok


def test_char_histogram(spark):
    df = literal(spark, [("x", "Python")], "g string, t string")
    assert rows(X.char_histogram(df, "t", ["g"])) == sorted(("x", c, 1) for c in "Python")


def test_word_classes(spark):
    words = literal(spark, [(w,) for w in ("eat", "tea", "tan", "ate", "nat", "bat")], "w string")
    assert rows(X.anagram_groups(words, "w")) == [
        ("abt", 1, "bat"),
        ("aet", 3, "ate"),
        ("aet", 3, "eat"),
        ("aet", 3, "tea"),
        ("ant", 2, "nat"),
        ("ant", 2, "tan"),
    ]
    assert rows(X.anagram_pairs(words, "w")) == [("ate", "eat"), ("ate", "tea"), ("nat", "tan")]
    assert rows(X.rotation_pairs(words, "w")) == [("ate", "eat"), ("ate", "tea")]
    assert rows(X.palindromes(literal(spark, [("madam",), ("ab",)], "w string"), "w")) == [
        ("madam", 1)
    ]


def test_missing_numbers(spark, cut):
    df = literal(spark, [("k", n) for n in (1, 5, 6, 3, 4)], "k string, n int")
    assert rows(C.missing_numbers(df, ("k",), "n")) == [("k", 2)]
    got = rows(C.missing_numbers(df, ("k",), "n", upper=8))
    assert got == [("k", 2), ("k", 7), ("k", 8)]
    assert rows(C.missing_numbers(df, ("k",), "n", upper=3)) == [("k", 2)]
    wide = literal(spark, [("k", 300_000)], "k string, n int")
    assert C.missing_numbers(wide, ("k",), "n").count() == 299_999


def test_longest_distinct_run(spark, cut):
    got = Q.longest_distinct_run(sequence_of(spark, "abcbdfghjkabc"), BY_POSITION, "c")
    assert rows(got) == [(1, 9)]


def test_run_length(spark, cut):
    got = rows(Q.run_length(sequence_of(spark, "aaaabbbbccccaaa"), BY_POSITION, "c"))
    assert [(r[2], r[3]) for r in got] == [("a", 4), ("b", 4), ("c", 4), ("a", 3)]


def test_theta_counts(spark):
    left = literal(spark, [(1, 10), (2, 20), (3, 30), (4, 30), (5, None)], "id int, v int")
    right = literal(spark, [(15,), (25,), (30,), (25,), (None,)], "w int")
    got = J.theta_counts(left, right, "v", "w", "_val div 7").select("id", "n_smaller")
    assert rows(got) == [(1, 0), (2, 1), (3, 3), (4, 3), (5, 0)]

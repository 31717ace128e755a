"""Customer, finance, governance and similarity operators on small tables."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal
from html.parser import HTMLParser

import numpy as np
import pytest
from oracle import rows
from pyspark.sql import functions as F

from lanewise import session
from lanewise.functions import strings as S
from lanewise.functions import vectors as VF
from lanewise.operators import customers as U
from lanewise.operators import finance as N
from lanewise.operators import governance as G
from lanewise.operators import similarity as V
from lanewise.plans.lanes import Lane, day_cell, minute_cell
from lanewise.sources.tables import literal
from lanewise.streaming.runs import EVENT_SCHEMA, new_folder

DAY = dt.date.fromisoformat
AT = dt.datetime.fromisoformat


@pytest.mark.parametrize("min_rows", [0, 10**6])
def test_dwell_pairs_each_start_with_the_next_end(spark, min_rows):
    data = [
        (1, "2024-01-01 10:00:00", "in"),
        (1, "2024-01-01 10:10:00", "in"),
        (1, "2024-01-01 10:30:00", "out"),
        (1, "2024-01-01 10:40:00", "out"),  # nothing open
        (1, "2024-01-01 11:00:00", "in"),  # never closed
        (2, "2024-01-01 09:00:00", "out"),
        (3, "2024-01-01 23:59:00", "in"),
        (3, "2024-01-02 00:01:00", "out"),
    ]
    df = literal(spark, [(u, AT(t), k) for u, t, k in data], "u int, ts timestamp, kind string")
    lane = Lane(("u",), ("ts",), minute_cell("ts"), min_rows=min_rows)
    got = U.dwell(df, lane, "ts", "kind", "in", "out")
    assert rows(got) == [(1, 2, 50 * 60 * 10**6), (3, 1, 2 * 60 * 10**6)]


def test_latest_consent_wins(spark):
    df = literal(spark, [(1, 1, True), (1, 2, False), (2, 1, True)], "u int, t int, yes boolean")
    consent = U.latest_consent(df, "u", ["t"], F.col("yes"))
    assert rows(U.with_consent(df, consent, ["u"])) == [(2, 1, True)]


def test_cash_flow_keeps_months_of_either_side(spark):
    schema = "ts timestamp, amount decimal(18,2)"
    came = literal(spark, [(AT("2024-01-05"), Decimal(10)), (AT("2024-01-31"), Decimal(5))], schema)
    went = literal(spark, [(AT("2024-02-01"), Decimal(3))], schema)
    got = [(str(r[0]), *map(float, r[1:])) for r in rows(N.cash_flow(came, went))]
    assert got == [("2024-01-01", 15.0, 0.0, 15.0), ("2024-02-01", 0.0, 3.0, -3.0)]


#: Rates broadcast as arrays; in lanes of given cells, with every key cut and with none; in counted cells.
ASOF = [{}, {"max_bytes": 0, "cell": day_cell("d"), "min_rows": 0}, {"max_bytes": 0, "cell": day_cell("d")}, {"max_bytes": 0}]


@pytest.mark.parametrize("form", ASOF)
def test_asof_rate(spark, form):
    sales = literal(
        spark,
        [(1, "eur", DAY("2024-01-01")), (2, "eur", DAY("2024-01-09")), (3, "usd", DAY("2024-01-09"))],
        "id int, cur string, d date",
    )
    rates = literal(
        spark,
        [("eur", DAY("2024-01-02"), 1.1), ("eur", DAY("2024-01-09"), 1.2), ("gbp", DAY("2024-01-01"), 9.0)],
        "cur string, d date, rate double",
    )
    got = N.asof_rate(sales, rates, ["cur"], "d", "rate", "id", **form)
    assert rows(got.select("id", "rate")) == [(1, None), (2, 1.2), (3, None)]


@pytest.mark.parametrize("form", ASOF)
def test_asof_rate_of_odd_rows(spark, form):
    """Null keys, times and rates, repeated rates, and many rates a key."""
    rng = random.Random(4)
    day = lambda i: DAY("2024-01-01") + dt.timedelta(days=i)
    rates = [(rng.choice(["a", "b", None]), day(rng.randrange(90)), rng.choice([None, 1.0, 2.5, 4.0])) for _ in range(150)]
    rates += [("a", None, 9.0), (None, day(5), 7.0), (None, day(5), 8.0)]
    sales = [(i, rng.choice(["a", "b", "c", None]), rng.choice([None, day(rng.randrange(-5, 95))])) for i in range(120)]
    got = N.asof_rate(
        literal(spark, sales, "id int, cur string, d date"),
        literal(spark, rates, "cur string, d date, rate double"),
        ["cur"], "d", "rate", "id", **form,
    )

    def latest(cur, d):
        held = [(at, r) for c, at, r in rates if c == cur and at is not None and r is not None and d is not None and at <= d]
        return max(held)[1] if held else None

    assert rows(got.select("id", "rate")) == sorted([(i, latest(c, d)) for i, c, d in sales], key=repr)


def test_small_rates_move_no_row(spark):
    orders = literal(spark, [(1, "a", DAY("2024-01-05"))], "id int, cur string, d date")
    rates = literal(spark, [("a", DAY("2024-01-01"), 2.0)], "cur string, d date, rate double")
    plan = N.asof_rate(orders, rates, ["cur"], "d", "rate", "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Window") == 0
    assert N.asof_rate(orders, rates.where("false"), ["cur"], "d", "rate", "id").first()["rate"] is None


def test_zscore_of_a_constant_group_is_never_far(spark):
    df = literal(spark, [("a", 1.0)] * 5 + [("b", 0.0)] * 20 + [("b", 100.0)], "g string, v double")
    assert [r[1] for r in rows(N.zscore(df, ["g"], "v", 3.0).select("g", "v"))] == [100.0]


def test_forecast_continues_a_line(spark):
    df = literal(spark, [("a", i, 10.0 + 2 * i) for i in range(5)], "g string, p bigint, v double")
    got = N.linear_forecast(df, ["g"], "p", "v", 2).select("p", F.round("forecast", 6))
    assert rows(got) == [(5, 20.0), (6, 22.0)]


def test_compare_periods(spark):
    data = [("a", DAY("2023-05-01"), 10), ("a", DAY("2024-01-01"), 25), ("a", DAY("2024-02-01"), 1)]
    df = literal(spark, data, "g string, d date, v int")
    got = N.compare_periods(df, ["g"], "d", "v", "year").select("spend", "spend_before", "change")
    assert rows(got) == [(10, None, None), (26, 10, 16)]


def test_rules_count_null_as_failed(spark):
    df = literal(spark, [(1,), (-1,), (None,)], "v int")
    rules = {"positive": "v > 0", "known": "v is not null"}
    assert rows(G.check_rules(df, rules)) == [("known", 2, 1), ("positive", 1, 2)]
    bad = [(r[0], list(r[1])) for r in G.quarantine(df, rules).collect()]
    assert bad == [(-1, ["positive"]), (None, ["positive", "known"])]


def test_mask(spark):
    df = literal(spark, [(1, "write to a.b@c.example.com now"), (2, "no @ address")], "id int, t string")
    got = dict(r[::-1] for r in G.mask(df, "t", "id", "s3").collect())
    assert set(got) == {"write to <email> now", "no @ address"}
    assert all(len(h) == 64 for h in got.values())
    other = dict(r[::-1] for r in G.mask(df, "t", "id", "s4").collect())
    assert not set(got.values()) & set(other.values())
    with pytest.raises(ValueError):
        G.mask(df, "t", "id", "")


def test_entities_and_quoted_attributes(spark):
    page = """<p title="a>b">it&#8217;s &eacute;t&eacute; &#x1F600; &bogus; &#xD800; &amp;lt; a & b <br/> it's <b x='>'>c</b>"""
    got = literal(spark, [(page,)], "h string").select(S.visible_text(F.col("h"))).first()[0]
    assert got == "it’s été 😀 &bogus; &#xD800; &lt; a & b it's c"


def test_html(spark):
    page = (
        "<html><head><title>A &amp;lt; B</title><style>p{}</style><script>x='<p>'</script></head>"
        "<body><!-- no --><h1>Hi</h1>\n<p>a&nbsp;b &copy; 1</p></body></html>"
    )
    df = literal(spark, [(1, page)], "id int, html string")
    assert rows(G.html_text(df)) == [(1, "A &lt; B", "Hi a b © 1")]


def test_archive_write_prunes_by_tier(spark):
    data = [(i, DAY("2024-01-01") - dt.timedelta(days=100 * i)) for i in range(10)]
    df = literal(spark, data, "id int, d date")
    path = new_folder(spark, "archive")
    G.write_by_age(df, "d", "2024-01-01", 365, path)
    back = spark.read.parquet(path)
    hot = back.where("tier = 'hot'")
    assert sorted(r[0] for r in hot.select("id").collect()) == [0, 1, 2, 3]
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(tier#\d+\), \(tier#\d+ = hot\)\]", plan)
    assert rows(back.select("id", "d")) == rows(df)


def test_silver_keeps_the_last_version(spark):
    raw = [
        (1, AT("2024-01-01"), 7, " View ", 1.0, '{"k": 1}'),
        (1, AT("2024-01-02"), 7, "view", 2.0, '{"k": "x"}'),
        (None, AT("2024-01-02"), 7, "view", 2.0, "{"),
    ]
    clean = G.silver(literal(spark, raw, EVENT_SCHEMA))
    got = clean.first()
    assert clean.count() == 1
    assert (got["event_type"], got["value"], got["k"]) == ("view", Decimal("2.00"), None)


@pytest.mark.parametrize("batch", [2, 512])
def test_topk_against_brute_force_with_copies(spark, batch):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 8)).astype("float32")
    base[10:30] = base[5]  # half of the vectors are copies
    data = [(i, [float(x) for x in v]) for i, v in enumerate(base)] + [(99, [0.0] * 8)]
    vectors = literal(spark, data, "vec_id bigint, embedding array<float>").repartition(3)
    asked = [(q, data[q][1]) for q in (0, 5, 7, 20, 39)]
    queries = literal(spark, asked, "query_id bigint, embedding array<float>")
    got = V.cosine_topk(vectors, queries, k=4, batch=batch)
    unit = base.astype("float64")
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = []
    for q, _ in asked:
        scores = np.round(unit @ unit[q], 12)
        best = sorted(range(40), key=lambda i: (-scores[i], i))[:4]
        want += [(q, i, place) for place, i in enumerate(best, 1)]
    assert rows(got.select("query_id", "vec_id", "place")) == sorted(want, key=repr)


def test_many_queries_in_one_scan(spark, monkeypatch):
    monkeypatch.setattr(V, "QUERY_BLOCK", 7)
    base = np.random.default_rng(3).normal(size=(40, 6))
    data = [(i, v.tolist()) for i, v in enumerate(base)]
    vectors = literal(spark, data, "vec_id int, embedding array<double>")
    got = V.cosine_topk(vectors, vectors.withColumnRenamed("vec_id", "query_id"), k=1)
    assert rows(got.select("query_id", "vec_id")) == sorted([(i, i) for i in range(40)], key=repr)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas") == 1


def test_a_query_set_of_any_size_stays_a_table(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(300, 5))
    ids = [2**60 + 3 * i for i in range(300)]  # more digits than a double holds
    vectors = literal(spark, [(i, v.tolist()) for i, v in zip(ids, base)], "vec_id bigint, embedding array<double>")
    asked = literal(
        spark, [(f"q{i}", v.tolist()) for i, v in enumerate(base[:170] * 3)] + [("none", None)],
        "query_id string, embedding array<double>",
    ).repartition(4)
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    scores = np.round(unit[:170] @ unit.T, 12)
    want = [
        (f"q{q}", ids[i], place)
        for q in range(170)
        for place, i in enumerate(sorted(range(300), key=lambda i: (-scores[q][i], i))[:3], 1)
    ]

    def gathered(*_):
        raise AssertionError("queries went through the driver")

    with monkeypatch.context() as m:
        m.setattr(type(asked), "collect", gathered)
        m.setattr(type(asked), "toLocalIterator", gathered)
        got = V.cosine_topk(vectors, asked, k=3, batch=32)
    assert rows(got.select("query_id", "vec_id", "place")) == sorted(want, key=repr)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2


def test_best_k_breaks_ties_by_id():
    ids, scores = V.best_k(np.array([9, 3, 5, 1]), np.array([[1.0, 1.0, 1.0, 0.5]]), 2)
    assert ids.tolist() == [[3, 5]] and scores.tolist() == [[1.0, 1.0]]


def test_vector_functions(spark):
    data = [([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])]
    df = literal(spark, data, "a array<float>, b array<float>, z array<float>")
    a, b, z = F.col("a"), F.col("b"), F.col("z")
    got = df.select(VF.norm(a), VF.cosine(a, b), VF.cosine(a, z)).first()
    assert tuple(got) == (5.0, pytest.approx(0.96), None)


def test_shared_folder_needs_a_setting_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


# Pages, and the text a browser shows of them.
PAGES = [
    ("a<!-- <b>x</b> > -->b", "a b"),
    ("seen<!-- never closed <p>hidden</p>", "seen"),
    ("<a title=\"1 > 0\" href='x>y'>link</a>", "link"),
    ("<p title=it's>one</p> isn't > two", "one isn't > two"),
    ("<script>if (a < b) { s = '<!--' + \"</p>\"; }</script>after", "after"),
    ("<SCRIPT src='a>b'>x</Script >tail", "tail"),
    ("text<script>never closed <p>no</p>", "text"),
    ("<style>p > a {}</style><!-- </style> -->z", "z"),
    ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<!DOCTYPE html><?xml version='1.0'?><br/>x<br>y", "x y"),
    ("<scripted>kept</scripted><titles>too</titles>", "kept too"),
    ("<a href=\"open>text</a> end", "text end"),
    ("<p>a &lt;b&gt; c</p>", "a <b> c"),
    ("", ""),
    (None, None),
]


def test_visible_text_of_broken_markup(spark):
    df = literal(spark, [(i, page) for i, (page, _) in enumerate(PAGES)], "i int, html string")
    got = {r.i: r.text for r in df.select("i", S.visible_text(F.col("html")).alias("text")).collect()}
    assert [got[i] for i in range(len(PAGES))] == [text for _, text in PAGES]


def test_visible_text_is_what_the_standard_parser_reads(spark):
    """Well-formed markup from random pieces, among them a page of a million characters."""
    rng = random.Random(5)
    pieces = ["word ", "<p class='a>b'>", "</p>", "<!-- a <b> -->", "<script>x<y;'<p>'</script>", "&amp;", "<br/>",
              "<style>a>b</style>", "<i data-x=\"'>\">", "\n", "é", "<A HREF=x=y>", "</a>"]
    made = ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(300)]
    made.append("".join(rng.choices(pieces, k=100_000)))
    made.append("<a " + "x='1>' " * 20_000 + ">many</a>")

    class Shown(HTMLParser):
        def __init__(self):
            super().__init__()
            self.hidden, self.parts = 0, []

        def handle_starttag(self, tag, attrs):
            self.parts.append(" ")
            self.hidden += tag in ("script", "style")

        def handle_startendtag(self, tag, attrs):
            self.parts.append(" ")

        def handle_endtag(self, tag):
            self.parts.append(" ")
            self.hidden -= tag in ("script", "style")

        def handle_comment(self, data):
            self.parts.append(" ")

        def handle_data(self, data):
            self.parts.append(data if not self.hidden else " ")

    def shown(page):
        parser = Shown()
        parser.feed(page)
        parser.close()
        return " ".join("".join(parser.parts).split())

    df = literal(spark, list(enumerate(made)), "i int, html string")
    got = {r.i: r.text for r in df.select("i", S.visible_text(F.col("html")).alias("text")).collect()}
    assert [got[i] for i in range(len(made))] == [shown(page) for page in made]

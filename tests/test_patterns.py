import datetime as dt
import itertools
import random

from conftest import rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import graph, patterns
from strata.operators.skew import running_totals

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def test_grouping_rollup(spark):
    df = spark.createDataFrame([("x", "p", 1), ("x", "q", 2), (None, "p", 4)], "a string, b string, n int")
    got = rows(patterns.grouping_rollup(df, [["a", "b"], ["b"], []], {"hits": F.lit(1), "total": "n"}))
    assert got == sorted([
        ("a__b", "x", "p", 1, 1), ("a__b", "x", "q", 1, 2), ("a__b", None, "p", 1, 4),  # a real null is not "(overall)"
        ("b", "(overall)", "p", 2, 5), ("b", "(overall)", "q", 1, 2), ("(overall)", "(overall)", "(overall)", 3, 7)], key=repr)


def test_leaders_show_ties(spark):
    df = spark.createDataFrame([("x", 1, 5), ("x", 2, 5), ("x", 3, 4), ("y", 4, 1)], "l string, id int, v int")
    assert rows(patterns.leaders(df, "v", "l")) == [("x", 1, 5), ("x", 2, 5), ("y", 4, 1)]
    assert rows(patterns.leaders(df, "v")) == [("x", 1, 5), ("x", 2, 5)]


def trends(spark, counts, **kw):
    df = spark.createDataFrame([("k", day(d), n) for d, n in counts], "k string, d date, n int")
    return {r["d"]: r for r in patterns.rolling_trends(df, "k", "d", "n", **kw).collect()}


def test_rolling_trends_frames(spark):
    counts = [(d, 1) for d in range(20)]
    default, overlap = trends(spark, counts), trends(spark, counts, previous=(13, 6))
    assert default[day(19)]["weekly_rolling"] == 7 and default[day(19)]["previous_weekly_rolling"] == 7
    assert overlap[day(19)]["previous_weekly_rolling"] == 8  # eight rows, one of them in both frames
    assert default[day(6)]["previous_weekly_rolling"] is None
    assert default[day(4)]["running_total"] == 5 and default[day(4)]["grand_total"] == 20
    gappy = [(0, 1), (30, 2), (31, 4)]
    assert trends(spark, gappy)[day(31)]["weekly_rolling"] == 7  # rows
    by_day = trends(spark, gappy, calendar=True)[day(31)]
    assert by_day["weekly_rolling"] == 6 and by_day["monthly_total"] == 4 and by_day["pct_of_month"] == 1.0
    assert trends(spark, counts, min_total=20) == {}


def funnel_by_loop(data):
    """Per step [events that something follows on their day, those that a purchase follows], user by user and day by day."""
    days = {}
    for user, t, step in set(data):
        if user is not None:
            days.setdefault((user, moment(t).date()), []).append((t, step))
    counts = {}
    for visits in days.values():
        end = max(t for t, _ in visits)
        purchase = max((t for t, step in visits if step == "buy"), default=-1)
        for t, step in visits:
            if t < end:
                seen = counts.setdefault(step, [0, 0])
                seen[0] += 1
                seen[1] += t < purchase
    return sorted((step, n, bought) for step, (n, bought) in counts.items() if bought)


def moment(t):
    return dt.datetime(2024, 1, 1, 20) + dt.timedelta(minutes=15 * t)


@settings(max_examples=3, derandomize=True, phases=[Phase.explicit, Phase.generate], deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.integers(0, 40), st.sampled_from(["view", "cart", "buy"])), min_size=1, max_size=40))
def test_funnel_equals_a_loop(spark, data):
    ev = spark.createDataFrame([(u, moment(t), s) for u, t, s in data], "u int, t timestamp_ntz, s string")
    for most in (1_000_000, 3):
        out = patterns.funnel_conversion(ev, "u", "t", "s", "buy", most=most)
        assert rows(out.select("s", "events", "converted")) == funnel_by_loop(data)


def test_funnel_last_event_of_the_day(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, h), s) for h, s in [(9, "view"), (10, "buy"), (11, "view")]], "u int, t timestamp_ntz, s string")
    assert rows(patterns.funnel_conversion(ev, "u", "t", "s", "buy")) == [("view", 1, 1, 1.0)]
    assert rows(patterns.funnel_conversion(ev, "u", "t", "s", "buy", include_last=True)) == [("view", 2, 1, 0.5)]
    assert rows(patterns.funnel_conversion(ev, "u", "t", "s", "buy", min_n=1)) == []


def season(spark, seed, teams=3, n=120):
    rnd = random.Random(seed)
    ids = rnd.sample(range(10_000), n)
    return spark.createDataFrame(
        [(rnd.randrange(teams), day(rnd.randrange(25)), g, rnd.randrange(2), rnd.choice([None, 5, 11, 20])) for g in ids],
        "team int, d date, g bigint, win int, pts int").persist()


def test_running_totals_any_block_width(spark):
    df = season(spark, 1)
    w = Window.partitionBy("team").orderBy("d", "g").rowsBetween(Window.unboundedPreceding, 0)
    want = rows(df.withColumn("total", F.sum("win").over(w)))
    for width in (1, 700, 1_000_000):
        assert rows(running_totals(df, "team", "d", "g", {"total": "win"}, width)) == want


def test_best_stretch_any_block_width(spark):
    df = season(spark, 2)
    w = Window.partitionBy("team").orderBy("d", "g").rowsBetween(-6, 0)
    want = rows(df.select("team", F.sum("win").over(w).alias("w"), F.count("g").over(w).alias("c")).groupBy("team").agg(F.max("w"), F.max("c")))
    for width in (7, 13, 1_000_000):
        assert rows(patterns.best_stretch(df, "team", "d", "g", "win", 7, width)) == want
    assert {r["games_in_window"] for r in patterns.best_stretch(df, "team", "d", "g", "win", 500).collect()} == {
        r[1] for r in df.groupBy("team").count().collect()}


def test_longest_streak(spark):
    df = season(spark, 3)
    want = []
    for team, group in itertools.groupby(sorted(df.collect(), key=lambda r: (r["team"], r["d"], r["g"])), key=lambda r: r["team"]):
        best, run = (0, None, None), []
        for r in group:
            run = [*run, r["d"]] if (r["pts"] or 0) > 10 else []
            if len(run) > best[0]:
                best = (len(run), run[0], run[-1])
        want.append((team, *best))
    for width in (50, 1_000_000):
        assert rows(patterns.longest_streak(df, "team", "d", "g", F.col("pts") > 10, width)) == sorted(want, key=repr)
    none = patterns.longest_streak(df, "team", "d", "g", F.col("pts") > 100)
    assert {tuple(r)[1:] for r in none.collect()} == {(0, None, None)}


def test_vertices_and_edges(spark):
    teams = spark.createDataFrame(
        [(7, "reds", 3, 2), (7, "blues", 4, 1), (8, None, 5, 1)], "club bigint, colour string, members int, seq int")
    found = {v["identifier"]: (v["type"], v["properties"]) for v in graph.vertices(
        teams, "club", "team", {"colour": "colour", "size": "members"}, ["seq"]).collect()}
    assert found == {7: ("team", {"colour": "blues", "size": "4"}), 8: ("team", {"colour": None, "size": "5"})}
    lines = spark.createDataFrame([(1, 10, 5, 1), (1, 10, 7, 2), (2, 10, None, 1)], "p int, g int, pts int, seq int")
    got = {r["subject_identifier"]: r["properties"] for r in graph.membership_edges(
        lines, "p", "player", "g", "game", "plays_in", {"pts": "pts"}, ["seq"]).collect()}
    assert got == {1: {"pts": "5"}, 2: {"pts": None}}


def test_cooccurrence_split_is_exact(spark):
    """Every pair once, whether or not a large event is split over many cells."""
    rnd = random.Random(4)
    data = [(e, n, f"n{n}", f"t{n % 3}", n + e, k) for e, size in [(1, 60), (2, 5), (3, 1)] for k, n in enumerate(rnd.sample(range(80), size))]
    data += data[:10]  # copies
    df = spark.createDataFrame(data, "e int, n int, name string, team string, pts int, seq int")
    want = {}
    for (e, a, _, ta, pa, _), (f, b, _, tb, pb, _) in itertools.product(set(data), set(data)):
        if e == f and a > b:
            k = (a, f"n{a}", b, f"n{b}", "shares_team" if ta == tb else "plays_against")
            n, x, y = want.get(k, (0, 0, 0))
            want[k] = (n + 1, x + pa, y + pb)
    labels = df.select("n", "name").distinct()
    for most, order in ((2_000, ["seq"]), (7, ["seq"]), (7, [F.col("seq")])):
        for known in (None, labels):
            got = graph.cooccurrence_edges(df, "e", "n", "name", "team", "pts", order, most=most, labels=known)
            assert rows(got) == sorted((k + v for k, v in want.items()), key=repr)


def test_cooccurrence_takes_first_rows_and_different_names(spark):
    """A node counts with its first row of an event, nulls are no nodes or events, and namesakes make no pair."""
    data = [(1, 1, "a", "t", 5, 2), (1, 1, "a", "u", 7, 1), (1, 2, "b", "u", 1, 1), (1, 3, "b", "t", 2, 1), (1, None, "c", "t", 9, 1), (None, 1, "a", "t", 9, 1), (None, 2, "b", "t", 9, 1)]
    df = spark.createDataFrame(data, "e int, n int, name string, team string, pts int, seq int")
    want = [(2, "b", 1, "a", "shares_team", 1, 1, 7), (3, "b", 1, "a", "plays_against", 1, 2, 7)]
    for known in (None, df.where("n is not null").select("n", "name").distinct()):
        for most in (100, 1):
            assert rows(graph.cooccurrence_edges(df, "e", "n", "name", "team", "pts", ["seq"], most=most, labels=known)) == want


def test_trends_above_a_limit_from_a_table(spark):
    counts = [(d, 1) for d in range(20)]
    for limit, n in ((19, 20), (20, 0)):
        table = spark.createDataFrame([(limit,)], "v int")
        assert len(trends(spark, counts, min_total=table)) == len(trends(spark, counts, min_total=limit)) == n


def test_totals_by_blocks_take_any_keys(spark):
    """Blocked and plain totals agree with null teams and days, text ids and ids far apart."""
    data = [(None if k % 7 == 0 else "t", None if k % 5 == 0 else 20 + k % 3, None if k == 13 else f"g{k * 7919 % 1009}", k % 2) for k in range(80)]
    df = spark.createDataFrame(data, "team string, d int, g string, win int")
    for n in (3, 90):
        assert rows(patterns.best_stretch(df, "team", "d", "g", "win", n=n, width=8)) == rows(patterns.best_stretch(df, "team", "d", "g", "win", n=n))
    streaks = [rows(patterns.longest_streak(df, "team", "d", "g", F.col("win") == 1, width)) for width in (10, 1_000_000)]
    assert streaks[0] == streaks[1]


def test_trends_keep_null_keys_unless_required(spark):
    df = spark.createDataFrame([("r", None, 1, 5), ("r", "/a", 1, 7), (None, "/a", 1, 9)], "referrer string, url string, n int, hits int")
    df = df.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")))
    got = patterns.share_of_total(df, ["referrer", "url"], "hits", "day", required="referrer")
    assert rows(got.select("referrer", "url", "hits")) == [("r", "/a", 7), ("r", None, 5)]
    assert patterns.share_of_total(df, ["referrer", "url"], "hits", "day").count() == 3


def test_all_ties_lead(spark):
    df = spark.range(1000).select("id", F.lit(1.5).alias("v"), (F.col("id") % 2).alias("l"))
    assert patterns.leaders(df, "v").count() == patterns.leaders(df, "v", "l").count() == 1000

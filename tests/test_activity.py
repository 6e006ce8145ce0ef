import datetime as dt

import pytest
from conftest import rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.columns import bits_text, classify_by_rules, hash_bucket, ip_number, number_ip, referrer_rules
from strata.operators import activity as act
from strata.operators import state
from strata.operators.skew import list_pages

START = dt.date(2024, 1, 28)  # the days run over the end of a month


def day(n):
    return START + dt.timedelta(days=n)


def daily(spark, data):
    return spark.createDataFrame([(u, day(d), h) for (u, d), h in data.items()], "user_id int, day date, hits bigint")


activity = st.dictionaries(st.tuples(st.integers(1, 4), st.integers(0, 11)), st.integers(1, 9), min_size=1, max_size=24)


def keep(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


@settings(max_examples=2, derandomize=True, phases=[Phase.explicit, Phase.generate], deadline=None, suppress_health_check=list(HealthCheck))
@given(activity)
def test_daily_runs_equal_backfills(spark, data):
    facts = daily(spark, data).persist()
    dates = arrays = zeros = accounting = None
    full = state.growth_accounting_backfill(facts, "user_id", str(day(11))).persist()
    for n in range(12):
        ds = str(day(n))
        dates = keep(spark, act.cumulate_dates(dates, facts, "user_id", ds))
        arrays = keep(spark, act.monthly_hit_array(arrays, facts, "user_id", ds))
        accounting = keep(spark, state.growth_accounting(accounting, facts, "user_id", ds))
        assert rows(accounting) == rows(full.where(F.col("date") == ds))
        if n in (2, 3, 4, 11):
            assert rows(dates) == rows(act.date_lists(facts, "user_id", ds))
            assert rows(arrays) == rows(act.monthly_hit_backfill(facts, "user_id", ds))
    # bitmap: straight from facts, from arrays, and counted by hand
    end = day(11)
    bits = act.datelist_int(dates, "dates_active", str(end)).select("user_id", "datelist_int")
    assert rows(bits) == rows(act.datelist_int_from_daily(facts, "user_id", str(end)))
    flags = {r["user_id"]: (r["l32"], r["l7"], r["weekly_active_previous_week"]) for r in act.activity_flags(bits).collect()}
    for user in {u for u, _ in data}:
        ago = {11 - d for u, d in data if u == user}
        assert flags[user] == (len(ago), len([a for a in ago if a < 7]), any(7 <= a < 14 for a in ago))
    facts.unpersist(), full.unpersist()


def test_bitmap_edges(spark):
    end = dt.date(2024, 3, 31)
    dates = [end, end - dt.timedelta(6), end - dt.timedelta(31), end - dt.timedelta(32), end + dt.timedelta(1)]
    df = act.datelist_int(spark.createDataFrame([(dates,), ([],)], "d array<date>"), "d", str(end))
    assert [r[0] for r in df.select(bits_text("datelist_int")).collect()] == ["10000010000000000000000000000001", "0" * 32]
    only = act.datelist_int(spark.createDataFrame([([end],)], "d array<date>"), "d", str(end))
    r = act.activity_flags(only).first()
    assert (r["l32"], r["l7"], r["monthly_active"], r["weekly_active"], r["weekly_active_previous_week"]) == (1, 1, True, True, False)


def test_weekly_states(spark):
    """Last active 6, 7, 8 and 9 days before the run day, active or not."""
    ds = dt.date(2024, 3, 20)
    prev = spark.createDataFrame(
        [(ago * 10 + a, ds - dt.timedelta(30), ds - dt.timedelta(ago), [ds - dt.timedelta(ago)], ds - dt.timedelta(1))
         for ago in (1, 6, 7, 8, 9) for a in (0, 1)],
        "user_id int, first_active_date date, last_active_date date, dates_active array<date>, date date")
    today = spark.createDataFrame([(ago * 10 + 1, ds, 1) for ago in (1, 6, 7, 8, 9)] + [(1, ds, 1)], "user_id int, day date, hits bigint")
    got = {r["user_id"]: (r["daily_active_state"], r["weekly_active_state"])
           for r in state.growth_accounting(prev, today, "user_id", str(ds)).collect()}
    assert got == {
        1: ("New", "New"), 10: ("Churned", "Retained"), 11: ("Retained", "Retained"), 60: ("Stale", "Retained"), 61: ("Resurrected", "Retained"),
        70: ("Stale", "Retained"), 71: ("Resurrected", "Retained"), 80: ("Stale", "Churned"), 81: ("Resurrected", "Resurrected"),
        90: ("Stale", "Stale"), 91: ("Resurrected", "Resurrected")}


def test_rerun_of_a_day_fails(spark):
    facts = daily(spark, {(1, 0): 1})
    one = keep(spark, act.cumulate_dates(None, facts, "user_id", str(day(0))))
    with pytest.raises(Exception, match="day before"):
        act.cumulate_dates(one, facts, "user_id", str(day(0))).collect()
    ga = keep(spark, state.growth_accounting(None, facts, "user_id", str(day(0))))
    with pytest.raises(Exception, match="day before"):
        state.growth_accounting(ga, facts, "user_id", str(day(0))).collect()


def test_retention(spark):
    facts = daily(spark, {(1, 0): 1, (1, 1): 1, (2, 0): 1})
    got = rows(state.retention_curve(state.growth_accounting_backfill(facts, "user_id", str(day(1)))))
    assert got == [(0, 1.0, 2), (1, 0.5, 2)]


def test_month_rollover_starts_empty(spark):
    facts = daily(spark, {(1, 3): 4, (1, 5): 2, (2, 3): 1})  # Jan 31, Feb 2
    a = keep(spark, act.monthly_hit_array(None, facts, "user_id", "2024-01-31"))
    assert next(r["hit_array"] for r in a.collect() if r["user_id"] == 1) == [None] * 30 + [4]
    b = keep(spark, act.monthly_hit_array(a, facts, "user_id", "2024-02-01"))
    assert b.count() == 0
    c = act.monthly_hit_array(a.withColumn("date", F.lit(dt.date(2024, 2, 1))), facts, "user_id", "2024-02-02").collect()
    assert [(r["user_id"], r["hit_array"], r["month_start"], r["first_seen"]) for r in c] == [
        (1, [None, 2], dt.date(2024, 2, 1), dt.date(2024, 2, 2))]


def test_metric_array_upsert(spark):
    facts = daily(spark, {(1, 4): 4, (2, 5): 2})  # Feb 1, Feb 2
    other = spark.createDataFrame([(1, dt.date(2024, 1, 1), "site_hits", [7]), (9, dt.date(2024, 2, 1), "x", [1, 1])],
                                  "user_id int, month_start date, metric_name string, metric_array array<bigint>")
    one = keep(spark, act.metric_array_upsert(other, facts, "user_id", "site_hits", "2024-02-01"))
    two = keep(spark, act.metric_array_upsert(one, facts, "user_id", "site_hits", "2024-02-02"))
    feb = dt.date(2024, 2, 1)
    assert rows(two) == sorted([(1, dt.date(2024, 1, 1), "site_hits", [7]), (9, feb, "x", [1, 1]), (1, feb, "site_hits", [4, 0]), (2, feb, "site_hits", [0, 2])], key=repr)
    with pytest.raises(Exception, match="do not end on the day before"):
        act.metric_array_upsert(two, facts, "user_id", "site_hits", "2024-02-02").collect()
    assert rows(act.array_to_daily(two.where("metric_name = 'x'"), "metric_array", "month_start", ["user_id"])) == [
        (9, dt.date(2024, 2, 1), 1), (9, dt.date(2024, 2, 2), 1)]
    assert rows(act.array_length_profile(two, "metric_array")) == [(1, 1), (2, 3)]


def test_sum_array_positions(spark):
    df = spark.createDataFrame(
        [("2023-03-01", [0, 1, 3], "2023-03-01"), ("2023-03-01", [1, 2, 3], "2023-03-01"), ("2023-04-01", [], "2023-03-01"), ("2023-04-01", [], "")],
        "month_start string, hit_array array<bigint>, date_partition string").where("date_partition = '2023-03-01'")
    assert rows(act.sum_array_positions(df, "hit_array", "month_start", 3)) == [("2023-03-01", 1, 3, 6), ("2023-04-01", 0, 0, 0)]
    assert rows(act.sum_array_positions(df, "hit_array", "month_start")) == [("2023-03-01", 1, 1), ("2023-03-01", 2, 3), ("2023-03-01", 3, 6)]


def test_host_activity_iterated(spark):
    ev = spark.createDataFrame(
        [("h", 1, "2024-01-01 10:00:00"), ("h", 1, "2024-01-01 11:00:00"), ("h", 2, "2024-01-03 00:00:00"), ("g", None, "2024-01-02 23:59:59")],
        "host string, user_id int, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    prev = None
    for ds in ("2024-01-01", "2024-01-02", "2024-01-03"):
        prev = keep(spark, act.host_activity_reduced(prev, ev, "host", "user_id", "ts", ds))
        assert rows(prev) == rows(act.host_activity_backfill(ev, "host", "user_id", "ts", ds))
    got = {r["host"]: (r["hit_array"], r["unique_visitors"]) for r in prev.collect()}
    assert got == {"h": ([2, 0, 1], [1, 0, 1]), "g": ([0, 1, 0], [0, 0, 0])}


def test_coactivity_parts_hold_everything(spark):
    pairs = spark.range(5000).select((F.col("id") % 3).alias("u"), F.col("id").alias("d"), F.col("id").alias("event_counts"))
    pairs = pairs.unionByName(spark.range(5).select(F.lit(7).cast("bigint").alias("u"), F.col("id").alias("d"), F.col("id").alias("event_counts")))
    pairs = pairs.unionByName(spark.range(9).select(F.lit(None).cast("bigint").alias("u"), F.col("id").alias("d"), F.col("id").alias("event_counts")))
    for parts in (1, 16):
        out = act.user_devices(pairs, "u", "d", parts).collect()
        for u, want in [*((u, list(range(u, 5000, 3))) for u in (0, 1, 2)), (7, list(range(5))), (None, list(range(9)))]:
            mine = [r for r in out if r["u"] == u]
            assert sorted(x for r in mine for x in r["devices"]) == want
            assert {r["total_hits"] for r in mine} == {max(want)}
            assert len({r["part"] for r in mine}) == len(mine) <= parts
            assert all(r["devices"] == sorted(r["devices"]) and len(r["devices"]) < 1.5 * len(want) / parts + 5 for r in mine)


def test_bitmaps_of_an_earlier_day(spark):
    """A user first seen after the as-of day has no row in either form."""
    facts = daily(spark, {(1, 0): 1, (2, 9): 1, (1, 10): 2})
    end = str(day(4))
    lists = act.datelist_int(act.date_lists(facts, "user_id", end), "dates_active", end).select("user_id", "datelist_int")
    assert rows(lists) == rows(act.datelist_int_from_daily(facts, "user_id", end)) == [(1, 1 << 27)]


def test_states_with_and_without_dates(spark):
    facts = daily(spark, {(1, 0): 1, (1, 3): 1, (2, 1): 1, (1, 11): 4})
    whole = state.growth_accounting_backfill(facts, "user_id", str(day(11)))
    assert rows(state.accounting_states(facts, "user_id", str(day(11)))) == rows(whole.drop("dates_active"))
    two = {(r["user_id"], r["date"]): r["dates_active"] for r in state.growth_accounting_backfill(facts, "user_id", str(day(11)), keep_last=2).collect()}
    assert two[1, day(11)] == [day(3), day(11)] and two[1, day(2)] == [day(0)]


def test_referrer_rules(spark):
    values = ["https://www.linkedin.com/x", "https://t.co/a", "https://www.reddit.com/r", "https://lnkd.in/q", "https://my.site/p", None]
    df = spark.createDataFrame([(v,) for v in values], "r string")
    by_text = [r[0] for r in df.select(classify_by_rules("r", referrer_rules(["my.site"]))).collect()]
    assert by_text == ["Linkedin", "Twitter", "Twitter", "Linkedin", "On Site", None]
    from strata.functions.columns import OWN_SITE, REFERRER_HOSTS

    by_host = [r[0] for r in df.select(classify_by_rules("r", REFERRER_HOSTS + [("my.site", OWN_SITE)], by_host=True)).collect()]
    assert by_host == ["Linkedin", "Twitter", "https://www.reddit.com/r", "Linkedin", "On Site", None]


def test_ip_and_bucket(spark):
    df = spark.createDataFrame([("1.2.3.4",), ("255.255.255.255",), ("1.2.3",), ("1.2.3.256",), ("a.b.c.d",), (None,)], "ip string")
    assert [r[0] for r in df.select(ip_number("ip")).collect()] == [16909060, 4294967295, None, None, None, None]
    assert spark.range(1).select(number_ip(F.lit(16909060).cast("bigint"))).first()[0] == "1.2.3.4"
    import hashlib

    want = int(hashlib.md5(b"salt:42").hexdigest()[:8], 16) % 10000
    assert spark.range(1).select(hash_bucket(F.lit(42), "salt:")).first()[0] == want


def test_list_pages(spark):
    """Pages hold the sorted list whatever the key's size; nulls are a key and a value; maxima are of the whole key."""
    data = [("hot", n, n % 7) for n in range(500)] + [("one", 1, 9), (None, 5, 1), (None, None, 2), ("none", None, 3)]
    df = spark.createDataFrame(data, "k string, v int, m int").repartition(5)
    got = {(r["k"], r["page"]): (r["values"], r["m"]) for r in list_pages(df, "k", "v", 64, ["m"]).collect()}
    assert [got["hot", p][0] for p in range(8)] == [list(range(p * 64, min(p * 64 + 64, 500))) for p in range(8)]
    assert {got["hot", p][1] for p in range(8)} == {6}
    assert got["one", 0] == ([1], 9) and got[None, 0] == ([None, 5], 2) and got["none", 0] == ([None], 3) and len(got) == 11
    assert list_pages(df.limit(0), "k", "v", 3).count() == 0


def test_coactivity_pages_hold_what_the_lists_hold(spark):
    pairs = spark.createDataFrame([(u, d, u + d) for u in range(4) for d in range(u * 5 + 1)], "u int, d int, event_counts int")
    pages = act.user_device_pages(pairs, "u", "d", 4)
    lists = act.user_devices(pairs, "u", "d")
    assert rows(pages.orderBy("page").groupBy("u", "total_hits").agg(F.sort_array(F.flatten(F.collect_list("devices"))))) == rows(lists.select("u", "total_hits", "devices"))
    labels = spark.createDataFrame([(0, "x"), (3, "y"), (99, "z")], "d int, label string")
    got = rows(act.device_user_pages(pairs, labels, "u", "d", "label", 2))
    assert got == [(0, 0, [0, 1], "x"), (0, 1, [2, 3], "x"), (3, 0, [1, 2], "y"), (3, 1, [3], "y")]

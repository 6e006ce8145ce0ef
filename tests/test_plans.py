"""The physical plans the operators rely on at scale."""

import re

import pytest
from conftest import plan
from pyspark.sql import functions as F

import __spark_entry__ as driver
from strata.operators import activity as act
from strata.operators import clean, patterns, scd
from strata.plans import inputs as i
from strata.session import session_conf

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_dedupe_limits_before_the_shuffle(spark, sf):
    p = plan(clean.dedupe_by_key(i.table(spark, sf, "lineitem"), "l_orderkey", ["l_linenumber", "l_partkey"]))
    assert p.index("row_number(), 1, Final") < p.index("Exchange hashpartitioning") < p.index("row_number(), 1, Partial")


def test_leaders_bring_one_maximum_per_task_together(spark, sf):
    totals = i.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"))
    p = plan(patterns.leaders(totals, "q"))
    assert "Window" not in p and "Sort " not in p and "BroadcastHashJoin" in p
    # the only exchange to one task carries partial maxima
    assert all("partial_max" in part.split("\n")[1] for part in p.split("Exchange SinglePartition")[1:])


def test_retention_carries_no_arrays(spark, sf):
    p = plan(driver.queries()["retention_curve"](spark, sf))
    assert "collect_set" not in p and "array<date>" not in p


def test_scd2_backfill_shuffles_once(spark, sf):
    snap = i.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    assert shuffles(scd.scd2_backfill(snap, "o_custkey", "o_orderkey", "o_orderstatus")) == 1


def test_backfill_and_accounting_shuffle_facts_once(spark, sf):
    from strata.operators import entity, state

    facts = i.table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_totalprice")
    assert shuffles(entity.backfill_entity(facts, "o_custkey", "y", 2001, ["o_totalprice"], F.lit("x"))) == 1
    days = i.table(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"))
    assert shuffles(state.growth_accounting_backfill(days, "user_id", i.DS)) == 1


def test_rolling_trends_shuffle_once(spark, sf):
    daily = i.table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), "value")
    assert shuffles(patterns.rolling_trends(daily, "event_type", "day", "value", min_total=1)) == 1


def test_day_filter_reaches_the_scan(spark, sf):
    with session_conf(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        p = plan(act.daily_activity(i.table(spark, sf, "events"), "user_id", "ts", "2024-01-05"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", p).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed and "IsNotNull(user_id)" in pushed
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>", p)


def test_bitmaps_need_no_cross_join_and_no_extra_shuffle(spark, sf):
    lists = i.table(spark, sf, "events").groupBy("user_id").agg(F.collect_set(F.to_date("ts")).alias("d"))
    assert shuffles(act.datelist_int(lists, "d", i.DS)) == 1
    p = plan(act.datelist_int_from_daily(act.daily_activity(i.table(spark, sf, "events"), "user_id", "ts"), "user_id", i.DS))
    assert "ObjectHashAggregate" not in p and "bit_or" in p


def test_lists_shuffle_pairs_once(spark, sf):
    pairs = act.pair_activity(i.web_events(spark, sf), "user_id", "device_id", "host")
    assert shuffles(act.user_devices(pairs, "user_id", "device_id")) == 2  # events to pairs, pairs to users
    assert shuffles(act.user_devices(pairs, "user_id", "device_id", 4)) == 3  # and the parts to their user's maximum


# A foldable key or a one-row side may plan as a nested loop; none of these queries has one.
@pytest.mark.parametrize("name", [
    "funnel_conversion", "geo_enrich", "cooccurrence_edges", "best_stretch", "longest_streak", "experiment_readout",
    "datelist_int", "backfill_entity", "game_leaders", "rolling_trends", "growth_accounting_backfill"])
def test_no_nested_loops(spark, sf, name):
    p = plan(driver.queries()[name](spark, sf))
    assert "NestedLoop" not in p and "Cartesian" not in p


@pytest.mark.parametrize("name", ["daily_activity", "funnel_conversion", "kpi_rollup", "grouping_sets_dashboard", "scd2_backfill", "retention_curve"])
def test_no_python_and_no_whole_scans(spark, sf, name):
    df = driver.queries()[name](spark, sf)
    p = plan(df)
    assert "Python" not in p and "Pandas" not in p
    for schema in re.findall(r"ReadSchema: struct<(.*?)>", p):
        assert schema.count(":") <= 5


def test_explicit_broadcast_of_small_dimensions(spark, sf):
    """With automatic broadcast off only the measured dimensions are broadcast."""
    from strata.operators import joins

    with session_conf(spark, NO_BROADCAST):
        fact = i.medals_players(spark, sf).join(i.matches(spark, sf), "match_id")
        p = plan(joins.broadcast_enrich(fact, [(i.medals(spark, sf), "medal_id"), (i.maps(spark, sf), "map_id")]))
    assert p.count("BroadcastHashJoin") == 2 and p.count("SortMergeJoin") == 2  # match and customer joins stay shuffled


def test_wide_join_side_is_never_hinted(spark, sf):
    with session_conf(spark, NO_BROADCAST):
        p = plan(driver.queries()["cooccurrence_edges"](spark, sf))
    assert "SortMergeJoin" in p

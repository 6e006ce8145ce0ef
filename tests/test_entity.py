import random
import uuid

import pytest
from conftest import rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.columns import band
from strata.operators import entity, scd, state

BANDS = [(20, "star"), (15, "good"), (10, "average")]
FACTS = "name string, season int, pts double, country string"


def facts(spark, data):
    return spark.createDataFrame(data, FACTS)


def klass():
    return band("pts", BANDS, "bad")


def test_band_is_strict_and_null_is_lowest(spark):
    df = spark.createDataFrame([(21.0,), (20.0,), (15.5,), (10.0,), (None,)], "pts double")
    assert [r[0] for r in df.select(klass()).collect()] == ["star", "good", "good", "bad", "bad"]


def step(spark, prev, data, season, **kw):
    return entity.cumulate_entity(prev, facts(spark, data), "name", "season", season, ["season", "pts"], klass(), ["country"], **kw)


def test_cumulate_entity(spark):
    data = [("a", 1, 25.0, None), ("b", 1, 5.0, "US"), ("a", 2, 12.0, "FR"), ("c", 2, 16.0, "IT"), ("b", 3, 30.0, "XX")]
    one = step(spark, None, data, 1)
    two = step(spark, one, data, 2)
    three = step(spark, two, data, 3)
    got = {r["name"]: r for r in three.collect()}
    assert [tuple(x) for x in got["a"]["history"]] == [(1, 25.0), (2, 12.0)]
    assert (got["a"]["entity_class"], got["a"]["is_active"], got["a"]["periods_since_active"]) == ("average", False, 1)
    assert got["a"]["country"] == "FR" and got["b"]["country"] == "US"  # first known value stays
    assert (got["b"]["entity_class"], got["b"]["is_active"], got["b"]["periods_since_active"]) == ("star", True, 0)
    assert all(r["season"] == 3 for r in got.values())
    assert [tuple(x) for x in next(r for r in step(spark, two, data, 3, keep_last=1).collect() if r["name"] == "b")["history"]] == [(3, 30.0)]


def test_wrong_previous_period_fails(spark):
    one = step(spark, None, [("a", 1, 25.0, None)], 1)
    with pytest.raises(Exception, match="previous snapshot"):
        step(spark, one, [("a", 3, 1.0, None)], 3).collect()


def test_backfill_refuses_two_facts_of_one_period(spark):
    df = facts(spark, [("a", 1, 1.0, None), ("a", 1, 2.0, None)])
    with pytest.raises(Exception, match="more than one fact"):
        entity.backfill_entity(df, "name", "season", 2, ["pts"], klass()).collect()


PERIODS = 5
career = st.dictionaries(
    st.tuples(st.sampled_from("abcd"), st.integers(1, PERIODS)),
    st.tuples(st.sampled_from([5.0, 12.0, 17.0, 25.0]), st.sampled_from([None, "US", "FR"])), min_size=1, max_size=14)
ATTRS = ["entity_class", "is_active"]


@settings(max_examples=3, derandomize=True, phases=[Phase.explicit, Phase.generate], deadline=None, suppress_health_check=list(HealthCheck))
@given(career)
def test_iterated_equals_backfill(spark, data):
    """Snapshots, SCD rows and states built period by period equal the one-pass forms."""
    table = facts(spark, [(n, p, pts, c) for (n, p), (pts, c) in data.items()]).persist()
    full = entity.backfill_entity(table, "name", "season", PERIODS, ["season", "pts"], klass(), ["country"]).persist()
    prev, history = None, None
    for p in range(1, PERIODS + 1):
        prev = entity.cumulate_entity(prev, table, "name", "season", p, ["season", "pts"], klass(), ["country"])
        prev = spark.createDataFrame(prev.collect(), prev.schema)
        assert rows(prev) == rows(full.where(F.col("season") == p))
        if history is None:
            history = scd.scd2_backfill(full, "name", "season", ATTRS, as_of=p)
        else:
            history = scd.scd2_incremental(history, full, "name", ATTRS, "season", p)
        history = spark.createDataFrame(history.collect(), history.schema)
        assert rows(history) == rows(scd.scd2_backfill(full, "name", "season", ATTRS, as_of=p).select(*history.columns))
    late = entity.backfill_entity(table, "name", "season", PERIODS, ["season", "pts"], klass(), ["country"], emit_from=PERIODS)
    assert rows(late) == rows(full.where(F.col("season") == PERIODS))
    table.unpersist(), full.unpersist()


def test_backfill_static_max(spark):
    df = facts(spark, [("a", 1, 1.0, "B"), ("a", 2, 1.0, "C"), ("a", 3, 1.0, "A")])
    out = entity.backfill_entity(df, "name", "season", 3, ["pts"], klass(), ["country"], static_mode="max")
    assert {r["country"] for r in out.collect()} == {"C"}


def merged(snapshot):
    """A grouped snapshot with the parts of a key put together: key, state, sorted film ids."""
    found = {}
    for r in snapshot.collect():
        state = (r["entity_class"], r["is_active"], r["periods_since_active"], r["year"])
        before, ids = found.setdefault(r["actor"], (state, []))
        assert before == state
        ids += [x["film"] for x in r["history"]]
    return {k: (state, sorted(ids)) for k, (state, ids) in found.items()}


@pytest.mark.parametrize("parts", [1, 3])
def test_grouped_entity_iterated_equals_backfill(spark, parts):
    films = spark.createDataFrame(
        [("x", 1, 11, 9.0), ("x", 1, 10, 8.0), ("x", 3, 12, 6.5), ("y", 2, 20, 5.0)] + [("z", 1 + n % 2, 100 + n, 7.0 + n % 2) for n in range(11)],
        "actor string, year int, film int, rating double")
    bands = [(8, "star"), (7, "good"), (6, "average")]
    args = (["film", "rating"], "rating", bands, "bad")
    prev = None
    states = entity.grouped_entity_states(films, "actor", "year", 3, "rating", bands, "bad")
    for year in (1, 2, 3):
        prev = entity.cumulate_grouped_entity(prev, films, "actor", "year", year, *args, parts)
        prev = spark.createDataFrame(prev.collect(), prev.schema)
        once = entity.backfill_grouped_entity(films, "actor", "year", year, *args, parts)
        assert once.columns == prev.columns and merged(once) == merged(prev)
        assert rows(once) == rows(prev)
        assert {k: (*state, len(ids)) for k, (state, ids) in merged(prev).items()} == {
            r["actor"]: (r["entity_class"], r["is_active"], r["periods_since_active"], r["year"], r["records"])
            for r in states.where(F.col("year") == year).collect()}
    got = merged(prev)
    assert got["x"] == (("average", True, 0, 3), [10, 11, 12]) and got["y"] == (("bad", False, 1, 3), [20])
    assert got["z"][1] == list(range(100, 111))
    assert prev.where("actor = 'z'").count() == parts
    last = entity.backfill_grouped_entity(films, "actor", "year", 3, *args, 1, keep_last=2)
    assert merged(last)["x"][1] == [11, 12]


def test_first_last_ratio_and_unnest(spark):
    df = spark.createDataFrame(
        [("a", [(1, 0.0), (2, 8.0)]), ("b", [(1, 4.0)]), ("c", [])], "name string, history array<struct<season:int,pts:double>>")
    got = {r["name"]: (r["first_pts"], r["latest_pts"], r["ratio"]) for r in entity.first_last_ratio(df, "history", "pts").collect()}
    assert got == {"a": (0.0, 8.0, 8.0), "b": (4.0, 4.0, 1.0), "c": (None, None, None)}
    assert rows(entity.unnest_history(df, "name", "history")) == [("a", 0, 1, 0.0), ("a", 1, 2, 8.0), ("b", 0, 1, 4.0)]
    assert entity.unnest_history(df, "name", "history", keep_empty=True).count() == 4


def test_scd2_runs(spark):
    df = spark.createDataFrame(
        [("p1", 11, "low"), ("p1", 12, "high"), ("p1", 13, "high"), ("p1", 14, "low"), ("p2", 12, "high"), ("p2", 13, "low"), ("p2", 14, "low")],
        "player string, season bigint, class string")
    assert rows(scd.scd2_backfill(df, "player", "season", "class")) == [
        ("p1", "high", 12, 13), ("p1", "low", 11, 11), ("p1", "low", 14, 14), ("p2", "high", 12, 12), ("p2", "low", 13, 14)]


def test_scd2_null_is_a_value(spark):
    df = spark.createDataFrame([("k", 1, "A"), ("k", 2, None), ("k", 3, None), ("k", 4, "A")], "k string, p int, a string")
    assert rows(scd.scd2_backfill(df, "k", "p", "a")) == [("k", "A", 1, 1), ("k", "A", 4, 4), ("k", None, 2, 3)]


def test_scd2_incremental_branches(spark):
    table = spark.createDataFrame(
        [("same", "A", 1, 2, 2), ("moved", "A", 1, 2, 2), ("gone", "A", 1, 2, 2), ("old", "A", 1, 1, 2), ("old", "B", 2, 2, 2), ("nul", None, 1, 2, 2)],
        "k string, a string, start_period int, end_period int, as_of int")
    snap = spark.createDataFrame([("same", "A", 3), ("moved", "B", 3), ("new", "C", 3), ("old", "B", 3), ("nul", None, 3)], "k string, a string, p int")
    out = scd.scd2_incremental(table, snap, "k", "a", "p", 3)
    assert rows(out) == sorted([
        ("same", "A", 1, 3, 3), ("moved", "A", 1, 2, 3), ("moved", "B", 3, 3, 3), ("gone", "A", 1, 2, 3), ("new", "C", 3, 3, 3),
        ("old", "A", 1, 1, 3), ("old", "B", 2, 3, 3), ("nul", None, 1, 3, 3)], key=repr)


def test_state_change(spark):
    df = spark.createDataFrame([("a", p, x) for p, x in enumerate([True, True, False, False, True])], "k string, p int, active boolean")
    got = [r["state"] for r in state.state_change(df, "k", "p", "active").orderBy("p").collect()]
    assert got == ["New", "Continued Playing", "Retired", "Stayed Retired", "Returned from Retirement"]


@pytest.mark.parametrize("size", [1, 3, 50])
def test_grouped_pages_grow_by_period(spark, tmp_path, size):
    """Run period by period the pages equal those made in one pass; a hot key fills many, a quiet one keeps its page."""
    rnd = random.Random(3)
    data = [(k, y, n, rnd.randint(1, 10)) for n, (k, y) in enumerate((rnd.choice("aaaaaabc"), y) for y in range(2000, 2005) for _ in range(40))]
    data += [("quiet", 2001, 1000, 5), (None, 2002, 1001, 6), (None, 2004, 1002, 7)]
    facts = spark.createDataFrame(data, "k string, y int, id int, rating int")
    rules, record = ("rating", [(7, "high")], "low"), ["id", "rating"]
    state = pages = None
    for year in range(2000, 2005):
        before = state
        state = entity.cumulate_grouped_state(state, facts.where("k is not null"), "k", "y", year, *rules)
        pages = entity.cumulate_grouped_pages(pages, before, facts.where("k is not null"), "k", "y", year, record, size)
        for name, df in (("s", state), ("p", pages)):
            df.write.parquet(f"{tmp_path}/{name}{year}")
        state, pages = (spark.read.parquet(f"{tmp_path}/{name}{year}") for name in "sp")
    whole = entity.backfill_grouped_pages(facts, "k", "y", 2004, record, size)
    assert rows(pages) == rows(whole.where("k is not null"))
    assert rows(state) == rows(entity.grouped_entity_states(facts.where("k is not null"), "k", "y", 2004, *rules, emit_from=2004).select(*state.columns))
    assert whole.agg(F.max(F.size("history"))).first()[0] <= size
    # in order, every page but a key's last is full
    for key in ("a", "quiet", None):
        mine = sorted((r["page"], [tuple(x) for x in r["history"]]) for r in whole.where(F.col("k").eqNullSafe(F.lit(key))).collect())
        assert [x for _, page in mine for x in page] == [(n, g) for k, _, n, g in sorted(data, key=lambda d: (d[1], d[2])) if k == key]
        assert [len(page) for _, page in mine[:-1]] == [size] * (len(mine) - 1) and [p for p, _ in mine] == list(range(len(mine)))


def history_by_runs(spark, tmp_path, data, periods, again=()):
    snap = spark.createDataFrame(data, "k string, p int, a string, b boolean")
    table = "t_" + uuid.uuid4().hex[:8]
    for p in [*periods, *again]:
        out = scd.scd2_run(spark, table, snap, "k", ["a", "b"], "p", p, str(tmp_path / table))
    return table, snap, out


def test_scd2_runs_equal_the_backfill(spark, tmp_path):
    """Open and closed rows apart, period by period with repeats, and as of any earlier period."""
    rnd = random.Random(11)
    data = [(k, p, rnd.choice(["x", "y", None]), rnd.random() < 0.5) for k in "abcdef" for p in range(1, 7) if k < "e" or p > 2]
    table, snap, out = history_by_runs(spark, tmp_path, data, range(1, 7), again=[5, 6, 6])
    assert rows(out) == rows(scd.scd2_backfill(snap, "k", "p", ["a", "b"], as_of=6).select(*out.columns))
    for p in (1, 3):
        assert rows(scd.scd2_as_of(spark, table, p)) == rows(scd.scd2_backfill(snap, "k", "p", ["a", "b"], as_of=p).select(*out.columns))


def test_scd2_run_closes_missing_keys_and_refuses_gaps(spark, tmp_path):
    table, snap, out = history_by_runs(spark, tmp_path, [("a", 1, "x", True), ("b", 1, "x", True), ("b", 2, "x", True), ("a", 3, "x", True), ("b", 3, "y", None)], [1, 2, 3])
    assert rows(out.select("k", "a", "start_period", "end_period")) == [("a", "x", 1, 1), ("a", "x", 3, 3), ("b", "x", 1, 2), ("b", "y", 3, 3)]
    with pytest.raises(ValueError, match="run 4 first"):
        scd.scd2_run(spark, table, snap, "k", ["a", "b"], "p", 5)
    # a corrected period closes nothing any more, and what it had closed is gone
    same = spark.createDataFrame([("a", 3, "x", True), ("b", 3, "x", True)], snap.schema)
    again = scd.scd2_run(spark, table, same, "k", ["a", "b"], "p", 3)
    assert rows(again.select("k", "a", "start_period", "end_period")) == [("a", "x", 1, 1), ("a", "x", 3, 3), ("b", "x", 1, 3)]


def test_scd2_run_reads_the_open_partition_alone(spark, tmp_path):
    from conftest import plan

    from strata.session import session_conf

    table, _, _ = history_by_runs(spark, tmp_path, [("a", p, str(p), True) for p in (1, 2, 3)], [1, 2, 3])
    before = scd.open_rows(spark, table, 3)
    assert {f.split(table)[1].rsplit("/", 1)[0] for f in before.inputFiles()} == {"/as_of=3/kind=open"}
    with session_conf(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        assert "kind" in plan(before).split("PartitionFilters: [")[1].split("]")[0]

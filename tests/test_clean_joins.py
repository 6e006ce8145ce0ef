import json
import random
import uuid
from collections import Counter

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from strata.operators import clean, contracts, experiment, geo, joins
from strata.operators.geo import geo_enrich, geo_segments
from strata.operators.guards import broadcastable, maybe_broadcast
from strata.session import session_conf


def test_dedupe(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "c", 1)], "k int, v string, o int")
    assert rows(clean.dedupe_by_key(df, "k", ["o"])) == [(1, "b", 1), (2, "c", 1)]
    assert rows(clean.dedupe_by_key(df, "k", F.col("o").desc())) == [(1, "a", 2), (2, "c", 1)]
    with pytest.raises(ValueError):
        clean.dedupe_by_key(df, "k", [])
    assert rows(clean.dedupe_exact(df.unionByName(df), ["k"])) == [(1,), (2,)]


def test_fill_require_enrich_pair(spark):
    ev = spark.createDataFrame([(1, 10, "x"), (2, 11, None), (3, None, "y")], "e int, d int, r string")
    dim = spark.createDataFrame([(10, "chrome"), (11, None)], "d int, browser string")
    assert rows(clean.fill_unknown(ev, ["r"]).select("e", "r")) == [(1, "x"), (2, "unknown"), (3, "y")]
    assert rows(clean.require_present(ev, ["d", "r"]).select("e")) == [(1,)]
    out = clean.enrich(ev, dim, "d", "left", {"browser": "family"}, upper=["family"])
    assert rows(out.select("e", "family")) == [(1, "CHROME"), (2, None), (3, None)]
    assert clean.enrich(ev, dim, "d").count() == 2
    with pytest.raises(ValueError):
        clean.enrich(ev, dim, "d", "full")
    pairs = clean.join_as_pair(ev, dim, F.col("l.d") == F.col("r.d"), "left").collect()
    assert {(p["left"]["e"], p["right"]["browser"] if p["right"] else "none") for p in pairs} == {(1, "chrome"), (2, None), (3, "none")}


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, m string, v int")
    new = spark.createDataFrame([(2, "b", 20), (3, "c", 30)], "k int, m string, v int")
    assert rows(clean.upsert_by_key(old, new, ["k", "m"])) == [(1, "a", 1), (2, "b", 20), (3, "c", 30)]


def test_contract(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, "z"), (None, "a")], "k int, t string")
    got = rows(contracts.check_contract(df, ["k"], ["k", "t"], {"t": ["a", "b"]}))
    assert got == sorted([("unique", "k", 2), ("not_null", "k", 1), ("not_null", "t", 1), ("domain", "t", 1)], key=repr)
    assert rows(contracts.check_contract(df.where("k = 2"), ["k"], ["k"])) == []
    assert rows(contracts.duplicate_keys(df, ["k"])) == [(1, 3)]
    with pytest.raises(ValueError):
        contracts.check_contract(df)


def test_broadcast_only_after_a_size_check(spark):
    dim = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert broadcastable(dim) and not broadcastable(dim, max_rows=99) and not broadcastable(dim, max_bytes=50_000)
    fact = spark.range(1000)
    for limits in ({}, {"max_rows": 10}):
        joined = fact.join(maybe_broadcast(dim, **limits), "id")
        assert ("rightHint=(strategy=broadcast)" in joined._jdf.queryExecution().optimizedPlan().toString()) is (not limits)
        assert joined.count() == 100


def brute_place(ip, ranges):
    inside = sorted((hi - lo, lo, c) for lo, hi, c in ranges if lo <= ip <= hi)
    return f'{{"country":"{inside[0][2]}","state":"","city":""}}' if inside else "{}"


@pytest.mark.parametrize("bits", [8, 16, 20])
def test_geo_narrowest_range_one_row_each(spark, bits):
    top = 2**32 - 1
    ranges = [(0, 2**24 - 1, "A"), (2**16 - 5, 2**16 + 5, "B"), (100, 200, "C"), (100, 200, "D"), (2**31, top, "E"), (top, top, "F"), (150, 160, "G")]
    dim = spark.createDataFrame([(lo, hi, c, "", "") for lo, hi, c in ranges], "lo bigint, hi bigint, country string, state string, city string")
    if bits == 20:  # keep the widest ranges out of a million prefixes
        dim = dim.where("hi - lo < 20000000")
        ranges = [r for r in ranges if r[1] - r[0] < 20_000_000]
    ips = [0, 99, 100, 149, 150, 160, 161, 200, 201, 2**16 - 6, 2**16 - 5, 2**16, 2**16 + 5, 2**16 + 6, 2**24 - 1, 2**24, 2**31 - 1, 2**31, top - 1, top]
    text = lambda n: ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    ev = spark.createDataFrame([(n, text(n)) for n in ips] + [(-1, "nonsense"), (-2, None)], "n bigint, ip string")
    got = {r["n"]: r["geodata"] for r in geo_enrich(ev, "ip", dim, bits).collect()}
    want = {n: brute_place(n, ranges) for n in ips} | {-1: "{}", -2: "{}"}
    assert got == want
    assert geo_enrich(ev, "ip", geo_segments(dim, bits), bits).count() == len(ips) + 2


def test_match_report(spark):
    details = spark.createDataFrame([(1, "a", 4), (1, "b", 9), (2, "a", 6), (2, "a", 0)], "match_id int, player string, kills int")
    assert rows(joins.avg_kills_per_game(details, "player", "match_id", "kills")) == [("b", 9.0, 1)]
    matches = spark.createDataFrame([(1, "p", 7), (2, "p", 8), (2, "p", 8), (3, "q", 8)], "match_id int, playlist string, map_id int")
    assert rows(joins.most_played(matches, "playlist", "match_id")) == [("p", 2)]
    medals = spark.createDataFrame([(1, "Spree"), (2, "Other")], "medal_id int, medal_name string")
    won = spark.createDataFrame([(1, 1, 3), (1, 1, 2), (3, 1, 1), (3, 2, 50)], "match_id int, medal_id int, medal_count int")
    maps = spark.createDataFrame([(7, "Urban"), (8, "Raid")], "map_id int, map_name string")
    assert rows(joins.top_map_for_medal(won, medals, matches.distinct(), maps, "Spree")) == [(7, 5, "Urban")]


def test_experiment(spark):
    users = spark.range(20_000).select(F.col("id").alias("user_id"))
    arms = experiment.assign_arms(users, "user_id", "s", {"control": 0.5, "b": 0.25, "c": 0.25})
    share = {r["arm"]: r["count"] / 20_000 for r in arms.groupBy("arm").count().collect()}
    assert abs(share["control"] - 0.5) < 0.02 and abs(share["b"] - 0.25) < 0.02 and abs(share["c"] - 0.25) < 0.02
    assert rows(arms.limit(50)) == rows(experiment.assign_arms(users, "user_id", "s", {"control": 2, "b": 1, "c": 1}).limit(50))
    exposed = spark.createDataFrame(
        [(1, "x", "control", 10), (2, "x", "control", 10), (3, "x", "b", 10), (4, "x", "b", 10)], "user_id int, experiment string, arm string, first_exposure int")
    outcomes = spark.createDataFrame([(1, 11, 2.0), (1, 10, 100.0), (2, 9, 50.0), (3, 12, 1.5), (3, 13, 1.5), (4, 11, 1.0), (9, 11, 7.0)], "user_id int, t int, v double")
    split = rows(experiment.experiment_readout(exposed, outcomes, "user_id", "t", "v", most=1))
    assert split == rows(experiment.experiment_readout(exposed, outcomes, "user_id", "t", "v"))
    got = {r["arm"]: r for r in experiment.experiment_readout(exposed, outcomes, "user_id", "t", "v").collect()}
    assert (got["control"]["users"], got["control"]["conversions"], got["control"]["total_value"]) == (2, 1, 2.0)
    assert (got["b"]["users"], got["b"]["conversions"], got["b"]["total_value"], got["b"]["lift"]) == (2, 2, 4.0, 1.0)
    assert abs(got["b"]["z"] - 0.5 / (0.75 * 0.25) ** 0.5) < 1e-12 and got["control"]["z"] is None


def test_kpi_aggregate_is_the_sum_of_units(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5), (None, 1)], "unit string, v int")
    assert rows(experiment.kpi_rollup(df, {"v": "v"}, "unit")) == sorted(
        [("unit", "a", 3), ("unit", "b", 5), ("unit", None, 1), ("aggregate", None, 9)], key=repr)


def test_blocks_make_up_their_range(spark):
    """At most two blocks a level, disjoint, and together exactly the range."""
    rnd = random.Random(4)
    data = [(a, b) for a, b in (sorted(rnd.sample(range(256), 2)) for _ in range(60))] + [(0, 255), (0, 0), (255, 255), (128, 255), (1, 254), (7, 8)]
    df = spark.createDataFrame(data, "lo bigint, hi bigint").withColumn("blocks", geo._blocks("lo", "hi", 8))
    for r in df.collect():
        numbers = [n for b in r["blocks"] for n in range(b["place"] << b["level"], (b["place"] + 1) << b["level"])]
        assert sorted(numbers) == list(range(r["lo"], r["hi"] + 1)) and max(Counter(b["level"] for b in r["blocks"]).values()) <= 2


@pytest.mark.parametrize("prefix_bits", [8, 16])
def test_overlapping_ranges_against_a_loop(spark, prefix_bits):
    rnd = random.Random(prefix_bits)
    base = 10 << 24
    ends = [sorted(rnd.randrange(1 << 18) for _ in range(2)) for _ in range(150)]
    ranges = [(base + a, base + b, f"c{n % 9}", "s", f"n{n}") for n, (a, b) in enumerate(ends)] + [(base, base + (1 << 25), "wide", "", "")]
    numbers = sorted({x for lo, hi, *_ in ranges for x in (lo - 1, lo, (lo + hi) // 2, hi, hi + 1)})
    ips = spark.createDataFrame([(n, ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))) for n in numbers], "n bigint, ip string")
    table = spark.createDataFrame(ranges, "lo bigint, hi bigint, country string, state string, city string")
    got = {r["n"]: json.loads(r["geodata"]) for r in geo.geo_enrich(ips, "ip", table, prefix_bits).collect()}
    for n in numbers:
        holding = [(hi - lo, lo, *place) for lo, hi, *place in ranges if lo <= n <= hi]
        assert list(got[n].values()) == (list(min(holding)[2:]) if holding else [])


def test_many_nested_ranges_under_one_prefix(spark):
    """100,000 nested ranges of one prefix: pieces meet blocks by equality, and the number of rows is linear in the ranges."""
    n = 100_000
    nested = spark.range(n).select((F.col("id") + 5).alias("lo"), (F.lit((1 << 24) - 6) - F.col("id") * 3).alias("hi"),
                                   F.lit("c").alias("country"), F.lit("s").alias("state"), F.col("id").cast("string").alias("city"))
    segments = geo.geo_segments(nested, 8)
    assert "NestedLoop" not in plan(segments) and "Cartesian" not in plan(segments)
    found = segments.select(F.min("seg_lo"), F.max("seg_hi"), F.count(F.lit(1)), F.sum(F.col("seg_hi") - F.col("seg_lo") + 1)).first()
    assert tuple(found) == (5, (1 << 24) - 6, 2 * n - 1, (1 << 24) - 10)
    # left of the middle a piece is one number, held by the range that starts there
    left = segments.where((F.col("seg_lo") < n + 4)).where("city <> cast(seg_lo - 5 as string)")
    assert left.count() == 0


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    table = "t_" + uuid.uuid4().hex[:8]
    df = spark.range(1000).select("id", (F.col("id") % 7).cast("string").alias("k"), F.col("id").cast("double").alias("v"))
    clean.create_upsert_table(df, table, ["id", "k"], 8, str(tmp_path / "t"))
    files = lambda: {p: {f.name for f in p.glob("*.parquet")} for p in (tmp_path / "t").glob("_part=*")}
    before = files()
    new = df.where("id in (3, 4)").withColumn("v", F.col("v") + 0.5).unionByName(spark.createDataFrame([(5000, "x", 1.0), (None, "x", 2.0)], "id bigint, k string, v double"))
    touched = clean.upsert_partitions(spark, table, new.select("v", "k", "id"), ["id", "k"], 8)  # other column order
    want = sorted(rows(df.where("id not in (3, 4)")) + rows(new), key=repr)
    assert rows(spark.table(table).drop(clean.PART)) == want
    after = files()
    assert 0 < len(touched) < 5 and set(before) <= set(after)
    for part in before:
        assert (before[part] == after[part]) == (int(part.name.split("=")[1]) not in touched)
    # again, and with nothing
    clean.upsert_partitions(spark, table, new.where("id is not null"), ["id", "k"], 8)
    assert rows(spark.table(table).drop(clean.PART)) == want
    assert clean.upsert_partitions(spark, table, new.limit(0), ["id", "k"], 8) == []
    with session_conf(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        assert "PartitionFilters: [_part" in plan(spark.table(table).where(F.col(clean.PART).isin(*touched)))


def test_contract_is_checked_while_writing(spark, tmp_path):
    """The same violations as a check, the whole table is written, and the rows are read once."""
    data = [(1, "x", 1), (1, "x", 9), (2, None, 2), (None, "y", 2), (None, "y", None)]
    reads = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame(data, "k int, v string, d int").repartition(3)
    contract = {"keys": ["k"], "not_null": ["v", "d"], "domains": {"d": [1, 2, 3], "v": ["x", "y"]}}
    got = contracts.write_checked(df, str(tmp_path / "t"), **contract)
    assert rows(got) == rows(contracts.check_contract(df, **contract)) == [("domain", "d", 1), ("not_null", "d", 1), ("not_null", "v", 1), ("unique", "k", 2)]
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == rows(df)
    # rows without a row check are written too; a clean table has no violations; an empty one neither
    assert rows(contracts.write_checked(df, str(tmp_path / "u"), keys=["k"])) == [("unique", "k", 2)]
    assert contracts.write_checked(df.where("d = 1"), str(tmp_path / "v"), **contract).count() == 0
    assert contracts.write_checked(df.limit(0), str(tmp_path / "w"), **contract).count() == 0
    with pytest.raises(ValueError, match="empty"):
        contracts.write_checked(df, str(tmp_path / "x"))

    @F.udf("int")
    def counted(d):
        reads.add(1)
        return d

    seen = df.withColumn("d", counted.asNondeterministic()("d"))
    contracts.write_checked(seen, str(tmp_path / "y"), **contract)
    assert reads.value == len(data)

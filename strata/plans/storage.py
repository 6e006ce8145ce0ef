"""Sources and sinks: each query writes below the shared folder and returns what it reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.operators import activity as act
from strata.operators import clean, entity, joins
from strata.operators.skew import large_groups
from strata.plans import inputs as i
from strata.plans.analytics import ORACLES as ANALYTICS, device_hits
from strata.plans.dimensional import ORACLES as DIMENSIONAL, RECORD, STATIC, history_text, snapshots, spending_class
from strata.session import shared_dir
from strata.sources import tables


def _name(label: str) -> str:
    return f"strata_{label}_{uuid.uuid4().hex[:10]}"


def read_table(spark, sf):
    """Devices through CSV and back: typed read, rows without a browser left out."""
    path = shared_dir(spark, "devices-csv")
    i.devices(spark, sf).write.option("header", True).csv(path)
    schema = "device_id bigint, browser_type string, device_type string, os_type string"
    return tables.read_table(spark, path, "csv", schema, require=["browser_type"])


def write_period(spark, sf):
    """Snapshots written season by season set; the last season is written again and replaced."""
    name, path = _name("members"), shared_dir(spark, "members")
    rows = snapshots(spark, sf).select("member_id", "entity_class", "is_active", "periods_since_active", "season")
    tables.write_period(rows.where(F.col("season") < i.LAST_SEASON), name, "season", path)
    last = rows.where(F.col("season") == i.LAST_SEASON)
    tables.write_period(last.withColumn("entity_class", F.lit("draft")), name, "season")
    tables.write_period(last, name, "season")
    return spark.table(name)


def run_periods(spark, sf):
    """The members' snapshots season by season, each from the table written before; the last two are run again."""
    facts = i.member_seasons(spark, sf)
    name, path = _name("members"), shared_dir(spark, "members")

    def step(prev, season):
        return entity.cumulate_entity(prev, facts, "member_id", "season", season, RECORD, spending_class(), STATIC)

    tables.run_periods(spark, name, "season", range(i.FIRST_SEASON, i.LAST_SEASON + 1), step, path)
    tables.run_periods(spark, name, "season", [i.LAST_SEASON - 1, i.LAST_SEASON], step, path)
    return history_text(spark.table(name))


def upsert_by_key(spark, sf):
    """Latest season's spending corrected to twice its value, all other rows kept."""
    rows = i.member_seasons(spark, sf).select("member_id", "season", F.col("pts").cast("double").alias("pts"))
    new = rows.where(F.col("season") == i.LAST_SEASON).withColumn("pts", F.col("pts") * 2)
    return clean.upsert_by_key(rows, new, ["member_id", "season"])


def upsert_partitions(spark, sf):
    """The star seasons of the latest year corrected in place: only the partitions that hold them are rewritten."""
    rows = i.member_seasons(spark, sf).select("member_id", "season", F.col("pts").cast("double").alias("pts"))
    table = _name("seasons")
    clean.create_upsert_table(rows, table, ["member_id", "season"], path=shared_dir(spark, "seasons"))
    stars = rows.where((F.col("season") == i.LAST_SEASON) & (F.col("pts") > i.MEMBER_BANDS[0][0]))
    clean.upsert_partitions(spark, table, stars.withColumn("pts", F.col("pts") * 2), ["member_id", "season"])
    return spark.table(table).drop(clean.PART)


def write_bucketed(spark, sf):
    name = _name("details")
    tables.write_bucketed(i.match_details(spark, sf), name, "match_id", 16, sort=["match_id", "player_id"], path=shared_dir(spark, "details"))
    return spark.table(name)


def bucket_join(spark, sf):
    """Performances joined to their match on 16 buckets, without a shuffle."""
    details, played = _name("details"), _name("matches")
    tables.write_bucketed(i.match_details(spark, sf), details, "match_id", 16, path=shared_dir(spark, "details"))
    tables.write_bucketed(i.matches(spark, sf), played, "match_id", 16, path=shared_dir(spark, "matches"))
    return joins.bucket_join(spark, details, played, "match_id")


# The match that every third line of an order is counted for, so that one key has a third of all rows.
FINAL, SALTED_BUCKETS = 1, 16


def bucket_join_hot(spark, sf):
    """Performances of which more than a third belong to one match, joined to the matches on (match, salt) without a shuffle."""
    match = F.when(F.col("line") % 3 == 1, F.lit(FINAL).cast("bigint")).otherwise(F.col("match_id"))
    played = i.match_details(spark, sf).withColumn("match_id", match)
    matches = i.matches(spark, sf)
    hot = large_groups(played, "match_id", played.count() // SALTED_BUCKETS)
    salts = tables.materialize(tables.bucket_salts(hot, "match_id", SALTED_BUCKETS), _name("salts"), path=shared_dir(spark, "salts"))
    left, right = _name("played"), _name("matches")
    tables.write_salted(played, left, "match_id", SALTED_BUCKETS, salts, path=shared_dir(spark, "played"))
    tables.write_salted(matches, right, "match_id", SALTED_BUCKETS, salts, copies=True, path=shared_dir(spark, "matches"))
    return joins.salted_join(spark, left, right, "match_id")


# Bytes that a task holds for each row of a fact while it sorts, aggregates and joins a bucket (measured: 240 to 270), not those on disk.
FACT_ROW_BYTES = 270


def fact_buckets(rows: int) -> int:
    """Buckets of the facts, so that the task that joins one holds no more than 256 MB, however many rows there are."""
    return max(4, tables.bucket_count(rows, FACT_ROW_BYTES))


def _bucketed(spark, sf):
    """The three facts of a match in as many buckets as the largest needs; matches are also partitioned by year."""
    facts = {
        "details": i.match_details(spark, sf), "medals": i.medals_players(spark, sf),
        "matches": i.matches(spark, sf).withColumn("year", F.year("completion_date"))}
    n = fact_buckets(facts["details"].count())
    names = {label: _name(label) for label in facts}
    for label, df in facts.items():
        tables.write_bucketed(
            df, names[label], "match_id", n, partition_by="year" if label == "matches" else None, path=shared_dir(spark, label))
    return names


YEAR = 1997


def bucket_join_partitioned(spark, sf):
    """One year's matches with all performances and medals: a pruned partition, three bucketed tables, no shuffle of facts."""
    names = _bucketed(spark, sf)
    joined = joins.bucket_join(
        spark, names["matches"], [names["details"]], "match_id", where=F.col("year") == YEAR)
    medals = spark.table(names["medals"]).groupBy("match_id", "player_id").agg(F.sum("medal_count").alias("medals")).hint("merge")
    return joined.join(medals, ["match_id", "player_id"], "left").groupBy("playlist_id", "map_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("kills").alias("kills"), F.sum("medals").alias("medals"))


def bucket_join_report(spark, sf):
    """Kills and deaths per playlist and map: three co-bucketed facts, aggregated before they meet."""
    names = _bucketed(spark, sf)
    kills = spark.table(names["details"]).groupBy("match_id").agg(F.sum("kills").alias("kills"), F.count(F.lit(1)).alias("players"))
    won = spark.table(names["medals"]).groupBy("match_id").agg(F.sum("medal_count").alias("medals"))
    per_match = spark.table(names["matches"]).hint("merge").join(kills.hint("merge"), "match_id", "left").join(won.hint("merge"), "match_id", "left")
    report = per_match.groupBy("playlist_id", "map_id").agg(
        F.count(F.lit(1)).alias("matches"), F.sum("players").alias("players"), F.sum("kills").alias("kills"), F.sum("medals").alias("medals"))
    return joins.broadcast_enrich(report, [(i.maps(spark, sf), "map_id")])


def _layout_events(spark, sf):
    return i.web_events(spark, sf).withColumn("event_date", F.to_date("event_time")).select(
        "event_id", "url", "referrer", "host", "event_time", "event_date")


def write_clustered(spark, sf):
    path = shared_dir(spark, "events-sorted")
    tables.write_clustered(_layout_events(spark, sf), path, "event_date", ["event_date", "host"], n=10)
    return spark.read.parquet(path)


def write_clustered_global(spark, sf):
    path = shared_dir(spark, "events-global")
    tables.write_clustered(_layout_events(spark, sf), path, "event_date", ["event_date", "host", "event_id"], global_sort=True)
    return spark.read.parquet(path)


def layout_report(spark, sf):
    """Rows of player performances with their match, unsorted and sorted, and whether each layout is in files no larger than the data."""
    per_player = i.match_details(spark, sf).groupBy("match_id", "player_id").agg(F.sum("kills").alias("kills"))
    rows = per_player.join(i.matches(spark, sf), "match_id")
    orders = {"playlist_map": ["playlist_id", "map_id"], "map_playlist": ["map_id", "playlist_id"], "date_map": ["completion_date", "map_id"]}
    paths = {label: shared_dir(spark, "layout-" + label) for label in ("unsorted", *orders)}
    with tables.reused(rows) as kept:
        kept.write.parquet(paths["unsorted"])
        for label, cols in orders.items():
            tables.write_clustered(kept, paths[label], cols[0], cols)
    counted = None
    for label, path in paths.items():
        one = spark.read.schema(rows.schema).parquet(path).agg(F.count(F.lit(1)).alias("num_rows")).withColumn("layout", F.lit(label))
        counted = one if counted is None else counted.unionByName(one)
    report = tables.layout_report(spark, paths)
    return report.join(counted, "layout").select(
        "layout", "num_rows", ((F.col("num_files") > 0) & (F.col("size") > F.col("num_rows"))).alias("has_files"))


def materialize(spark, sf):
    return tables.materialize(device_hits(spark, sf), _name("dashboard"), path=shared_dir(spark, "dashboard"))


def reused(spark, sf):
    """One shared aggregate feeding two summaries, stored by the time it is released."""
    path = shared_dir(spark, "reused")
    with tables.reused(act.pair_activity(i.web_events(spark, sf), "user_id", "device_id", "host")) as pairs:
        users = pairs.groupBy("user_id").agg(F.max("event_counts").alias("total_hits"), F.count(F.lit(1)).alias("others"))
        devices = pairs.groupBy("device_id").agg(F.max("event_counts").alias("total_hits"), F.count(F.lit(1)).alias("others"))
        users.select(F.col("user_id").alias("id"), "total_hits", "others").write.parquet(path + "/side=user")
        devices.select(F.col("device_id").alias("id"), "total_hits", "others").write.parquet(path + "/side=device")
    return spark.read.schema("id bigint, total_hits bigint, others bigint, side string").parquet(path)


QUERIES = {
    "read_table": read_table,
    "write_period": write_period,
    "run_periods": run_periods,
    "upsert_by_key": upsert_by_key,
    "upsert_partitions": upsert_partitions,
    "write_bucketed": write_bucketed,
    "bucket_join": bucket_join,
    "bucket_join_hot": bucket_join_hot,
    "bucket_join_report": bucket_join_report,
    "bucket_join_partitioned": bucket_join_partitioned,
    "write_clustered": write_clustered,
    "write_clustered_global": write_clustered_global,
    "layout_report": layout_report,
    "materialize": materialize,
    "reused": reused,
}

_LAYOUT = f"with {i.WEB} select event_id, url, referrer, host, event_time, cast(event_time as date) as event_date from web"

ORACLES = {
    "read_table": f"with {i.DEVICES} select * from devices where browser_type is not null",
    "write_period": f"with {i.SNAPSHOTS} select member_id, entity_class, is_active, periods_since_active, season from snap",
    "run_periods": DIMENSIONAL["backfill_entity"],
    "upsert_by_key": f"""with {i.MEMBER_SEASONS} select member_id, season,
        cast(pts as double) * case when season = {i.LAST_SEASON} then 2 else 1 end as pts from ms""",
    "upsert_partitions": f"""with {i.MEMBER_SEASONS} select member_id, season,
        cast(pts as double) * case when season = {i.LAST_SEASON} and pts > {i.MEMBER_BANDS[0][0]} then 2 else 1 end as pts from ms""",
    "write_bucketed": f"with {i.MATCH_DETAILS} select * from match_details",
    "bucket_join": f"""with {i.MATCH_DETAILS}, {i.MATCHES} select d.*, m.playlist_id, m.map_id, m.completion_date
        from match_details d join matches m on m.match_id = d.match_id""",
    "bucket_join_hot": f"""with {i.MATCH_DETAILS}, {i.MATCHES},
        p as (select * replace (case when line % 3 = 1 then {FINAL}::bigint else match_id end as match_id) from match_details)
        select p.*, m.playlist_id, m.map_id, m.completion_date from p join matches m on m.match_id = p.match_id""",
    "bucket_join_report": f"""with {i.MATCH_DETAILS}, {i.MATCHES},
        k as (select match_id, sum(kills) as kills, sum(medal) as medals, count(*) as players
              from (select l_orderkey as match_id, cast(l_quantity as bigint) as kills, l_linenumber as medal from lineitem) group by 1)
        select m.playlist_id, m.map_id, count(*) as matches, cast(sum(k.players) as bigint) as players, cast(sum(k.kills) as bigint) as kills,
               cast(sum(k.medals) as bigint) as medals, any_value(n.n_name) as map_name
        from matches m left join k on k.match_id = m.match_id join nation n on n.n_nationkey = m.map_id group by 1, 2""",
    "bucket_join_partitioned": f"""with {i.MATCHES},
        l as (select l_orderkey as match_id, l_suppkey as player_id, cast(l_quantity as bigint) as kills,
              sum(l_linenumber) over (partition by l_orderkey, l_suppkey) as medals from lineitem)
        select playlist_id, map_id, count(*) as lines, cast(sum(kills) as bigint) as kills, cast(sum(medals) as bigint) as medals
        from matches join l using (match_id) where year(completion_date) = {YEAR} group by all""",
    "layout_report": f"""with {i.MATCHES}, p as (
          select count(*) as num_rows from (select distinct l_orderkey, l_suppkey from lineitem) join matches on match_id = l_orderkey)
        select unnest(['unsorted', 'playlist_map', 'map_playlist', 'date_map']) as layout, num_rows, true as has_files from p""",
    "write_clustered": _LAYOUT,
    "write_clustered_global": _LAYOUT,
    "materialize": ANALYTICS["grouping_sets_dashboard"],
    "reused": f"""with {i.WEB}, p as (select user_id, device_id, count(*) as n from web group by all)
        select 'user' as side, user_id as id, max(n) as total_hits, count(*) as others from p group by user_id
        union all select 'device', device_id, max(n), count(*) from p group by device_id""",
}

"""Analytical patterns, match report, experiments and KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.columns import classify_by_rules, referrer_rules
from strata.operators import clean, experiment, joins, patterns, state
from strata.plans import inputs as i
from strata.session import shared_dir
from strata.plans.facts import DAILY, daily


# ---- growth and retention -------------------------------------------------

def growth_accounting(spark, sf):
    facts = daily(spark, sf)
    prev = state.growth_accounting_backfill(facts, "user_id", i.DS_BEFORE).where(F.col("date") == i.DS_BEFORE)
    return _dates_text(state.growth_accounting(prev, facts, "user_id", i.DS))


def _dates_text(df):
    return df.withColumn("dates_active", F.array_join(F.transform("dates_active", lambda d: d.cast("string")), ","))


def _accounting(spark, sf):
    return state.accounting_states(daily(spark, sf), "user_id", i.DS)


def growth_accounting_backfill(spark, sf):
    return _dates_text(state.growth_accounting_backfill(daily(spark, sf), "user_id", i.DS))


def retention_curve(spark, sf):
    return state.retention_curve(_accounting(spark, sf))


def retention_by_cohort(spark, sf):
    return state.retention_curve(_accounting(spark, sf), "first_active_date")


# ---- dashboards -----------------------------------------------------------

DIMS = ["browser_type", "device_type", "os_type"]


def device_hits(spark, sf):
    """Hits per device, then the dimension: the join sees one row per device, not per event."""
    per_device = i.web_events(spark, sf).groupBy("device_id").agg(F.count(F.lit(1)).alias("hits"))
    dim = clean.fill_unknown(i.devices(spark, sf), DIMS)
    return patterns.grouping_rollup(
        per_device.join(dim, "device_id"), [DIMS, ["browser_type"], ["os_type"], ["device_type"]], {"number_of_hits": "hits"},
        labels={tuple(DIMS): "os_type__device_type__browser"})


def grouping_sets_dashboard(spark, sf):
    return device_hits(spark, sf).orderBy(F.col("number_of_hits").desc())


def _player_games(spark, sf):
    rows = clean.dedupe_by_key(i.game_details(spark, sf), ["player_id", "game_id"], i.GAME_ORDER)
    return rows.join(i.games(spark, sf), "game_id")


def game_grouping_sets(spark, sf):
    """Points by (player, team), (player, season) and team; games won by team, one row per team and game."""
    points = patterns.grouping_rollup(_player_games(spark, sf), [["player_name", "team_name"], ["player_name", "season"], ["team_name"]], {"points": "pts"})
    played = i.game_details(spark, sf).select("team_name", "game_id").distinct()
    won = i.games(spark, sf).where("won").select("game_id")
    wins = played.join(won, "game_id").groupBy("team_name").agg(F.count(F.lit(1)).alias("games_won"))
    team_level = (points["aggregation_level"] == "team_name") & (points["team_name"] == wins["team_name"])
    return points.join(wins, team_level, "left").select(*[points[c] for c in points.columns], "games_won")


def game_leaders(spark, sf):
    """Most points for one team, most points in one season, most games won."""
    by = F.when(F.col("aggregation_level") == "team_name", F.col("games_won")).otherwise(F.col("points"))
    sets = game_grouping_sets(spark, sf).withColumn("lead", by)
    return patterns.leaders(sets, "lead", "aggregation_level").drop("lead")


# ---- trends ---------------------------------------------------------------

def _source_days(spark, sf):
    """Hits per (referrer, url, day), counted per device before the device join keeps the known devices."""
    source = classify_by_rules("referrer", referrer_rules(i.OWN_SITES)).alias("referrer")
    known = i.devices(spark, sf).select("device_id")
    rows = i.web_events(spark, sf).select("device_id", source, "url", F.to_date("event_time").alias("event_date"))
    counted = rows.groupBy("device_id", "referrer", "url", "event_date").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(known, "device_id").groupBy("referrer", "url", "event_date").agg(F.sum("n").alias("hits"))


def rolling_trends(spark, sf):
    found, path = _source_days(spark, sf), shared_dir(spark, "source-days")
    found.write.parquet(path)
    days = spark.read.schema(found.schema).parquet(path)
    totals = days.where("referrer is not null").groupBy("referrer", "url").agg(F.sum("hits").alias("n"))
    # above the mean, so that the filter bites at every size
    return patterns.rolling_trends(days, ["referrer", "url"], "event_date", "hits", min_total=totals.agg(F.avg("n").alias("mean")), required="referrer")


def rolling_trends_calendar(spark, sf):
    return patterns.rolling_trends(_source_days(spark, sf), ["referrer", "url"], "event_date", "hits", previous=(13, 6), calendar=True, required="referrer")


def share_of_total(spark, sf):
    return patterns.share_of_total(_source_days(spark, sf), ["referrer", "url"], "hits", "event_date", required="referrer")


def funnel_conversion(spark, sf):
    return patterns.funnel_conversion(i.web_events(spark, sf), "user_id", "event_time", "url", "/purchase", min_n=100)


def best_stretch(spark, sf):
    return patterns.best_stretch(i.team_games(spark, sf), "team", "game_date", "game_id", "win", n=90)


def longest_streak(spark, sf):
    rows = _player_games(spark, sf)
    raw = i.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("player_id"))
    out = patterns.longest_streak(rows, "player_id", "game_date", "game_id", F.col("pts") > 10, counted=raw)
    names = i.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("player_name"))
    return out.join(names, "player_id")


# ---- joins ----------------------------------------------------------------

def broadcast_enrich(spark, sf):
    fact = i.medals_players(spark, sf).join(i.matches(spark, sf).select("match_id", "map_id"), "match_id")
    out = joins.broadcast_enrich(fact, [(i.medals(spark, sf), "medal_id"), (i.maps(spark, sf), "map_id")])
    return out.select("match_id", "player_id", "medal_id", "medal_count", "medal_name", "map_name")


def avg_kills_per_game(spark, sf):
    return joins.avg_kills_per_game(i.match_details(spark, sf), "player_id", "match_id", "kills")


def most_played_playlist(spark, sf):
    return joins.most_played(i.matches(spark, sf), "playlist_id", "match_id")


def most_played_map(spark, sf):
    return joins.most_played(i.matches(spark, sf), "map_id", "match_id")


def top_map_for_medal(spark, sf):
    return joins.top_map_for_medal(i.medals_players(spark, sf), i.medals(spark, sf), i.matches(spark, sf), i.maps(spark, sf), "ECONOMY")


# ---- experiments and KPIs -------------------------------------------------

SALT = "button-color:"
LARGE_PURCHASE = 150


def _arms(spark, sf):
    users = clean.require_present(i.web_events(spark, sf), ["user_id"]).select("user_id").distinct()
    return experiment.assign_arms(users, "user_id", SALT)


def assign_arms(spark, sf):
    users = i.table(spark, sf, "customer").select("c_custkey")
    return experiment.assign_arms(users, "c_custkey", SALT, {"control": 0.5, "blue": 0.3, "green": 0.2})


def exposures(spark, sf):
    return experiment.exposures(i.web_events(spark, sf), _arms(spark, sf), "user_id", "event_time", "url", "/signup", "button_color")


def experiment_readout(spark, sf):
    outcomes = i.web_events(spark, sf).where((F.col("url") == "/purchase") & (F.col("value") > LARGE_PURCHASE))
    return experiment.experiment_readout(exposures(spark, sf), outcomes, "user_id", "event_time", "value")


def kpi_profit(spark, sf):
    """Profit per supplier and in total."""
    price = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    out = experiment.kpi_rollup(i.table(spark, sf, "lineitem"), {"profit": price, "units": F.col("l_quantity").cast("bigint")}, "l_suppkey")
    return out.withColumn("profit", F.col("profit").cast("double"))


def kpi_growth(spark, sf):
    """New users per day and in total."""
    first = clean.require_present(i.web_events(spark, sf), ["user_id"]).groupBy("user_id").agg(F.to_date(F.min("event_time")).alias("day"))
    return experiment.kpi_rollup(first, {"new_users": F.lit(1).cast("bigint")}, "day")


def kpi_engagement(spark, sf):
    """Events and purchases per host and in total."""
    bought = (F.col("url") == "/purchase").cast("bigint")
    return experiment.kpi_rollup(i.web_events(spark, sf), {"events": F.lit(1).cast("bigint"), "purchases": bought}, "host")


QUERIES = {
    "growth_accounting": growth_accounting,
    "growth_accounting_backfill": growth_accounting_backfill,
    "retention_curve": retention_curve,
    "retention_by_cohort": retention_by_cohort,
    "grouping_sets_dashboard": grouping_sets_dashboard,
    "game_grouping_sets": game_grouping_sets,
    "game_leaders": game_leaders,
    "rolling_trends": rolling_trends,
    "rolling_trends_calendar": rolling_trends_calendar,
    "share_of_total": share_of_total,
    "funnel_conversion": funnel_conversion,
    "best_stretch": best_stretch,
    "longest_streak": longest_streak,
    "broadcast_enrich": broadcast_enrich,
    "avg_kills_per_game": avg_kills_per_game,
    "most_played": most_played_playlist,
    "most_played_map": most_played_map,
    "top_map_for_medal": top_map_for_medal,
    "assign_arms": assign_arms,
    "exposures": exposures,
    "experiment_readout": experiment_readout,
    "kpi_rollup": kpi_profit,
    "kpi_growth": kpi_growth,
    "kpi_engagement": kpi_engagement,
}

_GROWTH = f"""ends as (select user_id, min(day) as first_day from daily group by user_id),
cal as (select cast(unnest(generate_series(date '2024-01-01', date '{i.DS}', interval 1 day)) as date) as day),
grid as (
  select e.user_id, e.first_day, c.day,
         (select max(d.day) from daily d where d.user_id = e.user_id and d.day < c.day) as last,
         exists (select 1 from daily d where d.user_id = e.user_id and d.day = c.day) as active
  from ends e join cal c on c.day >= e.first_day),
ga as (
  select user_id, first_day as first_active_date, case when active then day else last end as last_active_date,
    case when last is null then 'New' when active and last = day - 1 then 'Retained' when active and last < day - 1 then 'Resurrected'
         when not active and last = day - 1 then 'Churned' else 'Stale' end as daily_active_state,
    case when last is null then 'New' when active and last < day - 7 then 'Resurrected' when not active and last = day - 8 then 'Churned'
         when (case when active then day else last end) + 7 >= day - 1 then 'Retained' else 'Stale' end as weekly_active_state,
    day as date
  from grid),
full_ga as (
  select g.*, (select string_agg(cast(d.day as varchar), ',' order by d.day) from daily d where d.user_id = g.user_id and d.day <= g.date) as dates_active
  from ga g)"""
# The level's name and the label of rolled-up columns. Each level is a group-by of its own.
_KNOWN = "(select " + ", ".join(f"coalesce({c}, 'unknown') as {c}" for c in DIMS) + " from devices join web using (device_id))"
_LEVELS = "levels as (" + " union all ".join(
    f"select '{name}' as aggregation_level, " + ", ".join(c if c in kept else f"'(overall)' as {c}" for c in DIMS)
    + f", count(*) as number_of_hits from {_KNOWN} group by all"
    for name, kept in [("os_type__device_type__browser", DIMS), *((c, [c]) for c in DIMS)]) + ")"
_SOURCE = f"""src as (
  select {i.SQL_REFERRER} as referrer,
         url, cast(event_time as date) as event_date, count(*) as hits
  from web w join devices d on d.device_id = w.device_id group by all)"""
_TRENDS = """select referrer, url, event_date, hits,
    cast(sum(hits) over (partition by referrer, url, date_trunc('month', event_date)) as bigint) as monthly_total,
    cast(sum(hits) over (partition by referrer, url order by event_date) as bigint) as running_total,
    cast(sum(hits) over (partition by referrer, url) as bigint) as grand_total,
    cast(sum(hits) over (partition by referrer, url order by event_date {week}) as bigint) as weekly_rolling,
    cast(sum(hits) over (partition by referrer, url order by event_date {before}) as bigint) as previous_weekly_rolling
  from src where referrer is not null"""
_ROWS = _TRENDS.format(week="rows between 6 preceding and current row", before="rows between 13 preceding and 7 preceding")
_DAYS = _TRENDS.format(week="range between interval 6 days preceding and current row",
                       before="range between interval 13 days preceding and interval 6 days preceding")
_PLAYED = f"{i.GAME_DETAILS}, {i.GAMES}, pg as (select p.*, g.game_date, g.season, g.won from played p join games g on g.game_id = p.game_id)"
_SETS = """gs as (
  select case when grouping(team_name) = 0 and grouping(player_name) = 0 then 'player_name__team_name'
              when grouping(season) = 0 then 'player_name__season' else 'team_name' end as aggregation_level,
         coalesce(player_name, '(overall)') as player_name, coalesce(team_name, '(overall)') as team_name,
         coalesce(cast(season as varchar), '(overall)') as season, cast(sum(pts) as bigint) as points,
         case when grouping(player_name) = 1 then count(distinct case when won then game_id end) end as games_won
  from pg group by grouping sets ((player_name, team_name), (player_name, season), (team_name)))"""
_ARM = f"(('0x' || substr(md5('{SALT}' || {{key}}), 1, 8))::bigint % 10000)"
_EXPOSED = f"""exposed as (
  select user_id, 'button_color' as experiment, case when {_ARM.format(key='user_id')} < 5000 then 'control' else 'treatment' end as arm,
         min(event_time) as first_exposure from web where url = '/signup' and user_id is not null group by user_id)"""

ORACLES = {
    "growth_accounting": f"with {i.WEB}, {DAILY}, {_GROWTH} select * from full_ga where date = date '{i.DS}'",
    "growth_accounting_backfill": f"with {i.WEB}, {DAILY}, {_GROWTH} select * from full_ga",
    "retention_curve": f"""with {i.WEB}, {DAILY}, {_GROWTH} select cast(date - first_active_date as integer) as days_since_first_active,
        count(*) filter (where daily_active_state in ('New', 'Retained', 'Resurrected')) / count(*) as pct_active, count(*) as entities
        from ga group by 1""",
    "retention_by_cohort": f"""with {i.WEB}, {DAILY}, {_GROWTH} select first_active_date, cast(date - first_active_date as integer) as days_since_first_active,
        count(*) filter (where daily_active_state in ('New', 'Retained', 'Resurrected')) / count(*) as pct_active, count(*) as entities
        from ga group by 1, 2""",
    "grouping_sets_dashboard": f"with {i.WEB}, {i.DEVICES}, {_LEVELS} select * from levels",
    "game_grouping_sets": f"with {_PLAYED}, {_SETS} select * from gs",
    "game_leaders": f"""with {_PLAYED}, {_SETS}, ranked as (
          select *, rank() over (partition by aggregation_level order by case when aggregation_level = 'team_name' then games_won else points end desc) as r from gs)
        select * exclude (r) from ranked where r = 1""",
    "rolling_trends": f"""with {i.WEB}, {i.DEVICES}, {_SOURCE}, t as ({_ROWS})
        select *, hits / monthly_total as pct_of_month, hits / grand_total as pct_of_total from t
        where grand_total > (select avg(n) from (select sum(hits) as n from src where referrer is not null group by referrer, url))""",
    "rolling_trends_calendar": f"""with {i.WEB}, {i.DEVICES}, {_SOURCE}, t as ({_DAYS})
        select *, hits / monthly_total as pct_of_month, hits / grand_total as pct_of_total from t""",
    "share_of_total": f"""with {i.WEB}, {i.DEVICES}, {_SOURCE}, t as ({_ROWS})
        select referrer, url, event_date, hits, monthly_total, grand_total, hits / monthly_total as pct_of_month, hits / grand_total as pct_of_total from t""",
    "funnel_conversion": f"""with {i.WEB}, visit as (
          select url, event_time, max(event_time) over day as final, max(event_time) filter (where url = '/purchase') over day as bought
          from (select distinct user_id, event_time, url from web where user_id is not null)
          window day as (partition by user_id, cast(event_time as date)))
        select url, count(*) as events, count(*) filter (where bought > event_time) as converted,
               count(*) filter (where bought > event_time) / count(*) as conversion_rate
        from visit where event_time < final group by url having count(*) filter (where bought > event_time) > 0 and count(*) > 100""",
    "best_stretch": f"""with {i.TEAM_GAMES}, f as (select team,
          sum(win) over w as wins, count(*) over w as games from tg
          window w as (partition by team order by game_date, game_id rows between 89 preceding and current row))
        select team, cast(max(wins) as bigint) as most_wins, max(games) as games_in_window from f group by team""",
    "longest_streak": f"""with {_PLAYED}, seq as (select *, row_number() over (partition by player_id order by game_date, game_id) as no,
            row_number() over (partition by player_id, pts > 10 order by game_date, game_id) as rk from pg),
        islands as (select player_id, no - rk as island, count(*) as len, min(game_date) as a, max(game_date) as b, min(no) as pos
          from seq where pts > 10 group by 1, 2),
        best as (select * from (select *, row_number() over (partition by player_id order by len desc, pos) as r from islands) where r = 1)
        select p.player_id, p.player_name, coalesce(b.len, 0) as streak, b.a as streak_start, b.b as streak_end
        from (select distinct player_id, player_name from pg) p left join best b on b.player_id = p.player_id""",
    "broadcast_enrich": f"""with {i.MATCHES} select l_orderkey as match_id, l_suppkey as player_id, l_partkey as medal_id,
        cast(l_linenumber as bigint) as medal_count, p_type as medal_name, n_name as map_name
        from lineitem join matches on match_id = l_orderkey left join part on p_partkey = l_partkey left join nation on n_nationkey = map_id""",
    "avg_kills_per_game": f"""with {i.MATCH_DETAILS}, m as (select player_id, match_id, sum(kills) as kills from match_details group by 1, 2),
        a as (select player_id, avg(kills) as avg_kills, count(*) as matches from m group by 1)
        select * from a where avg_kills = (select max(avg_kills) from a)""",
    "most_played": f"""with {i.MATCHES}, n as (select playlist_id, count(distinct match_id) as matches from matches group by 1)
        select * from n where matches = (select max(matches) from n)""",
    "most_played_map": f"""with {i.MATCHES}, n as (select map_id, count(distinct match_id) as matches from matches group by 1)
        select * from n where matches = (select max(matches) from n)""",
    "top_map_for_medal": f"""with {i.MATCHES}, n as (select map_id, n_name as map_name, cast(sum(l_linenumber) as bigint) as medals
          from lineitem join part on p_partkey = l_partkey join matches on match_id = l_orderkey join nation on n_nationkey = map_id
          where p_type = 'ECONOMY' group by 1, 2)
        select * from n where medals = (select max(medals) from n)""",
    "assign_arms": f"""select c_custkey, case when {_ARM.format(key='c_custkey')} < 5000 then 'control' when {_ARM.format(key='c_custkey')} < 8000 then 'blue'
        else 'green' end as arm from customer""",
    "exposures": f"with {i.WEB}, {_EXPOSED} select * from exposed",
    "experiment_readout": f"""with {i.WEB}, {_EXPOSED}, spent as (
          select e.user_id, sum(cast(w.value as decimal(18,2))) as v from exposed e join web w on w.user_id = e.user_id
          where w.url = '/purchase' and w.value > {LARGE_PURCHASE} and w.event_time > e.first_exposure group by 1),
        arms as (select experiment, arm, count(*) as users, count(v) as conversions, cast(coalesce(sum(v), 0) as double) as total_value
          from exposed e left join spent s on s.user_id = e.user_id group by 1, 2),
        r as (select *, conversions / users as conversion_rate, total_value / users as value_per_user from arms),
        c as (select * from r where arm = 'control')
        select r.*, case when r.arm <> 'control' then r.conversion_rate / c.conversion_rate - 1 end as lift,
          case when r.arm <> 'control' then r.value_per_user / c.value_per_user - 1 end as value_lift,
          case when r.arm <> 'control' then (r.conversion_rate - c.conversion_rate)
            / sqrt(((r.conversions + c.conversions) / (r.users + c.users)) * (1 - (r.conversions + c.conversions) / (r.users + c.users))
                   * (1 / r.users + 1 / c.users)) end as z
        from r left join c on c.experiment = r.experiment""",
    "kpi_rollup": """with p as (select l_suppkey, cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2))) as profit,
          cast(l_quantity as bigint) as units from lineitem)
        select case when grouping(l_suppkey) = 0 then 'unit' else 'aggregate' end as level, l_suppkey, cast(sum(profit) as double) as profit,
          cast(sum(units) as bigint) as units from p group by grouping sets ((l_suppkey), ())""",
    "kpi_growth": f"""with {i.WEB}, f as (select cast(min(event_time) as date) as day from web where user_id is not null group by user_id)
        select case when grouping(day) = 0 then 'unit' else 'aggregate' end as level, day, count(*) as new_users from f group by grouping sets ((day), ())""",
    "kpi_engagement": f"""with {i.WEB} select case when grouping(host) = 0 then 'unit' else 'aggregate' end as level, host, count(*) as events,
        count(*) filter (where url = '/purchase') as purchases from web group by grouping sets ((host), ())""",
}

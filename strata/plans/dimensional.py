"""Entity snapshots, SCD2, state changes, graph."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strata.functions.columns import band
from strata.operators import entity, graph, scd, state
from strata.plans import inputs as i
from strata.session import shared_dir

STATIC = ["segment", "nation"]
RECORD = ["season", "gp", "pts"]


def spending_class():
    return band("pts", i.MEMBER_BANDS, i.LOWEST)


def snapshots(spark, sf, last=i.LAST_SEASON, emit_from=None):
    return entity.backfill_entity(
        i.member_seasons(spark, sf), "member_id", "season", last, RECORD, spending_class(), STATIC, emit_from=emit_from)


def history_text(df):
    """The history array as text season:gp:pts,... so that engines can be compared."""
    item = lambda x: F.concat_ws(":", x["season"].cast("string"), x["gp"].cast("string"), x["pts"].cast("string"))
    return df.withColumn("history", F.array_join(F.transform("history", item), ","))


def cumulate_entity(spark, sf):
    prev = snapshots(spark, sf, i.LAST_SEASON - 1, emit_from=i.LAST_SEASON - 1)
    out = entity.cumulate_entity(prev, i.member_seasons(spark, sf), "member_id", "season", i.LAST_SEASON, RECORD, spending_class(), STATIC)
    return history_text(out)


def backfill_entity(spark, sf):
    return history_text(snapshots(spark, sf))


def member_band(spark, sf):
    return i.member_seasons(spark, sf).select("member_id", "season", spending_class().alias("entity_class"))


def first_last_ratio(spark, sf):
    latest = snapshots(spark, sf, emit_from=i.LAST_SEASON)
    as_double = F.transform("history", lambda x: F.struct(x["pts"].cast("double").alias("pts")))
    out = entity.first_last_ratio(latest.withColumn("history", as_double), "history", "pts")
    return out.select("member_id", "first_pts", "latest_pts", "ratio")


def unnest_history(spark, sf):
    latest = snapshots(spark, sf, emit_from=i.LAST_SEASON)
    return entity.unnest_history(latest, "member_id", "history").withColumn("pts", F.col("pts").cast("double"))


def scd2_backfill(spark, sf):
    return scd.scd2_backfill(snapshots(spark, sf), "member_id", "season", "entity_class")


ATTRS = ["entity_class", "is_active"]


def scd2_backfill_attrs(spark, sf):
    return scd.scd2_backfill(snapshots(spark, sf), "member_id", "season", ATTRS, as_of=i.LAST_SEASON)


def scd2_incremental(spark, sf):
    snap = snapshots(spark, sf)
    before = scd.scd2_backfill(snap, "member_id", "season", ATTRS, as_of=i.LAST_SEASON - 1)
    return scd.scd2_incremental(before, snapshots(spark, sf, emit_from=i.LAST_SEASON), "member_id", ATTRS, "season", i.LAST_SEASON)


def scd2_run(spark, sf):
    """The history run season by season on a table that keeps open and closed rows apart; the last season is run again."""
    stored = shared_dir(spark, "snapshots")
    snapshots(spark, sf).select("member_id", "season", *ATTRS).write.partitionBy("season").parquet(stored)
    snap = spark.read.schema("member_id bigint, entity_class string, is_active boolean, season int").parquet(stored)
    table, path = f"strata_scd_{uuid.uuid4().hex[:10]}", shared_dir(spark, "scd")
    for season in (*range(i.FIRST_SEASON, i.LAST_SEASON + 1), i.LAST_SEASON):
        history = scd.scd2_run(spark, table, snap, "member_id", ATTRS, "season", season, path)
    return history


FILM_RECORD = ["film_id", "votes", "rating"]
FILM_PARTS = 4


def cumulate_grouped_entity(spark, sf):
    films = i.films(spark, sf)
    before, last = i.LAST_SEASON - 1, i.LAST_SEASON
    rules = (FILM_RECORD, "rating", i.RATING_BANDS, i.LOWEST, FILM_PARTS)
    prev = entity.backfill_grouped_entity(films, "actor_id", "year", before, *rules)
    out = entity.cumulate_grouped_entity(prev, films, "actor_id", "year", last, *rules)
    text = F.transform("history", lambda x: F.concat_ws(":", x["film_id"].cast("string"), x["rating"].cast("string")))
    return out.select("actor_id", "part", "year", F.array_join(text, ",").alias("films"),
                      F.col("entity_class").alias("quality_class"), "is_active")


# Records in a page of an actor's films.
FILM_PAGE = 8


def _film_text(pages):
    text = F.transform("history", lambda x: F.concat_ws(":", x["film_id"].cast("string"), x["rating"].cast("string")))
    return pages.select("actor_id", "page", F.array_join(text, ",").alias("films"))


def cumulate_grouped_pages(spark, sf):
    """Pages of films and the states of the last two years, year by year from what was stored for the year before."""
    films, rules = i.films(spark, sf), ("rating", i.RATING_BANDS, i.LOWEST)
    start = i.LAST_SEASON - 2
    state = entity.grouped_entity_states(films.where(F.col("year") <= start), "actor_id", "year", start, *rules, emit_from=start)
    pages = entity.backfill_grouped_pages(films, "actor_id", "year", start, FILM_RECORD, FILM_PAGE)
    for year in (start + 1, start + 2):
        paths = [shared_dir(spark, name) for name in ("film-states", "film-pages")]
        for df, path in zip((state, pages), paths):
            df.write.parquet(path)
        state, pages = (spark.read.schema(df.schema).parquet(path) for df, path in zip((state, pages), paths))
        before = state
        state = entity.cumulate_grouped_state(state, films, "actor_id", "year", year, *rules)
        pages = entity.cumulate_grouped_pages(pages, before, films, "actor_id", "year", year, FILM_RECORD, FILM_PAGE)
    return _film_text(pages).join(state.drop("periods_since_active"), "actor_id")


def backfill_grouped_pages(spark, sf):
    return _film_text(entity.backfill_grouped_pages(i.films(spark, sf), "actor_id", "year", i.LAST_SEASON, FILM_RECORD, FILM_PAGE))


def grouped_entity_states(spark, sf):
    return entity.grouped_entity_states(i.films(spark, sf), "actor_id", "year", i.LAST_SEASON, "rating", i.RATING_BANDS, i.LOWEST)


def state_change(spark, sf):
    return state.state_change(snapshots(spark, sf), "member_id", "season", "is_active")


def vertices(spark, sf):
    nation = i.table(spark, sf, "nation")
    teams = i.table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    out = graph.vertices(teams, "n_nationkey", "team", {"abbreviation": "n_name", "nickname": "s_name", "region": "n_regionkey"}, ["s_suppkey"])
    return out.select("identifier", "type", *[F.col("properties")[p].alias(p) for p in ("abbreviation", "nickname", "region")])


def vertices_of_facts(spark, sf):
    """Players and games as vertices: totals of a player's performances, the line-up of a game. All three vertex types share one layout."""
    played = i.game_details(spark, sf)
    first = F.min(F.struct(*i.GAME_ORDER, "team_name"))["team_name"]
    players = graph.aggregate_vertices(played, "player_id", "player", {
        "name": F.min("player_name"), "games": F.count_distinct("game_id"), "points": F.sum("pts"), "team": F.min("team_name")})
    games = graph.aggregate_vertices(played, "game_id", "game", {
        "name": first, "games": F.lit(1), "points": F.sum("pts"), "team": F.array_join(F.sort_array(F.collect_set("team_name")), "|")})
    fields = ("name", "games", "points", "team")
    return players.unionByName(games).select("identifier", "type", *[F.col("properties")[p].alias(p) for p in fields])


def membership_edges(spark, sf):
    out = graph.membership_edges(
        i.game_details(spark, sf), "player_id", "player", "game_id", "game", "plays_in",
        {"pts": "pts", "team_id": "team_id", "team_name": "team_name"}, i.GAME_ORDER)
    return out.select(*[c for c in out.columns if c != "properties"],
                      *[F.col("properties")[p].alias(p) for p in ("pts", "team_id", "team_name")])


def cooccurrence_edges(spark, sf):
    raw = i.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("game_id"))
    names = i.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("player_name"))
    return graph.cooccurrence_edges(
        i.game_details(spark, sf), "game_id", "player_id", "player_name", "team_id", "pts", i.GAME_ORDER, counted=raw, labels=names)


_SCD = """changes as (
  select *, lag(season) over w is null or lag({first}) over w is distinct from {first}{more} as changed
  from snap where season <= {last} window w as (partition by member_id order by season)),
runs as (select *, sum(case when changed then 1 else 0 end) over (partition by member_id order by season) as run from changes)"""
_SCD_ONE = _SCD.format(first="entity_class", more="", last=i.LAST_SEASON)
_SCD_TWO = _SCD.format(first="entity_class", more=" or lag(is_active) over w is distinct from is_active", last=i.LAST_SEASON)
_SCD_TWO_SQL = f"""with {i.SNAPSHOTS}, {_SCD_TWO}
  select member_id, entity_class, is_active, min(season) as start_period, max(season) as end_period, cast({i.LAST_SEASON} as integer) as as_of
  from runs group by member_id, entity_class, is_active, run"""

QUERIES = {
    "cumulate_entity": cumulate_entity,
    "backfill_entity": backfill_entity,
    "band": member_band,
    "first_last_ratio": first_last_ratio,
    "unnest_history": unnest_history,
    "scd2_backfill": scd2_backfill,
    "scd2_backfill_attrs": scd2_backfill_attrs,
    "scd2_incremental": scd2_incremental,
    "scd2_run": scd2_run,
    "cumulate_grouped_entity": cumulate_grouped_entity,
    "grouped_entity_states": grouped_entity_states,
    "cumulate_grouped_pages": cumulate_grouped_pages,
    "backfill_grouped_pages": backfill_grouped_pages,
    "state_change": state_change,
    "vertices": vertices,
    "vertices_of_facts": vertices_of_facts,
    "membership_edges": membership_edges,
    "cooccurrence_edges": cooccurrence_edges,
}

_CAREER = """spine as (select actor_id, unnest(range(min(year), {end})) as year from films group by actor_id),
yearly as (select actor_id, year, avg(rating) as mean, count(*) as n from films group by 1, 2)""".format(end=i.LAST_SEASON + 1)

_FILM_PAGES = f"""placed as (select *, (row_number() over (partition by actor_id order by year, film_id) - 1) // {FILM_PAGE} as page from films),
pages as (select actor_id, page, string_agg(film_id || ':' || rating, ',' order by year, film_id) as films from placed group by 1, 2)"""

ORACLES = {
    "cumulate_entity": f"with {i.SNAPSHOTS} select * from snap where season = {i.LAST_SEASON}",
    "backfill_entity": f"with {i.SNAPSHOTS} select * from snap",
    "band": f"with {i.MEMBER_SEASONS} select member_id, season, {i.sql_band('pts', i.MEMBER_BANDS, i.LOWEST)} as entity_class from ms",
    "first_last_ratio": f"""with {i.MEMBER_SEASONS}, ends as (
        select member_id, cast(arg_min(pts, season) as double) as first_pts, cast(arg_max(pts, season) as double) as latest_pts from ms group by member_id)
        select *, latest_pts / (case when first_pts = 0 then 1 else first_pts end) as ratio from ends""",
    "unnest_history": f"""with {i.MEMBER_SEASONS}
        select member_id, cast(row_number() over (partition by member_id order by season) - 1 as integer) as position, season, gp,
               cast(pts as double) as pts from ms""",
    "scd2_backfill": f"""with {i.SNAPSHOTS}, {_SCD_ONE}
        select member_id, entity_class, min(season) as start_period, max(season) as end_period
        from runs group by member_id, entity_class, run""",
    "scd2_backfill_attrs": _SCD_TWO_SQL,
    "scd2_incremental": _SCD_TWO_SQL,
    "scd2_run": _SCD_TWO_SQL,
    "cumulate_grouped_entity": f"""with {i.FILMS}, {_CAREER}, latest as (
          select actor_id, arg_max(mean, year) as mean, max(year) as last_year from yearly group by actor_id)
        select f.actor_id, {i.sql_part("f.film_id", FILM_PARTS)} as part, cast({i.LAST_SEASON} as integer) as year,
               string_agg(f.film_id || ':' || f.rating, ',' order by f.year, f.film_id) as films,
               {i.sql_band('any_value(l.mean)', i.RATING_BANDS, i.LOWEST)} as quality_class,
               any_value(l.last_year) = {i.LAST_SEASON} as is_active
        from films f join latest l on l.actor_id = f.actor_id group by 1, 2""",
    "grouped_entity_states": f"""with {i.FILMS}, {_CAREER}
        select s.actor_id, {i.sql_band('arg_max(y.mean, y.year)', i.RATING_BANDS, i.LOWEST)} as entity_class,
               max(y.year) = s.year as is_active, cast(s.year - max(y.year) as integer) as periods_since_active,
               cast(s.year as integer) as year, cast(sum(y.n) as bigint) as records
        from spine s join yearly y on y.actor_id = s.actor_id and y.year <= s.year group by s.actor_id, s.year""",
    "cumulate_grouped_pages": f"""with {i.FILMS}, {_CAREER}, {_FILM_PAGES}, latest as (
          select actor_id, arg_max(mean, year) as mean, max(year) as last_year, cast(sum(n) as bigint) as records from yearly group by actor_id)
        select p.*, {i.sql_band('mean', i.RATING_BANDS, i.LOWEST)} as entity_class, last_year = {i.LAST_SEASON} as is_active,
               cast({i.LAST_SEASON} as integer) as year, records from pages p join latest using (actor_id)""",
    "backfill_grouped_pages": f"with {i.FILMS}, {_FILM_PAGES} select * from pages",
    "state_change": f"""with {i.SNAPSHOTS}, steps as (
          select member_id, season, is_active, lag(is_active) over (partition by member_id order by season) as before from snap)
        select member_id, season, is_active, case when before is null and is_active then 'New'
            when before and is_active then 'Continued Playing' when before then 'Retired'
            when not before and is_active then 'Returned from Retirement' when not before then 'Stayed Retired' end as state
        from steps""",
    "vertices": """select n_nationkey as identifier, 'team' as type, n_name as abbreviation, s_name as nickname, cast(n_regionkey as varchar) as region
        from (select *, row_number() over (partition by n_nationkey order by s_suppkey) as rn
              from supplier join nation on n_nationkey = s_nationkey) where rn = 1""",
    "vertices_of_facts": f"""with {i.GAME_DETAILS}
        select player_id as identifier, 'player' as type, any_value(player_name) as name, cast(count(distinct game_id) as varchar) as games,
               cast(sum(pts) as varchar) as points, any_value(team_name) as team from gd group by player_id
        union all select game_id, 'game', arg_min(team_name, (l_linenumber, l_partkey, pts, team_name)), '1', cast(sum(pts) as varchar),
               string_agg(distinct team_name, '|' order by team_name) from gd group by game_id""",
    "membership_edges": f"""with {i.GAME_DETAILS}
        select player_id as subject_identifier, 'player' as subject_type, game_id as object_identifier, 'game' as object_type,
               'plays_in' as edge_type, cast(pts as varchar) as pts, cast(team_id as varchar) as team_id, team_name from played""",
    "cooccurrence_edges": f"""with {i.GAME_DETAILS}
        select a.player_id as subject_identifier, a.player_name as subject_name, b.player_id as object_identifier,
               b.player_name as object_name, case when a.team_name = b.team_name then 'shares_team' else 'plays_against' end as edge_type,
               count(*) as num_events, cast(sum(a.pts) as bigint) as subject_total, cast(sum(b.pts) as bigint) as object_total
        from played a join played b on a.game_id = b.game_id and a.player_id > b.player_id and a.player_name <> b.player_name
        group by all""",
}

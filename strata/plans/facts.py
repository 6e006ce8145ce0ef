"""Activity facts: date lists, bitmaps, metric arrays, co-activity. Also cleaning and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.columns import bits_text, classify_by_rules, referrer_rules
from strata.operators import activity as act
from strata.operators import clean, contracts
from strata.plans import inputs as i
from strata.session import shared_dir


def daily(spark, sf, key="user_id"):
    return act.daily_activity(i.web_events(spark, sf), key, "event_time")


def browser_events(spark, sf):
    known = clean.require_present(i.devices(spark, sf).select("device_id", "browser_type"), ["browser_type"])
    return clean.enrich(i.web_events(spark, sf).select("user_id", "device_id", "event_time"), known, "device_id")


def _text(df, array):
    """An array as text, nulls shown, so that engines can be compared."""
    return df.withColumn(array, F.array_join(F.transform(array, lambda x: x.cast("string")), ",", "null"))


# ---- cleaning -------------------------------------------------------------

def dedupe_by_key(spark, sf):
    out = clean.dedupe_by_key(i.game_details(spark, sf), ["player_id", "game_id"], i.GAME_ORDER)
    return out.select("player_id", "game_id", "l_linenumber", "l_partkey", "pts", "team_id", "team_name")


def dedupe_exact(spark, sf):
    return clean.dedupe_exact(i.web_events(spark, sf), ["url", "host", "user_id", "device_id"])


def classify_referrer(spark, sf):
    rules = referrer_rules(i.OWN_SITES)
    return i.web_events(spark, sf).select("event_id", classify_by_rules("referrer", rules).alias("source"))


def fill_unknown(spark, sf):
    return clean.fill_unknown(i.devices(spark, sf), ["browser_type", "device_type", "os_type"])


def enrich(spark, sf):
    out = clean.enrich(i.web_events(spark, sf), i.devices(spark, sf), "device_id", "inner",
                       {"browser_type": "browser_family", "os_type": "os_family"}, upper=["browser_family"])
    return out.select("event_id", "device_id", "browser_family", "os_family", "device_type", "referrer", "host", "url")


def enrich_left(spark, sf):
    known = clean.require_present(i.devices(spark, sf), ["browser_type"])
    out = clean.enrich(i.web_events(spark, sf), known, "device_id", "left", {"browser_type": "browser_family"})
    return out.select("event_id", "device_id", "browser_family")


def join_as_pair(spark, sf):
    events = i.web_events(spark, sf).select("event_id", "device_id", "url")
    out = clean.join_as_pair(events, i.devices(spark, sf), F.col("l.device_id") == F.col("r.device_id"))
    return out.select(F.col("left.event_id").alias("event_id"), F.col("left.url").alias("url"),
                      F.col("right.device_id").alias("device_id"), F.col("right.device_type").alias("device_type"))


def require_present(spark, sf):
    return clean.require_present(i.devices(spark, sf), ["browser_type", "os_type"])


def _broken(spark, sf):
    """Every performance twice, once without its team's name."""
    return i.game_details(spark, sf).unionByName(i.game_details(spark, sf).select(
        "game_id", "player_id", "l_linenumber", "l_partkey", "pts", "player_name", "team_id", F.lit(None).cast("string").alias("team_name")))


CONTRACT = {
    "keys": ["game_id", "player_id"], "not_null": ["team_name", "player_name"],
    "domains": {"l_linenumber": [1, 2, 3, 4, 5, 6], "team_id": list(range(25))}}


def check_contract(spark, sf):
    return contracts.check_contract(_broken(spark, sf), **CONTRACT)


def write_checked(spark, sf):
    return contracts.write_checked(_broken(spark, sf), shared_dir(spark, "checked"), **CONTRACT)


# ---- activity -------------------------------------------------------------

def daily_activity(spark, sf):
    return daily(spark, sf)


def cumulate_dates(spark, sf):
    facts = daily(spark, sf)
    return _text(act.cumulate_dates(act.date_lists(facts, "user_id", i.DS_BEFORE), facts, "user_id", i.DS), "dates_active")


def _device_dates(spark, sf):
    key = ["user_id", "browser_type"]
    facts = act.daily_activity(browser_events(spark, sf), key, "event_time")
    return act.cumulate_dates(act.date_lists(facts, key, i.DS_BEFORE), facts, key, i.DS)


def device_activity_datelist(spark, sf):
    return _text(_device_dates(spark, sf), "dates_active")


def device_activity_map(spark, sf):
    packed = act.pack_map(_device_dates(spark, sf), "user_id", "browser_type", "dates_active", "device_activity_datelist")
    entries = F.transform(F.map_entries("device_activity_datelist"), lambda e: F.concat_ws("=", e["key"], F.size(e["value"]).cast("string")))
    return packed.select("user_id", F.array_join(F.array_sort(entries), ",").alias("days_by_browser"))


def host_activity_datelist(spark, sf):
    facts = daily(spark, sf, "host")
    out = act.cumulate_dates(act.date_lists(facts, "host", i.DS_BEFORE), facts, "host", i.DS)
    return _text(out.withColumnRenamed("dates_active", "host_activity_datelist"), "host_activity_datelist")


def datelist_int(spark, sf):
    lists = act.date_lists(daily(spark, sf), "user_id", i.DS)
    out = act.datelist_int(lists, "dates_active", i.DS)
    return out.select("user_id", "datelist_int", bits_text("datelist_int").alias("bits"), "date")


def datelist_int_from_daily(spark, sf):
    return act.datelist_int_from_daily(daily(spark, sf), "user_id", i.DS)


def device_datelist_int(spark, sf):
    return act.datelist_int(_device_dates(spark, sf), "dates_active", i.DS).drop("dates_active")


def activity_flags(spark, sf):
    return act.activity_flags(act.datelist_int_from_daily(daily(spark, sf), "user_id", i.DS))


def _month(spark, sf):
    facts = daily(spark, sf)
    return act.monthly_hit_array(act.monthly_hit_backfill(facts, "user_id", i.DS_BEFORE), facts, "user_id", i.DS)


def monthly_hit_array(spark, sf):
    return _text(_month(spark, sf), "hit_array")


def _metric(facts, metric, ds):
    return act.monthly_hit_backfill(facts, "user_id", ds, 0).select(
        "user_id", "month_start", F.lit(metric).alias("metric_name"), F.col("hit_array").alias("metric_array"))


def _purchases(spark, sf):
    return act.daily_activity(i.web_events(spark, sf).where(F.col("url") == "/purchase"), "user_id", "event_time")


def _metrics(spark, sf):
    prev = _metric(daily(spark, sf), "site_hits", i.DS_BEFORE).unionByName(_metric(_purchases(spark, sf), "purchases", i.DS))
    return act.metric_array_upsert(prev, daily(spark, sf), "user_id", "site_hits", i.DS)


def metric_array_upsert(spark, sf):
    return _text(_metrics(spark, sf), "metric_array")


def sum_array_positions(spark, sf):
    return act.sum_array_positions(_month(spark, sf), "hit_array", "month_start", 3)


def sum_array_slots(spark, sf):
    return act.sum_array_positions(_metrics(spark, sf), "metric_array", ["metric_name", "month_start"])


def array_to_daily(spark, sf):
    return act.array_to_daily(_metrics(spark, sf), "metric_array", "month_start", ["user_id", "metric_name"])


def array_length_profile(spark, sf):
    return act.array_length_profile(act.date_lists(daily(spark, sf), "user_id", i.DS), "dates_active")


def host_activity_reduced(spark, sf):
    web = i.web_events(spark, sf)
    prev = act.host_activity_backfill(web, "host", "user_id", "event_time", i.DS_BEFORE)
    out = act.host_activity_reduced(prev, web, "host", "user_id", "event_time", i.DS)
    return _text(_text(out, "hit_array"), "unique_visitors")


def _pairs(spark, sf):
    return act.pair_activity(i.web_events(spark, sf), "user_id", "device_id", "host")


def pair_activity(spark, sf):
    return _text(_pairs(spark, sf), "host_array")


# Rows over which the list of one key is spread at most.
PARTS = 4


def coactivity_users(spark, sf):
    return _text(act.user_devices(_pairs(spark, sf), "user_id", "device_id", PARTS), "devices")


def coactivity_devices(spark, sf):
    return _text(act.device_users(_pairs(spark, sf), i.devices(spark, sf), "user_id", "device_id", "device_type", PARTS), "users")


# Values in a page of a list: no row holds more, whatever its key.
PAGE = 16


def coactivity_user_pages(spark, sf):
    return _text(act.user_device_pages(_pairs(spark, sf), "user_id", "device_id", PAGE), "devices")


def coactivity_device_pages(spark, sf):
    return _text(act.device_user_pages(_pairs(spark, sf), i.devices(spark, sf), "user_id", "device_id", "device_type", PAGE), "users")


QUERIES = {
    "dedupe_by_key": dedupe_by_key,
    "dedupe_exact": dedupe_exact,
    "classify_by_rules": classify_referrer,
    "fill_unknown": fill_unknown,
    "enrich": enrich,
    "enrich_left": enrich_left,
    "join_as_pair": join_as_pair,
    "require_present": require_present,
    "check_contract": check_contract,
    "write_checked": write_checked,
    "daily_activity": daily_activity,
    "cumulate_dates": cumulate_dates,
    "device_activity_datelist": device_activity_datelist,
    "device_activity_map": device_activity_map,
    "host_activity_datelist": host_activity_datelist,
    "datelist_int": datelist_int,
    "datelist_int_from_daily": datelist_int_from_daily,
    "device_datelist_int": device_datelist_int,
    "activity_flags": activity_flags,
    "monthly_hit_array": monthly_hit_array,
    "metric_array_upsert": metric_array_upsert,
    "sum_array_positions": sum_array_positions,
    "sum_array_slots": sum_array_slots,
    "array_to_daily": array_to_daily,
    "array_length_profile": array_length_profile,
    "host_activity_reduced": host_activity_reduced,
    "pair_activity": pair_activity,
    "coactivity_users": coactivity_users,
    "coactivity_devices": coactivity_devices,
    "coactivity_user_pages": coactivity_user_pages,
    "coactivity_device_pages": coactivity_device_pages,
}

_DAILY = """daily as (select {key}, cast(event_time as date) as day, count(*) as hits from {src} where {notnull} group by all)"""
DAILY = _DAILY.format(key="user_id", src="web", notnull="user_id is not null")
BY_BROWSER = """bw as (select w.user_id, d.browser_type, w.event_time from web w join devices d on d.device_id = w.device_id
  where d.browser_type is not null)"""
DAILY_BROWSER = _DAILY.format(key="user_id, browser_type", src="bw", notnull="user_id is not null")
DAILY_HOST = _DAILY.format(key="host", src="web", notnull="host is not null")
_DATES = "string_agg(cast(day as varchar), ',' order by day)"
_BITS = f"cast(sum(case when date '{i.DS}' - day between 0 and 31 then cast(pow(2, 31 - (date '{i.DS}' - day)) as bigint) else 0 end) as bigint)"
_RECENT = "cast(count(*) filter (where date '{ds}' - day between {a} and {b}) as integer)"
_CAL = f"cal as (select cast(unnest(generate_series(date '2024-01-01', date '{i.DS}', interval 1 day)) as date) as day)"
_METRICS = f"""pdaily as (select user_id, cast(event_time as date) as day, count(*) as hits from web where url = '/purchase' group by all),
slots as (
  select u.user_id, 'site_hits' as metric_name, c.day, coalesce(d.hits, 0) as value
  from (select distinct user_id from daily) u cross join cal c left join daily d on d.user_id = u.user_id and d.day = c.day
  union all
  select u.user_id, 'purchases', c.day, coalesce(d.hits, 0)
  from (select distinct user_id from pdaily) u cross join cal c left join pdaily d on d.user_id = u.user_id and d.day = c.day)"""

ORACLES = {
    "dedupe_by_key": f"with {i.GAME_DETAILS} select player_id, game_id, l_linenumber, l_partkey, pts, team_id, team_name from played",
    "dedupe_exact": f"with {i.WEB} select url, host, user_id, device_id from web group by all",
    "classify_by_rules": f"with {i.WEB} select event_id, {i.SQL_REFERRER} as source from web",
    "fill_unknown": f"""with {i.DEVICES} select device_id, coalesce(browser_type, 'unknown') as browser_type,
        coalesce(device_type, 'unknown') as device_type, coalesce(os_type, 'unknown') as os_type from devices""",
    "enrich": f"""with {i.WEB}, {i.DEVICES} select w.event_id, d.device_id, upper(d.browser_type) as browser_family, d.os_type as os_family,
        d.device_type, w.referrer, w.host, w.url from web w join devices d on d.device_id = w.device_id""",
    "enrich_left": f"""with {i.WEB}, {i.DEVICES} select w.event_id, w.device_id, d.browser_type as browser_family
        from web w left join devices d on d.device_id = w.device_id and d.browser_type is not null""",
    "join_as_pair": f"""with {i.WEB}, {i.DEVICES} select w.event_id, w.url, d.device_id, d.device_type
        from web w join devices d on d.device_id = w.device_id""",
    "require_present": f"with {i.DEVICES} select * from devices where browser_type is not null and os_type is not null",
    "check_contract": f"""with {i.GAME_DETAILS}, t as (
          select game_id, player_id, l_linenumber, team_name from gd union all select game_id, player_id, l_linenumber, null from gd)
        select 'unique' as rule, 'game_id,player_id' as columns, cast(sum(n - 1) as bigint) as violations
        from (select count(*) as n from t group by game_id, player_id)
        union all select 'not_null', 'team_name', count(*) from t where team_name is null
        union all select 'domain', 'l_linenumber', count(*) from t where l_linenumber not in (1, 2, 3, 4, 5, 6)""",
    "daily_activity": f"with {i.WEB}, {DAILY} select * from daily",
    "cumulate_dates": f"with {i.WEB}, {DAILY} select user_id, {_DATES} as dates_active, date '{i.DS}' as date from daily group by user_id",
    "device_activity_datelist": f"""with {i.WEB}, {i.DEVICES}, {BY_BROWSER}, {DAILY_BROWSER}
        select user_id, browser_type, {_DATES} as dates_active, date '{i.DS}' as date from daily group by user_id, browser_type""",
    "device_activity_map": f"""with {i.WEB}, {i.DEVICES}, {BY_BROWSER}, {DAILY_BROWSER},
        n as (select user_id, browser_type || '=' || count(*) as entry from daily group by user_id, browser_type)
        select user_id, string_agg(entry, ',' order by entry) as days_by_browser from n group by user_id""",
    "host_activity_datelist": f"""with {i.WEB}, {DAILY_HOST}
        select host, {_DATES} as host_activity_datelist, date '{i.DS}' as date from daily group by host""",
    "datelist_int": f"""with {i.WEB}, {DAILY}, b as (select user_id, {_BITS} as datelist_int from daily where day <= date '{i.DS}' group by user_id)
        select user_id, datelist_int, cast(cast(datelist_int as uinteger)::bit as varchar) as bits, date '{i.DS}' as date from b""",
    "datelist_int_from_daily": f"with {i.WEB}, {DAILY} select user_id, {_BITS} as datelist_int from daily where day <= date '{i.DS}' group by user_id",
    "device_datelist_int": f"""with {i.WEB}, {i.DEVICES}, {BY_BROWSER}, {DAILY_BROWSER}
        select user_id, browser_type, {_BITS} as datelist_int, date '{i.DS}' as date from daily where day <= date '{i.DS}' group by user_id, browser_type""",
    "activity_flags": f"""with {i.WEB}, {DAILY}, n as (select user_id, {_BITS} as datelist_int,
          {_RECENT.format(ds=i.DS, a=0, b=31)} as l32, {_RECENT.format(ds=i.DS, a=0, b=6)} as l7, {_RECENT.format(ds=i.DS, a=7, b=13)} as before
          from daily where day <= date '{i.DS}' group by user_id)
        select user_id, datelist_int, l32, l32 > 0 as monthly_active, l7, l7 > 0 as weekly_active, before > 0 as weekly_active_previous_week from n""",
    "monthly_hit_array": f"""with {i.WEB}, {DAILY}, {_CAL}
        select u.user_id, string_agg(coalesce(cast(d.hits as varchar), 'null'), ',' order by c.day) as hit_array,
               date '2024-01-01' as month_start, min(d.day) as first_seen, date '{i.DS}' as date
        from (select distinct user_id from daily) u cross join cal c left join daily d on d.user_id = u.user_id and d.day = c.day
        group by u.user_id""",
    "metric_array_upsert": f"""with {i.WEB}, {DAILY}, {_CAL}, {_METRICS}
        select user_id, date '2024-01-01' as month_start, metric_name, string_agg(value, ',' order by day) as metric_array
        from slots group by user_id, metric_name""",
    "sum_array_positions": f"""with {i.WEB}, {DAILY} select date '2024-01-01' as month_start,
          cast(coalesce(sum(hits) filter (where day = date '2024-01-01'), 0) as bigint) as slot_1,
          cast(coalesce(sum(hits) filter (where day = date '2024-01-02'), 0) as bigint) as slot_2,
          cast(coalesce(sum(hits) filter (where day = date '2024-01-03'), 0) as bigint) as slot_3 from daily""",
    "sum_array_slots": f"""with {i.WEB}, {DAILY}, {_CAL}, {_METRICS}
        select metric_name, date '2024-01-01' as month_start, cast(day - date '2024-01-01' + 1 as integer) as slot, cast(sum(value) as bigint) as total
        from slots group by metric_name, day""",
    "array_to_daily": f"with {i.WEB}, {DAILY}, {_CAL}, {_METRICS} select user_id, metric_name, day, value from slots",
    "array_length_profile": f"""with {i.WEB}, {DAILY}, n as (select cast(count(*) as integer) as length from daily group by user_id)
        select length, count(*) as rows from n group by length""",
    "host_activity_reduced": f"""with {i.WEB}, {_CAL}, d as (select host, cast(event_time as date) as day, count(*) as hits, count(distinct user_id) as users
          from web group by all)
        select h.host, date '2024-01-01' as month_start, string_agg(coalesce(d.hits, 0), ',' order by c.day) as hit_array,
               string_agg(coalesce(d.users, 0), ',' order by c.day) as unique_visitors, date '{i.DS}' as date
        from (select distinct host from web) h cross join cal c left join d on d.host = h.host and d.day = c.day group by h.host""",
    "pair_activity": f"""with {i.WEB}, h as (select user_id, device_id, host, count(*) as n from web group by all)
        select user_id, device_id, cast(sum(n) as bigint) as event_counts, string_agg(host, ',' order by host) as host_array from h group by 1, 2""",
    "coactivity_users": f"""with {i.WEB}, p as (select user_id, device_id, count(*) as n from web group by all),
        m as (select user_id, max(n) as total_hits from p group by user_id)
        select p.user_id, {i.sql_part("device_id", PARTS)} as part, string_agg(device_id, ',' order by device_id) as devices, any_value(m.total_hits) as total_hits
        from p join m on m.user_id is not distinct from p.user_id group by 1, 2""",
    "coactivity_devices": f"""with {i.WEB}, {i.DEVICES}, p as (select distinct user_id, device_id from web)
        select p.device_id, any_value(d.device_type) as device_type, {i.sql_part("user_id", PARTS)} as part, string_agg(user_id, ',' order by user_id) as users
        from p join devices d on d.device_id = p.device_id group by 1, 3""",
    "coactivity_user_pages": f"""with {i.WEB}, p as (select user_id, device_id, count(*) as n from web group by all),
        r as (select *, (row_number() over (partition by user_id order by device_id) - 1) // {PAGE} as page, max(n) over (partition by user_id) as most from p)
        select user_id, page, string_agg(device_id, ',' order by device_id) as devices, any_value(most) as total_hits from r group by 1, 2""",
    "coactivity_device_pages": f"""with {i.WEB}, {i.DEVICES}, p as (select distinct user_id, device_id from web),
        r as (select *, (row_number() over (partition by device_id order by user_id) - 1) // {PAGE} as page from p)
        select r.device_id, any_value(d.device_type) as device_type, page, string_agg(user_id, ',' order by user_id) as users
        from r join devices d on d.device_id = r.device_id group by 1, 3""",
}
ORACLES["write_checked"] = ORACLES["check_contract"]

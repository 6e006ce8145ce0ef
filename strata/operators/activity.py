"""Fact modelling of activity: date lists, bitmaps, metric arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import active_days, datelist_bits, join_arrays, keep_tail, names
from strata.operators.clean import upsert_by_key
from strata.operators.guards import maybe_broadcast, present, require
from strata.operators.skew import list_pages, list_parts


def on_day(events: DataFrame, ts: str, ds: str) -> DataFrame:
    """Events of one day, as a range on the raw timestamp so that the scan can skip row groups."""
    start = F.lit(ds).cast("date").cast(events.schema[ts].dataType)
    return events.where((F.col(ts) >= start) & (F.col(ts) < F.date_add(F.lit(ds).cast("date"), 1).cast(events.schema[ts].dataType)))


def daily_activity(events: DataFrame, key: str | Sequence[str], ts: str, ds: str | None = None) -> DataFrame:
    """Hits per key and day, rows without a key removed: key, ``day``, ``hits``."""
    keys = names(key)
    rows = events if ds is None else on_day(events, ts, ds)
    return present(rows, keys).groupBy(*keys, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("hits"))


def cumulate_dates(
    prev: DataFrame | None, daily: DataFrame, key: str | Sequence[str], ds: str, keep_last: int | None = None
) -> DataFrame:
    """Active-date arrays as of ``ds`` from those of the day before: key, ``dates_active``, ``date``."""
    keys = names(key)
    date = F.to_date(F.lit(ds))
    today = daily.where(F.col("day") == date).select(*keys, F.array(date).alias("_today")).distinct()
    if prev is None:
        return today.select(*keys, F.col("_today").alias("dates_active"), date.alias("date"))
    prev = require(prev, F.col("date") == F.date_sub(date, 1), f"the previous date lists must be of the day before {ds}")
    old = prev.select(*keys, F.col("dates_active").alias("_old"))
    return old.join(today, keys, "full").select(
        *keys, keep_tail(join_arrays(F.col("_old"), F.col("_today")), keep_last).alias("dates_active"), date.alias("date"))


def date_lists(daily: DataFrame, key: str | Sequence[str], ds: str) -> DataFrame:
    """Active-date arrays as of ``ds`` straight from daily activity, in one aggregation.

    Equals ``cumulate_dates`` run day by day; a key has at most one row per day.
    """
    end = F.to_date(F.lit(ds))
    return daily.where(F.col("day") <= end).groupBy(*names(key)).agg(
        F.sort_array(F.collect_set("day")).alias("dates_active")).withColumn("date", end)


def pack_map(df: DataFrame, key: str | Sequence[str], entry: str, value: str, name: str) -> DataFrame:
    """Fold rows per (key, entry) into one map column entry -> value per key."""
    entries = F.sort_array(F.collect_list(F.struct(F.col(entry), F.col(value))))
    return df.groupBy(*names(key)).agg(F.map_from_entries(entries).alias(name))


def datelist_int(df: DataFrame, dates: str, as_of: str | Column, days: int = 32, name: str = "datelist_int") -> DataFrame:
    """Add the activity bitmap of the last ``days`` days; the top bit is the as-of day."""
    return df.withColumn(name, datelist_bits(dates, as_of, days))


def datelist_int_from_daily(daily: DataFrame, key: str | Sequence[str], ds: str, days: int = 32) -> DataFrame:
    """The same bitmap from daily activity without building the arrays: one hash aggregate of long values.

    As with the arrays, keys first seen after ``ds`` have no row.
    """
    end = F.to_date(F.lit(ds))
    ago = F.datediff(end, F.col("day"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(days - 1) - ago)
    mask = F.when(ago < days, bit).otherwise(F.lit(0).cast("bigint"))
    return daily.where(F.col("day") <= end).groupBy(*names(key)).agg(F.bit_or(mask).alias("datelist_int"))


def activity_flags(df: DataFrame, bits: str = "datelist_int") -> DataFrame:
    """Active-day counts and flags read from a 32-day bitmap."""
    return df.withColumns({
        "l32": active_days(bits),
        "monthly_active": active_days(bits) > 0,
        "l7": active_days(bits, 0, 7),
        "weekly_active": active_days(bits, 0, 7) > 0,
        "weekly_active_previous_week": active_days(bits, 7, 7) > 0,
    })


def _slots(old: Column, today: Column, day_of_month: Column, fill: int | None) -> Column:
    """Append today's value to a month array, padding an entity that joins late."""
    blank = F.lit(fill).cast("bigint")
    padding = F.array_repeat(blank, day_of_month - 1)
    return F.concat(F.coalesce(old, padding), F.array(F.coalesce(today, blank)))


def monthly_hit_array(
    prev: DataFrame | None, daily: DataFrame, key: str | Sequence[str], ds: str, fill: int | None = None
) -> DataFrame:
    """One slot per day of the month up to ``ds``: key, ``hit_array``, ``month_start``, ``first_seen``, ``date``.

    A day without hits is ``fill`` (null by default). A new month starts empty, with
    only the keys seen in it; ``first_seen`` is the first day of the month with hits.
    """
    keys = names(key)
    date = F.to_date(F.lit(ds))
    month = F.trunc(date, "month")
    today = daily.where(F.col("day") == date).groupBy(*keys).agg(F.sum("hits").alias("_hits"))
    if prev is None:
        rows = today.select(*keys, "_hits", F.lit(None).cast("array<bigint>").alias("_old"), F.lit(None).cast("date").alias("_first"))
    else:
        prev = require(prev, F.col("date") == F.date_sub(date, 1), f"the previous arrays must be of the day before {ds}")
        old = prev.where(F.col("month_start") == month).select(
            *keys, F.col("hit_array").alias("_old"), F.col("first_seen").alias("_first"))
        rows = old.join(today, keys, "full")
    return rows.select(
        *keys,
        _slots(F.col("_old"), F.col("_hits"), F.dayofmonth(date), fill).alias("hit_array"),
        month.alias("month_start"),
        F.coalesce("_first", date).alias("first_seen"),
        date.alias("date"),
    )


def _month_array(entries: Column, day: Column, fill: int | None) -> Column:
    """Slots 1..day from an array of (day of month, value)."""
    by_day = F.map_from_entries(entries)
    return F.transform(F.sequence(F.lit(1), day), lambda d: F.coalesce(F.try_element_at(by_day, d), F.lit(fill).cast("bigint")))


def monthly_hit_backfill(daily: DataFrame, key: str | Sequence[str], ds: str, fill: int | None = None) -> DataFrame:
    """The arrays of ``ds`` straight from daily activity; equals ``monthly_hit_array`` run day by day."""
    keys = names(key)
    date = F.to_date(F.lit(ds))
    month = F.trunc(date, "month")
    per_day = daily.where(F.col("day").between(month, date)).groupBy(*keys, "day").agg(F.sum("hits").alias("hits"))
    entry = F.struct(F.dayofmonth("day"), F.col("hits"))
    rows = per_day.groupBy(*keys).agg(F.collect_list(entry).alias("_days"), F.min("day").alias("first_seen"))
    return rows.select(
        *keys, _month_array(F.col("_days"), F.dayofmonth(date), fill).alias("hit_array"),
        month.alias("month_start"), "first_seen", date.alias("date"))


def metric_array_upsert(
    prev: DataFrame | None, daily: DataFrame, key: str | Sequence[str], metric: str, ds: str
) -> DataFrame:
    """Month arrays of a named metric with 0 for days without hits, upserted on (key, month, metric).

    Layout: key, ``month_start``, ``metric_name``, ``metric_array``. Rows of other
    months and metrics stay as they are. Each run appends one slot, so a day must
    be loaded once: an array of another length stops the query.
    """
    keys = names(key)
    date = F.to_date(F.lit(ds))
    month = F.trunc(date, "month")
    today = daily.where(F.col("day") == date).groupBy(*keys).agg(F.sum("hits").alias("_hits"))
    if prev is None:
        rows = today.withColumn("_old", F.lit(None).cast("array<bigint>"))
    else:
        mine = prev.where((F.col("month_start") == month) & (F.col("metric_name") == metric))
        mine = require(mine, F.size("metric_array") == F.dayofmonth(date) - 1, f"the arrays do not end on the day before {ds}")
        rows = mine.select(*keys, F.col("metric_array").alias("_old")).join(today, keys, "full")
    new = rows.select(
        *keys, month.alias("month_start"), F.lit(metric).alias("metric_name"),
        _slots(F.col("_old"), F.col("_hits"), F.dayofmonth(date), 0).alias("metric_array"))
    return new if prev is None else upsert_by_key(prev, new, [*keys, "month_start", "metric_name"])


def sum_array_positions(df: DataFrame, array: str, group: str | Sequence[str], n: int | None = None) -> DataFrame:
    """Totals per array slot. With ``n``: columns ``slot_1`` .. ``slot_n``, missing slots counting 0.

    Without ``n``: rows (group, ``slot``, ``total``) for arrays of any length.
    """
    groups = names(group)
    if n is not None:
        return df.groupBy(*groups).agg(*[
            F.sum(F.coalesce(F.get(F.col(array), F.lit(i)), F.lit(0))).alias(f"slot_{i + 1}") for i in range(n)])
    slots = df.select(*groups, F.posexplode(array).alias("_pos", "_value"))
    return slots.groupBy(*groups, (F.col("_pos") + 1).alias("slot")).agg(F.sum("_value").alias("total"))


def array_to_daily(df: DataFrame, array: str, month_start: str, keep: str | Sequence[str] = ()) -> DataFrame:
    """One row per array slot: kept columns, ``day`` (month start + position), ``value``."""
    rows = df.select(*names(keep), month_start, F.posexplode(array).alias("_pos", "value"))
    return rows.select(*names(keep), F.date_add(month_start, F.col("_pos")).alias("day"), "value")


def array_length_profile(df: DataFrame, array: str) -> DataFrame:
    """How many rows hold an array of each length."""
    return df.groupBy(F.size(array).alias("length")).agg(F.count(F.lit(1)).alias("rows"))


def host_activity_reduced(
    prev: DataFrame | None, events: DataFrame, key: str | Sequence[str], user: str, ts: str, ds: str
) -> DataFrame:
    """Per month and host: daily hits and daily unique visitors, extended by the day ``ds``.

    Layout: key, ``month_start``, ``hit_array``, ``unique_visitors``, ``date``; a
    day without hits is 0 in both arrays. The distinct count is aggregated by
    (host, user) before it is aggregated by host, so a hot host is spread by user.
    """
    keys = names(key)
    date = F.to_date(F.lit(ds))
    month = F.trunc(date, "month")
    today = present(on_day(events, ts, ds), keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_hits"), F.count_distinct(user).alias("_users"))
    if prev is None:
        empty = F.lit(None).cast("array<bigint>")
        rows = today.select(*keys, "_hits", "_users", empty.alias("_old_hits"), empty.alias("_old_users"))
    else:
        prev = require(prev, F.col("date") == F.date_sub(date, 1), f"the previous arrays must be of the day before {ds}")
        old = prev.where(F.col("month_start") == month).select(
            *keys, F.col("hit_array").alias("_old_hits"), F.col("unique_visitors").alias("_old_users"))
        rows = old.join(today, keys, "full")
    day = F.dayofmonth(date)
    return rows.select(
        *keys, month.alias("month_start"),
        _slots(F.col("_old_hits"), F.col("_hits"), day, 0).alias("hit_array"),
        _slots(F.col("_old_users"), F.col("_users"), day, 0).alias("unique_visitors"),
        date.alias("date"))


def host_activity_backfill(events: DataFrame, key: str | Sequence[str], user: str, ts: str, ds: str) -> DataFrame:
    """``host_activity_reduced`` of ``ds`` in one pass over the month's events."""
    keys = names(key)
    date = F.to_date(F.lit(ds))
    month = F.trunc(date, "month")
    kind = events.schema[ts].dataType
    rows = present(events.where((F.col(ts) >= month.cast(kind)) & (F.col(ts) < F.date_add(date, 1).cast(kind))), keys)
    daily = rows.groupBy(*keys, F.dayofmonth(ts).alias("_day")).agg(
        F.count(F.lit(1)).alias("_hits"), F.count_distinct(user).alias("_users"))
    packed = daily.groupBy(*keys).agg(
        F.collect_list(F.struct("_day", "_hits")).alias("_h"), F.collect_list(F.struct("_day", "_users")).alias("_u"))
    return packed.select(
        *keys, month.alias("month_start"),
        _month_array(F.col("_h"), F.dayofmonth(date), 0).alias("hit_array"),
        _month_array(F.col("_u"), F.dayofmonth(date), 0).alias("unique_visitors"),
        date.alias("date"))


def pair_activity(events: DataFrame, user: str, device: str, host: str) -> DataFrame:
    """The shared aggregate: events and distinct hosts per (user, device)."""
    return present(events, [user, device]).groupBy(user, device).agg(
        F.count(F.lit(1)).alias("event_counts"), F.sort_array(F.collect_set(host)).alias("host_array"))


def user_devices(pairs: DataFrame, user: str, device: str, parts: int = 1) -> DataFrame:
    """Per user: hits on the busiest device and the devices used, in ``parts`` rows at most (``list_parts``)."""
    rows = pairs.select(user, device, F.col("event_counts").alias("total_hits"))
    return list_parts(rows, user, device, parts, ["total_hits"]).withColumnRenamed("values", "devices")


def device_users(pairs: DataFrame, devices: DataFrame, user: str, device: str, label: str, parts: int = 1) -> DataFrame:
    """Per known device: its label and the users seen on it, in ``parts`` rows at most (``list_parts``)."""
    known = pairs.select(device, user).join(devices.select(device), device, "left_semi")
    lists = list_parts(known, device, user, parts).withColumnRenamed("values", "users")
    return lists.join(maybe_broadcast(devices.select(device, label)), device)


def user_device_pages(pairs: DataFrame, user: str, device: str, size: int) -> DataFrame:
    """Per user: hits on the busiest device and the devices used, in pages of ``size`` devices (``list_pages``)."""
    rows = pairs.select(user, device, F.col("event_counts").alias("total_hits"))
    return list_pages(rows, user, device, size, ["total_hits"]).withColumnRenamed("values", "devices")


def device_user_pages(pairs: DataFrame, devices: DataFrame, user: str, device: str, label: str, size: int) -> DataFrame:
    """Per known device: its label and the users seen on it, in pages of ``size`` users (``list_pages``)."""
    known = pairs.select(device, user).join(maybe_broadcast(devices.select(device)), device, "left_semi")
    lists = list_pages(known, device, user, size).withColumnRenamed("values", "users")
    return lists.join(maybe_broadcast(devices.select(device, label)), device)

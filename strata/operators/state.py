"""State machines over activity: entity state changes, growth accounting, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import join_arrays, keep_tail, names
from strata.operators.guards import require

# The daily states that count as active in a retention curve.
ACTIVE_STATES = ["Retained", "Resurrected", "New"]


def state_change(snapshots: DataFrame, key: str | Sequence[str], period: str, active: str) -> DataFrame:
    """State of each entity and period against its previous snapshot row.

    A key holds one row per period, so the window group is bounded by the periods.
    """
    keys = names(key)
    before = F.lag(active).over(Window.partitionBy(*keys).orderBy(period))
    now = F.col(active)
    # The five state names.
    state = (
        F.when(before.isNull() & now, "New")
        .when(before & now, "Continued Playing")
        .when(before & ~now, "Retired")
        .when(~before & now, "Returned from Retirement")
        .when(~before & ~now, "Stayed Retired")
    )
    return snapshots.select(*keys, period, active, state.alias("state"))


def _states(known: Column, last: Column, active: Column, day: Column) -> tuple[Column, Column]:
    """Daily and weekly state; ``last`` is the last active day before ``day``. First match wins."""
    daily = (
        F.when(~known, "New")
        .when(active & (last == F.date_sub(day, 1)), "Retained")
        .when(active & (last < F.date_sub(day, 1)), "Resurrected")
        .when(~active & (last == F.date_sub(day, 1)), "Churned")
        .otherwise("Stale")
    )
    latest = F.when(active, day).otherwise(last)
    weekly = (
        F.when(~known, "New")
        .when(active & (last < F.date_sub(day, 7)), "Resurrected")
        .when(~active & (last == F.date_sub(day, 8)), "Churned")
        .when(F.date_add(latest, 7) >= F.date_sub(day, 1), "Retained")
        .otherwise("Stale")
    )
    return daily, weekly


def growth_accounting(
    prev: DataFrame | None, daily: DataFrame, key: str | Sequence[str], ds: str, day: str = "day", keep_last: int | None = None
) -> DataFrame:
    """Growth-accounting rows of day ``ds`` from those of the day before and the day's activity.

    ``daily`` holds one row per key and day (``daily_activity``). ``prev`` must be
    the day before; the query fails otherwise. ``keep_last`` bounds the dates kept per key.
    """
    keys = names(key)
    date = F.to_date(F.lit(ds))
    today = daily.where(F.col(day) == date).select(*keys, F.lit(True).alias("_active")).distinct()
    if prev is None:
        rows = today.select(*keys, "_active", F.lit(None).cast("date").alias("_first"),
                            F.lit(None).cast("date").alias("_last"), F.lit(None).cast("array<date>").alias("_dates"))
    else:
        prev = require(prev, F.col("date") == F.date_sub(date, 1), f"previous rows must be of the day before {ds}")
        old = prev.select(*keys, F.col("first_active_date").alias("_first"), F.col("last_active_date").alias("_last"),
                          F.col("dates_active").alias("_dates"))
        rows = old.join(today, keys, "full")
    active = F.col("_active").isNotNull()
    state, weekly = _states(F.col("_last").isNotNull(), F.col("_last"), active, date)
    return rows.select(
        *keys,
        F.coalesce("_first", date).alias("first_active_date"),
        F.when(active, date).otherwise(F.col("_last")).alias("last_active_date"),
        state.alias("daily_active_state"),
        weekly.alias("weekly_active_state"),
        keep_tail(join_arrays(F.col("_dates"), F.when(active, F.array(date))), keep_last).alias("dates_active"),
        date.alias("date"),
    )


def accounting_states(daily: DataFrame, key: str | Sequence[str], last: str, day: str = "day") -> DataFrame:
    """Growth-accounting rows of all days up to ``last``, without the lists of dates.

    ``daily`` holds one row per key and day. One shuffle: each active day learns the first day and those before and after it
    by a window, yields the days up to the next one, and states are row arithmetic.
    """
    keys = names(key)
    end = F.to_date(F.lit(last))
    days = daily.where(F.col(day) <= end).select(*keys, F.col(day).alias("_now"))
    order = Window.partitionBy(*keys).orderBy("_now")
    each = days.withColumns({
        "first_active_date": F.min("_now").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_before": F.lag("_now").over(order), "_next": F.lead("_now").over(order)})
    spans = each.withColumn("date", F.explode(F.sequence("_now", F.coalesce(F.date_sub("_next", 1), end))))
    active = F.col("date") == F.col("_now")
    before = F.when(active, F.col("_before")).otherwise(F.col("_now"))
    state, weekly = _states(before.isNotNull(), before, active, F.col("date"))
    return spans.select(
        *keys, "first_active_date", F.col("_now").alias("last_active_date"), state.alias("daily_active_state"),
        weekly.alias("weekly_active_state"), "date")


def growth_accounting_backfill(
    daily: DataFrame, key: str | Sequence[str], last: str, day: str = "day", keep_last: int | None = None
) -> DataFrame:
    """Growth-accounting rows of all days up to ``last``, each with its dates so far, in one pass and one shuffle.

    A key's active days become one sorted array (at most one entry per day); each
    entry then yields the days up to the next one, and states are row arithmetic.
    The dates so far grow with the days; ``keep_last`` keeps the latest of them, and
    ``accounting_states`` does without.
    """
    keys = names(key)
    end = F.to_date(F.lit(last))
    dates = daily.where(F.col(day) <= end).groupBy(*keys).agg(F.sort_array(F.collect_set(day)).alias("_dates"))
    each = dates.select(*keys, "_dates", F.posexplode("_dates").alias("_pos", "_now"))
    spans = each.select(
        *keys, "_dates", "_pos", "_now",
        F.explode(F.sequence("_now", F.coalesce(F.date_sub(F.get(F.col("_dates"), F.col("_pos") + 1), 1), end))).alias("date"))
    active = F.col("date") == F.col("_now")
    before = F.when(active, F.get(F.col("_dates"), F.col("_pos") - 1)).otherwise(F.col("_now"))
    state, weekly = _states(before.isNotNull(), before, active, F.col("date"))
    return spans.select(
        *keys,
        F.get(F.col("_dates"), F.lit(0)).alias("first_active_date"),
        F.col("_now").alias("last_active_date"),
        state.alias("daily_active_state"),
        weekly.alias("weekly_active_state"),
        keep_tail(F.slice(F.col("_dates"), F.lit(1), F.col("_pos") + 1), keep_last).alias("dates_active"),
        "date",
    )


def retention_curve(accounting: DataFrame, cohort: str | Column | None = None) -> DataFrame:
    """Share of active entities by days since first activity, over all rows of that age."""
    groups = [F.datediff("date", "first_active_date").alias("days_since_first_active")]
    if cohort is not None:
        groups.insert(0, F.col(cohort) if isinstance(cohort, str) else cohort)
    active = F.count_if(F.col("daily_active_state").isin(*ACTIVE_STATES))
    return accounting.groupBy(*groups).agg(
        (active / F.count(F.lit(1))).alias("pct_active"), F.count(F.lit(1)).alias("entities"))

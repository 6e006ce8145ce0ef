"""Cumulative entity snapshots: one row per entity and period with its whole history.

Snapshot layout: key columns, static columns, ``history`` (array of records),
``entity_class``, ``is_active``, ``periods_since_active`` and the period column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import band, join_arrays, keep_tail, names
from strata.operators.guards import require
from strata.operators.skew import blocked_totals, list_pages, list_parts


def _advance(prev, today, keys, static, period, run_period, keep_last):
    """Full join of yesterday's snapshot with today's records (both unique per key)."""
    inactive = today.select(
        *keys, *static, keep_tail(F.col("_records"), keep_last).alias("history"), F.col("_class").alias("entity_class"),
        F.lit(True).alias("is_active"), F.lit(0).alias("periods_since_active"), F.lit(run_period).alias(period),
    )
    if prev is None:
        return inactive
    prev = require(prev, F.col(period) == F.lit(run_period - 1), f"the previous snapshot must be of {period} {run_period - 1}")
    old = prev.select(*keys, *[F.col(c).alias("_p_" + c) for c in [*static, "history", "entity_class", "periods_since_active"]])
    new = today.select(*keys, *[F.col(c).alias("_t_" + c) for c in static], "_records", "_class")
    present = F.col("_records").isNotNull()
    return old.join(new, keys, "full").select(
        *keys,
        *[F.coalesce("_p_" + c, "_t_" + c).alias(c) for c in static],
        keep_tail(join_arrays(F.col("_p_history"), F.col("_records")), keep_last).alias("history"),
        F.when(present, F.col("_class")).otherwise(F.col("_p_entity_class")).alias("entity_class"),
        present.alias("is_active"),
        F.when(present, F.lit(0)).otherwise(F.col("_p_periods_since_active") + 1).alias("periods_since_active"),
        F.lit(run_period).alias(period),
    )


def cumulate_entity(
    prev: DataFrame | None,
    facts: DataFrame,
    key: str | Sequence[str],
    period: str,
    run_period: int,
    record: Sequence[str],
    classify: Column,
    static: Sequence[str] = (),
    keep_last: int | None = None,
) -> DataFrame:
    """Snapshot of ``run_period`` from the snapshot before it and that period's facts.

    ``facts`` holds one row per key and period. Entities without a fact keep
    their history and class and become one period older. ``prev`` is None for the
    first period; ``keep_last`` bounds the history array.
    """
    keys = names(key)
    today = facts.where(F.col(period) == F.lit(run_period)).select(
        *keys, *static, F.array(F.struct(*record)).alias("_records"), classify.alias("_class"))
    return _advance(prev, today, keys, list(static), period, run_period, keep_last)


def cumulate_grouped_entity(
    prev: DataFrame | None,
    facts: DataFrame,
    key: str | Sequence[str],
    period: str,
    run_period: int,
    record: Sequence[str],
    measure: str,
    bands: Sequence[tuple[float, str]],
    default: str,
    parts: int = 1,
    keep_last: int | None = None,
) -> DataFrame:
    """As ``cumulate_entity`` with many fact rows per key and period.

    All of a period's records join the history, sorted by ``record`` (put the id
    first); the class is the band of the mean measure of the latest active period.
    The snapshot has a ``part`` column: the records of a key are spread by their id over ``parts``
    rows at most (``list_parts``; its state repeated), whatever their number, so that neither a task
    nor a row has to take a whole hot key. Use one number of parts for all
    periods. ``keep_last`` bounds the records kept in each part.
    """
    keys = names(key)
    rows = facts.where(F.col(period) == F.lit(run_period))
    classes = rows.groupBy(*keys).agg(band(F.avg(measure), bands, default).alias("_class"))
    each = rows.select(*keys, F.struct(*record).alias("_record"), F.col(record[0]).alias("_id"))
    lists = list_parts(each, keys, "_record", parts, split_by="_id")
    lists = lists.select(*keys, "part", keep_tail(F.col("values"), keep_last).alias("_records"))
    if prev is None:
        return lists.join(classes, keys).select(
            *keys, "part", F.col("_records").alias("history"), F.col("_class").alias("entity_class"),
            F.lit(True).alias("is_active"), F.lit(0).alias("periods_since_active"), F.lit(run_period).alias(period))
    prev = require(prev, F.col(period) == F.lit(run_period - 1), f"the previous snapshot must be of {period} {run_period - 1}")
    present = F.col("_class").isNotNull()
    return prev.drop(period, "is_active").join(lists, [*keys, "part"], "full").join(classes, keys, "left").select(
        *keys, "part", keep_tail(join_arrays(F.col("history"), F.col("_records")), keep_last).alias("history"),
        F.coalesce("_class", "entity_class").alias("entity_class"),
        present.alias("is_active"),
        F.when(present, F.lit(0)).otherwise(F.col("periods_since_active") + 1).alias("periods_since_active"),
        F.lit(run_period).alias(period))


def grouped_entity_states(
    facts: DataFrame,
    key: str | Sequence[str],
    period: str,
    last: int,
    measure: str,
    bands: Sequence[tuple[float, str]],
    default: str,
    emit_from: int | None = None,
) -> DataFrame:
    """Class, activity and number of records of every entity and period, without the records.

    Facts are averaged per key and period before the shuffle, so an entity with
    very many facts costs no more than any other.
    """
    keys = names(key)
    per_period = facts.where(F.col(period) <= F.lit(last)).groupBy(*keys, period).agg(
        F.count(F.lit(1)).alias("_count"), band(F.avg(measure), bands, default).alias("_class"))
    out = backfill_entity(per_period, keys, period, last, ["_count"], F.col("_class"), emit_from=emit_from)
    total = F.aggregate("history", F.lit(0).cast("bigint"), lambda n, x: n + x["_count"])
    return out.withColumn("records", total).drop("history")


def backfill_grouped_entity(
    facts: DataFrame,
    key: str | Sequence[str],
    period: str,
    last: int,
    record: Sequence[str],
    measure: str,
    bands: Sequence[tuple[float, str]],
    default: str,
    parts: int = 1,
    keep_last: int | None = None,
) -> DataFrame:
    """The snapshot of ``last`` in one pass; equals ``cumulate_grouped_entity`` run up to it."""
    keys = names(key)
    state = grouped_entity_states(facts, keys, period, last, measure, bands, default, emit_from=last).drop("records")
    rows = facts.where(F.col(period) <= F.lit(last)).select(
        *keys, F.struct(period, F.struct(*record).alias("_r")).alias("_record"), F.col(record[0]).alias("_id"))
    lists = list_parts(rows, keys, "_record", parts, split_by="_id").select(
        *keys, "part", keep_tail(F.col("values")["_r"], keep_last).alias("history"))
    return lists.join(state, keys).select(
        *keys, "part", "history", "entity_class", "is_active", "periods_since_active", period)


def cumulate_grouped_state(
    prev: DataFrame | None,
    facts: DataFrame,
    key: str | Sequence[str],
    period: str,
    run_period: int,
    measure: str,
    bands: Sequence[tuple[float, str]],
    default: str,
) -> DataFrame:
    """State of every entity with many facts a period: class, activity, and ``records``, the number of its facts so far.

    The row a key of ``grouped_entity_states`` for one period, from the state before it and the period's facts. ``prev`` is None for the first period.
    """
    keys = names(key)
    today = facts.where(F.col(period) == F.lit(run_period)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_new"), band(F.avg(measure), bands, default).alias("_class"))
    if prev is None:
        return today.select(*keys, F.col("_class").alias("entity_class"), F.lit(True).alias("is_active"), F.lit(0).alias("periods_since_active"),
                            F.lit(run_period).alias(period), F.col("_new").alias("records"))
    prev = require(prev, F.col(period) == F.lit(run_period - 1), f"the previous state must be of {period} {run_period - 1}")
    present = F.col("_class").isNotNull()
    return prev.drop(period, "is_active").join(today, keys, "full").select(
        *keys, F.coalesce("_class", "entity_class").alias("entity_class"), present.alias("is_active"),
        F.when(present, F.lit(0)).otherwise(F.col("periods_since_active") + 1).alias("periods_since_active"),
        F.lit(run_period).alias(period), (F.coalesce("records", F.lit(0)) + F.coalesce("_new", F.lit(0))).alias("records"))


def cumulate_grouped_pages(
    prev: DataFrame | None,
    prev_state: DataFrame | None,
    facts: DataFrame,
    key: str | Sequence[str],
    period: str,
    run_period: int,
    record: Sequence[str],
    size: int,
) -> DataFrame:
    """All records of every entity in pages of ``size``, in the order of their periods and of ``record``: keys, ``page``, ``history``.

    The new records of a key continue where its list ended, at the number of ``records`` in the state of the period
    before (``cumulate_grouped_state``): they fill its last page and open new ones. Full pages and keys without facts pass
    through, so a period costs its facts and one page for each key that has any, not the histories. A row is
    never larger than a page; the records of a hot key are ranked in blocks and grouped by page.
    """
    keys = names(key)
    rows = facts.where(F.col(period) == F.lit(run_period)).select(*keys, F.struct(*record).alias("_record"), F.lit(1).alias("_one"))
    ranked = blocked_totals(rows, keys, "_record", "_record", {"_place": "_one"})
    if prev is None:
        start = F.lit(0)
    else:
        ranked = ranked.join(prev_state.select(*keys, "records"), keys, "left")
        start = F.coalesce("records", F.lit(0))
    # exchanged by page, so that a hot key may be split in the join before
    paged = ranked.select(*keys, F.floor((start + F.col("_place") - 1) / size).alias("page"), "_record")
    new = paged.repartition(*keys, "page").groupBy(*keys, "page").agg(F.sort_array(F.collect_list("_record")).alias("_records"))
    if prev is None:
        return new.withColumnRenamed("_records", "history")
    last = F.size("history") < size
    met = prev.where(last).join(new, [*keys, "page"], "full").select(*keys, "page", join_arrays(F.col("history"), F.col("_records")).alias("history"))
    return prev.where(~last).unionByName(met)


def backfill_grouped_pages(facts: DataFrame, key: str | Sequence[str], period: str, last: int, record: Sequence[str], size: int) -> DataFrame:
    """The pages of ``last`` in one pass; equals ``cumulate_grouped_pages`` run up to it."""
    keys = names(key)
    rows = facts.where(F.col(period) <= F.lit(last)).select(*keys, F.struct(period, F.struct(*record).alias("_r")).alias("_record"))
    return list_pages(rows, keys, "_record", size).select(*keys, "page", F.col("values")["_r"].alias("history"))


def backfill_entity(
    facts: DataFrame,
    key: str | Sequence[str],
    period: str,
    last: int,
    record: Sequence[str],
    classify: Column,
    static: Sequence[str] = (),
    first: int | None = None,
    static_mode: str = "first",
    keep_last: int | None = None,
    emit_from: int | None = None,
) -> DataFrame:
    """Snapshots of every entity for all periods up to ``last`` in one pass.

    Equals running ``cumulate_entity`` period by period. ``facts`` holds one row
    per key and period, so a key's group is never larger than the number of
    periods; the facts are shuffled once. Each fact then yields the periods from
    its own up to the one before the next fact. ``emit_from`` leaves out earlier
    snapshots (``emit_from=last`` gives the latest only).
    """
    keys, static = names(key), list(static)
    rows = facts.where(F.col(period) <= F.lit(last))
    if first is not None:
        rows = rows.where(F.col(period) >= F.lit(first))
    item = F.struct(
        F.col(period).alias("_period"), F.struct(*record).alias("_record"), classify.alias("_class"),
        *[F.col(c).alias("_s_" + c) for c in static],
    )
    grouped = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_all"))
    grouped = require(grouped, F.size("_all") == F.size(F.array_distinct(F.col("_all")["_period"])),
                      f"more than one fact per key and {period}")
    each = grouped.select(*keys, "_all", F.posexplode("_all").alias("_pos", "_now"))
    following = F.get(F.col("_all"), F.col("_pos") + 1)["_period"]
    upto = F.slice(F.col("_all"), F.lit(1), F.col("_pos") + 1)

    def known(name: str) -> Column:
        if static_mode == "max":
            return F.array_max(F.col("_all")["_s_" + name])
        return F.get(F.filter(upto["_s_" + name], lambda v: v.isNotNull()), F.lit(0))

    spans = each.select(
        *keys,
        *[known(c).alias(c) for c in static],
        keep_tail(upto["_record"], keep_last).alias("history"),
        F.col("_now._class").alias("entity_class"),
        F.col("_now._period").alias("_from"),
        F.coalesce(following - 1, F.lit(last)).alias("_to"),
    )
    start = F.col("_from")
    if emit_from is not None:
        spans = spans.where(F.col("_to") >= emit_from)
        start = F.greatest("_from", F.lit(emit_from))
    return spans.withColumn(period, F.explode(F.sequence(start, "_to"))).select(
        *keys, *static, "history", "entity_class",
        (F.col(period) == F.col("_from")).alias("is_active"),
        (F.col(period) - F.col("_from")).alias("periods_since_active"),
        period,
    )


def first_last_ratio(df: DataFrame, history: str, field: str) -> DataFrame:
    """Add the first and latest value of a history field and latest / first (a first of 0 counts as 1)."""
    first = F.get(F.col(history), F.lit(0))[field]
    latest = F.try_element_at(F.col(history), F.lit(-1))[field]
    return df.withColumns({
        f"first_{field}": first,
        f"latest_{field}": latest,
        "ratio": latest / F.when(first == 0, F.lit(1)).otherwise(first),
    })


def unnest_history(df: DataFrame, key: str | Sequence[str], history: str, keep_empty: bool = False) -> DataFrame:
    """One row per history element, with its position, in order."""
    explode = F.posexplode_outer if keep_empty else F.posexplode
    rows = df.select(*names(key), explode(history).alias("position", "_record"))
    return rows.select(*names(key), "position", "_record.*")

"""Analytical patterns: grouping sets, rolling trends, funnels, stretches and streaks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import column, names
from strata.operators.clean import dedupe_exact
from strata.operators.guards import present
from strata.operators.skew import blocked_totals, large_groups, running_totals, spread_join
from strata.session import shared_dir


def grouping_rollup(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    sums: Mapping[str, str | Column],
    overall: str = "(overall)",
    labels: Mapping[tuple[str, ...], str] | None = None,
) -> DataFrame:
    """Totals over explicit grouping sets, with the level's label and ``overall`` in rolled-up columns.

    ``sums`` maps a result column to the row value it adds up (``F.lit(1)`` counts
    rows). Rows are first added up at the finest grain, so the expansion to one
    copy per set works on groups instead of raw rows.
    """
    dims = list(dict.fromkeys(d for s in sets for d in s))
    fine = df.groupBy(*dims).agg(*[F.sum(column(v)).alias(name) for name, v in sums.items()])
    level = None
    for s in sets:
        label = (labels or {}).get(tuple(s), "__".join(s) or overall)
        here = F.lit(True)
        for d in dims:
            here = here & (F.grouping(d) == (0 if d in s else 1))
        level = F.when(here, F.lit(label)) if level is None else level.when(here, F.lit(label))
    totals = fine.groupingSets([[F.col(d) for d in s] for s in sets], *[F.col(d) for d in dims]).agg(
        level.alias("aggregation_level"),
        *[F.grouping(d).alias("_g_" + d) for d in dims],
        *[F.sum(name).alias(name) for name in sums],
    )
    shown = [F.when(F.col("_g_" + d) == 1, F.lit(overall)).otherwise(F.col(d).cast("string")).alias(d) for d in dims]
    return totals.select("aggregation_level", *shown, *sums)


def leaders(df: DataFrame, by: str, level: str | Sequence[str] = ()) -> DataFrame:
    """Rows with the greatest ``by`` within each level, ties included.

    The maxima come from a hash aggregate, a row per level and task; the rows that equal theirs stay
    where they are, so neither a hot level nor very many ties meet in one task. A null
    level is a level like others, and null leads only where all are null. The rows, an aggregate as a rule and small
    beside the facts it was made of, are stored first, so that what they come from is computed once.
    """
    levels = names(level)
    path = shared_dir(df.sparkSession, "leaders")
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    best = df.groupBy(*levels).agg(F.max(by).alias("_best")).select(
        *[F.col(c).alias(f"_level_{n}") for n, c in enumerate(levels)], "_best")
    same = F.col(by).eqNullSafe(F.col("_best"))
    for n, c in enumerate(levels):
        same = same & F.col(c).eqNullSafe(F.col(f"_level_{n}"))
    # without levels there is one maximum; else a row per level, which the planner weighs
    return df.join(best if levels else F.broadcast(best), same).select(*df.columns)


def _window_sum(measure: str, window) -> Column:
    return F.sum(measure).over(window)


def rolling_trends(
    daily: DataFrame,
    key: str | Sequence[str],
    day: str,
    measure: str,
    min_total: float | DataFrame | None = None,
    previous: tuple[int, int] = (13, 7),
    calendar: bool = False,
    required: str | Sequence[str] = (),
) -> DataFrame:
    """Month, running, grand and rolling totals per key and day, and the row's share of two of them.

    ``daily`` holds one row per key and day, so a window group is bounded by the
    calendar; all windows share one shuffle on the key. Rolling frames count rows
    (the current and six before it; ``previous`` rows back), or calendar days with
    ``calendar``. ``previous=(13, 6)`` overlaps the current frame by one row. Keys with a grand total of ``min_total`` or
    less are left out; it is a number, or a table of one row and one column that has it. Rows
    without a value in the ``required`` columns are left out; null is a key like others.
    """
    keys = names(key)
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    per_key = Window.partitionBy(*keys)
    ordered = per_key.orderBy(day)
    if calendar:
        rolling = per_key.orderBy(F.unix_date(day))
        frames = rolling.rangeBetween(-6, 0), rolling.rangeBetween(-previous[0], -previous[1])
    else:
        frames = ordered.rowsBetween(-6, 0), ordered.rowsBetween(-previous[0], -previous[1])
    out = present(daily, names(required)).withColumn("_month", F.trunc(day, "month")).withColumns({
        "running_total": _window_sum(measure, ordered.rowsBetween(Window.unboundedPreceding, 0)),
        "grand_total": _window_sum(measure, ordered.rowsBetween(*whole)),
        "weekly_rolling": _window_sum(measure, frames[0]),
        "previous_weekly_rolling": _window_sum(measure, frames[1]),
    })
    if isinstance(min_total, DataFrame):
        out = out.where(F.col("grand_total") > min_total.scalar())
    elif min_total is not None:
        out = out.where(F.col("grand_total") > F.lit(min_total))
    out = out.withColumn("monthly_total", _window_sum(measure, Window.partitionBy(*keys, "_month")))
    return out.drop("_month").withColumns({
        "pct_of_month": F.try_divide(F.col(measure), F.col("monthly_total")),
        "pct_of_total": F.try_divide(F.col(measure), F.col("grand_total")),
    })


def share_of_total(daily: DataFrame, key: str | Sequence[str], measure: str, day: str, required: str | Sequence[str] = ()) -> DataFrame:
    """Each row's share of its key's month and of its key's grand total."""
    out = rolling_trends(daily, key, day, measure, required=required)
    return out.select(*names(key), day, measure, "monthly_total", "grand_total", "pct_of_month", "pct_of_total")


def funnel_conversion(
    events: DataFrame, user: str, ts: str, step: str, target: str, min_n: int = 0, include_last: bool = False,
    most: int = 1_000_000,
) -> DataFrame:
    """Per step: events with a later event of the same user and day, and the share later reaching ``target``.

    Two maxima per user and day replace the self-join: the last event, and the
    last event of the target step. They are aggregated before the shuffle and
    joined back as one row per user and day; the events of a user and day with more
    than ``most`` of them are joined where they are. ``include_last`` also counts
    events that nothing follows.
    """
    day = F.to_date(ts).alias("_day")
    known = present(events, [user])
    rows = dedupe_exact(known, [user, ts, step]).withColumn("_day", day)
    # stored, as both the decision and the join read it: the events are aggregated once
    peaks = known.groupBy(user, day).agg(
        F.max(ts).alias("_last"), F.max(F.when(F.col(step) == target, F.col(ts))).alias("_target"), F.count(F.lit(1)).alias("_n"))
    path = shared_dir(events.sparkSession, "peaks")
    peaks.write.parquet(path)
    stored = events.sparkSession.read.schema(peaks.schema).parquet(path)
    large = stored.where(F.col("_n") > most).select(user, "_day")
    large, peaks = None if large.isEmpty() else large, stored.drop("_n")
    followed = spread_join(rows, peaks, [user, "_day"], large)
    if not include_last:
        followed = followed.where(F.col(ts) < F.col("_last"))
    out = followed.groupBy(step).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("_target") > F.col(ts)).alias("converted"))
    out = out.withColumn("conversion_rate", F.col("converted") / F.col("events"))
    return out.where((F.col("converted") > 0) & (F.col("events") > min_n))


def best_stretch(
    games: DataFrame, team: str, day: str, game: str, win: str, n: int = 90, width: int = 1_000_000, counted: DataFrame | None = None
) -> DataFrame:
    """Most wins of each team in any ``n`` consecutive games, ordered by (day, game id).

    ``games_in_window`` is below ``n`` for a team with fewer games. Where a team has
    more than ``width`` games, games are numbered by blocked running totals and cut
    into blocks of numbers; the last ``n - 1`` games of a block are also sent to the
    next one, so that every frame lies inside one block and no team in one task.
    ``counted`` as in ``running_totals``.
    """
    slim = games.select(team, day, game, F.col(win).cast("bigint").alias("_win"))
    if large_groups(slim if counted is None else counted, team, width) is None:
        frame = Window.partitionBy(team).orderBy(day, game).rowsBetween(-(n - 1), 0)
        framed = slim.select(team, F.sum("_win").over(frame).alias("_wins"), F.count(F.lit(1)).over(frame).alias("_games"))
        return framed.groupBy(team).agg(F.max("_wins").alias("most_wins"), F.max("_games").alias("games_in_window"))
    numbered = blocked_totals(slim.withColumn("_one", F.lit(1).cast("bigint")), [team], day, game, {"_no": "_one"})
    size = max(width, n)
    place = F.pmod(F.col("_no") - 1, F.lit(size))
    own = F.col("_no") - 1 - place
    copies = F.when(place >= size - (n - 1), F.array(own, own + size)).otherwise(F.array(own))
    rows = numbered.withColumn("_own", own).withColumn("_block", F.explode(copies))
    frame = Window.partitionBy(team, "_block").orderBy("_no").rowsBetween(-(n - 1), 0)
    framed = rows.withColumns({"_wins": F.sum("_win").over(frame), "_games": F.count(F.lit(1)).over(frame)})
    return framed.where(F.col("_own") == F.col("_block")).groupBy(team).agg(
        F.max("_wins").alias("most_wins"), F.max("_games").alias("games_in_window"))


def longest_streak(
    rows: DataFrame, key: str | Sequence[str], day: str, seq: str, predicate: Column, width: int = 1_000_000,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Longest run of consecutive rows per key that meet ``predicate``, with its first and last day.

    A run is numbered by the failures before it (null counts as a failure), then
    counted by aggregation. The earliest of equally long runs is reported; a key
    without any has length 0 and no days. ``counted`` as in ``running_totals``.
    """
    keys = names(key)
    hit = F.coalesce(predicate, F.lit(False))
    flagged = rows.select(*keys, day, seq, F.when(hit, 0).otherwise(1).cast("bigint").alias("_fail"))
    runs = running_totals(flagged, keys, day, seq, {"_run": "_fail"}, width, counted)
    met = F.col("_fail") == 0
    per_run = runs.groupBy(*keys, "_run").agg(
        F.count_if(met).alias("_len"), F.min(F.when(met, F.col(day))).alias("_from"), F.max(F.when(met, F.col(day))).alias("_to"))
    best = F.max_by(F.struct("_len", "_from", "_to"), F.struct(F.col("_len"), -F.col("_run")))
    return per_run.groupBy(*keys).agg(best.alias("_best")).select(
        *keys, F.col("_best._len").alias("streak"), F.col("_best._from").alias("streak_start"), F.col("_best._to").alias("streak_end"))

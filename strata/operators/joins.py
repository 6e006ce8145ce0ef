"""Join strategies and the match report built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.guards import maybe_broadcast, present
from strata.operators.patterns import leaders


def broadcast_enrich(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], how: str = "left") -> DataFrame:
    """Join small dimensions by explicit broadcast, each after a check of its size.

    A dimension above the limits is joined by shuffle instead, with the same result.
    """
    for dim, key in dims:
        fact = fact.join(maybe_broadcast(dim), key, how)
    return fact


def bucket_join(
    spark: SparkSession,
    left: str,
    right: str | Sequence[str],
    key: str,
    where: Column | None = None,
    how: str = "inner",
    hot: DataFrame | None = None,
    salts: int = 32,
) -> DataFrame:
    """Join tables written by ``write_bucketed`` with equal bucket counts, without a shuffle.

    ``right`` may name several tables, joined in turn; ``where`` is a condition on the left table, by which its
    partitions are pruned. Merge hints keep the planner from broadcasting a bucketed table.
    ``hot`` lists keys (column ``key``) with more rows than a task should hold
    (``large_groups`` finds them): their rows, on both sides, leave the bucket join and are
    joined by (key, salt), the left rows dealt to ``salts`` salts and the right rows copied to each.
    The result is the same with and without it; it needs an inner or left join.
    """
    rights = [right] if isinstance(right, str) else list(right)
    out = spark.table(left) if where is None else spark.table(left).where(where)
    if hot is None:
        for name in rights:
            out = out.hint("merge").join(spark.table(name).hint("merge"), key, how)
        return out
    few = maybe_broadcast(hot.select(key))
    regular, apart = out.join(few, key, "left_anti"), out.join(few, key, "left_semi")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in out.columns]), F.lit(salts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    for name in rights:
        other = spark.table(name)
        regular = regular.hint("merge").join(other.join(few, key, "left_anti").hint("merge"), key, how)
        copied = other.join(few, key, "left_semi").withColumn("_salt", every)
        apart = apart.withColumn("_salt", salt).join(copied, [key, "_salt"], how).drop("_salt")
    return regular.unionByName(apart)


def salted_join(spark: SparkSession, left: str, right: str | Sequence[str], key: str, where: Column | None = None, how: str = "inner") -> DataFrame:
    """Join a table written by ``write_salted`` with others written with its salts and ``copies``, without a shuffle.

    Every row of the left table has one salt and finds each right row once, under that salt. The rows of a hot key
    are dealt to all buckets, so each task reads about as much as any other. Inner or left join.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join joins inner or left")
    out = spark.table(left) if where is None else spark.table(left).where(where)
    for name in [right] if isinstance(right, str) else right:
        out = out.hint("merge").join(spark.table(name).hint("merge"), [key, "_salt"], how)
    return out.drop("_salt")


def avg_kills_per_game(match_details: DataFrame, player: str, match: str, kills: str) -> DataFrame:
    """Players with the highest mean kills per match (ties included)."""
    per_player = match_details.groupBy(player, match).agg(F.sum(kills).alias("_kills")).groupBy(player).agg(
        F.avg("_kills").alias("avg_kills"), F.count(F.lit(1)).alias("matches"))
    return leaders(per_player, "avg_kills")


def most_played(matches: DataFrame, dim: str, match: str) -> DataFrame:
    """The dimension value (playlist, map) with most distinct matches (ties included)."""
    return leaders(present(matches, [dim]).groupBy(dim).agg(F.count_distinct(match).alias("matches")), "matches")


def top_map_for_medal(
    medals_players: DataFrame,
    medals: DataFrame,
    matches: DataFrame,
    maps: DataFrame,
    medal: str,
    match: str = "match_id",
    medal_id: str = "medal_id",
    map_id: str = "map_id",
) -> DataFrame:
    """Maps with most medals of one name (ties included).

    ``medals`` has (medal_id, medal_name), ``medals_players`` (match, medal_id,
    medal_count), ``maps`` (map_id, map_name). The medal name is filtered in the
    dimension, and medals are added up per match before the matches are joined,
    so the join cannot fan out.
    """
    wanted = medals.where(F.col("medal_name") == medal).select(medal_id)
    per_match = medals_players.join(maybe_broadcast(wanted), medal_id).groupBy(match).agg(F.sum("medal_count").alias("_n"))
    per_map = matches.select(match, map_id).join(per_match, match).groupBy(map_id).agg(F.sum("_n").alias("medals"))
    return leaders(broadcast_enrich(per_map, [(maps.select(map_id, "map_name"), map_id)]), "medals")

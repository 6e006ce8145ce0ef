"""Property graph as two tables: vertices and edges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import column, names
from strata.operators.clean import dedupe_by_key
from strata.operators.guards import maybe_broadcast
from strata.operators.skew import large_groups, split_pairs, with_keys

# The vertex and edge types of the model.
VERTEX_TYPES = ["player", "team", "game"]
EDGE_TYPES = ["plays_against", "shares_team", "plays_in", "plays_on"]


def properties(fields: Mapping[str, str | Column]) -> Column:
    """A string map of named values."""
    return F.create_map(*[e for name, value in fields.items() for e in (F.lit(name), column(value).cast("string"))])


def vertices(
    df: DataFrame,
    identifier: str,
    vertex_type: str,
    props: Mapping[str, str | Column],
    order_by: Sequence[str | Column],
) -> DataFrame:
    """One vertex per identifier: (identifier, type, properties)."""
    first = dedupe_by_key(df, identifier, order_by)
    return first.select(F.col(identifier).alias("identifier"), F.lit(vertex_type).alias("type"),
                        properties(props).alias("properties"))


def aggregate_vertices(df: DataFrame, identifier: str, vertex_type: str, props: Mapping[str, Column]) -> DataFrame:
    """One vertex per identifier from many rows, such as a player's games: properties are aggregates of them; rows without an identifier are left out."""
    totals = df.where(F.col(identifier).isNotNull()).groupBy(identifier).agg(*[value.alias(f"_p{n}") for n, value in enumerate(props.values())])
    return totals.select(F.col(identifier).alias("identifier"), F.lit(vertex_type).alias("type"),
                         properties({name: f"_p{n}" for n, name in enumerate(props)}).alias("properties"))


def membership_edges(
    df: DataFrame,
    subject: str,
    subject_type: str,
    object_: str,
    object_type: str,
    edge_type: str,
    props: Mapping[str, str | Column],
    order_by: Sequence[str | Column],
) -> DataFrame:
    """One edge subject -> object per distinct pair, with the properties of its first row."""
    first = dedupe_by_key(df, [subject, object_], order_by)
    return first.select(
        F.col(subject).alias("subject_identifier"), F.lit(subject_type).alias("subject_type"),
        F.col(object_).alias("object_identifier"), F.lit(object_type).alias("object_type"),
        F.lit(edge_type).alias("edge_type"), properties(props).alias("properties"),
    )


def _pairs_of_groups(df: DataFrame, event: str, node: str, order_by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Every unordered pair of different nodes of an event once: structs ``l`` (greater id) and ``r`` of node and values.

    An event's rows become one sorted array, in which a node counts with its first row, and each element meets
    those after it: one shuffle, and no pair is made twice. For events of a bounded number of rows.
    """
    one = F.struct(F.col(node).alias("_0"), *[F.col(c).alias(f"_o{n}") for n, c in enumerate(order_by)], *[F.col(c).alias(f"_v{n}") for n, c in enumerate(values)])
    sorted_rows = df.where(F.col(event).isNotNull() & F.col(node).isNotNull()).groupBy(event).agg(F.sort_array(F.collect_list(one)).alias("_all"))
    first = F.filter("_all", lambda x, n: (n == 0) | (F.get("_all", n - 1)["_0"] != x["_0"]))
    slim = F.transform(first, lambda x: F.struct(x["_0"].alias("_0"), *[x[f"_v{n}"].alias(f"_{n + 1}") for n in range(len(values))]))
    each = sorted_rows.select(slim.alias("_all")).where(F.size("_all") > 1).select("_all", F.posexplode("_all").alias("_n", "r"))
    return each.select("r", F.explode(F.slice("_all", F.col("_n") + 2, F.size("_all"))).alias("l"))


def cooccurrence_edges(
    df: DataFrame,
    event: str,
    node: str,
    name: str,
    group: str,
    measure: str,
    order_by: Sequence[str | Column],
    same: str = "shares_team",
    different: str = "plays_against",
    most: int = 2_000,
    counted: DataFrame | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Unordered pairs of nodes seen in the same event, as edges from the greater to the smaller id.

    Per pair and kind of edge: events shared and both sides' summed measure; nodes of equal names make no pair. A node counts
    once an event, with its first row by ``order_by`` (which must break every tie). The result holds every pair: those of an event of up to ``most`` rows are made
    in its task, those of a larger one are divided over many tasks rather than capped. Sizes are taken from
    ``counted``, a cheaper table that holds at least the events' rows (the raw fact).
    Names are read from the rows, or, cheaper, from ``labels`` (``node``, ``name``; one row a node), which is joined
    to the finished edges, so that only ids are paired and shuffled; a node without a label has no edges.
    """
    values = [group, measure] if labels is not None else [group, measure, name]
    counted = df if counted is None else counted
    large = large_groups(counted, event, most)
    plain = all(isinstance(c, str) for c in order_by)
    parts = []
    if plain:
        small = df if large is None else with_keys(df, maybe_broadcast(large.select(event)), [event], "left_anti")
        parts.append(_pairs_of_groups(small, event, node, list(order_by), values))
    if large is not None or not plain:
        some = with_keys(df, maybe_broadcast(large.select(event)), [event], "left_semi") if plain else df
        rows = dedupe_by_key(some, [event, node], order_by).select(event, node, *values)
        left, right, cell = split_pairs(rows, counted, event, node, most)
        side = lambda rows, as_: rows.select(*cell, F.struct(*[F.col(c).alias(f"_{n}") for n, c in enumerate([node, *values])]).alias(as_))
        parts.append(side(left, "l").join(side(right, "r"), cell).where(F.col("l._0") > F.col("r._0")).select("r", "l"))
    pairs = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    kind = F.when(F.col("l._1") == F.col("r._1"), F.lit(same)).otherwise(F.lit(different))
    totals = [F.count(F.lit(1)).alias("num_events"), F.sum("l._2").alias("subject_total"), F.sum("r._2").alias("object_total")]
    keys = [F.col("l._0").alias("subject_identifier"), F.col("r._0").alias("object_identifier"), kind.alias("edge_type")]
    columns = ["subject_identifier", "subject_name", "object_identifier", "object_name", "edge_type", "num_events", "subject_total", "object_total"]
    if labels is None:
        named = pairs.where(F.col("l._3") != F.col("r._3"))
        return named.groupBy(*keys, F.col("l._3").alias("subject_name"), F.col("r._3").alias("object_name")).agg(*totals).select(*columns)
    edges = pairs.groupBy(*keys).agg(*totals)
    known = maybe_broadcast(labels.select(node, name))
    for end in ("subject", "object"):
        edges = edges.join(known.select(F.col(node).alias(f"{end}_identifier"), F.col(name).alias(f"{end}_name")), f"{end}_identifier")
    return edges.where(F.col("subject_name") != F.col("object_name")).select(*columns)

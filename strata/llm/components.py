"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


# Up to so many links, what each node learns in a step goes to all tasks instead of being shuffled to the links.
FEW_LINKS = 200_000


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of the edges (a, b): comp is the smallest node reachable. Stored.

    Alternates two steps: every node links its larger neighbours, then its smaller ones, to the smallest of its
    neighbourhood. All is settled when each node has one name only: what it links to, or its own where others
    link to it. The number of rounds
    grows with the logarithm of the longest path. Neighbourhoods are only ever reduced to
    their minimum, so a node with very many links is one row per task in the aggregate, and
    the many rows of the join that follows are split by adaptive execution, or not shuffled where links are few.
    Loops and repeated edges make no difference; no edges give no rows.
    """
    forward = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = stored(forward.where("u <> v"), "links")
    for _ in range(max_rounds):
        few = links.count() <= FEW_LINKS  # steps never make more of them
        links = stored(_small_star(stored(_large_star(links, few), "links"), few), "links")
        names = links.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("comp")))
        names = stored(names.groupBy("node").agg(F.min("comp").alias("comp"), (F.min("comp") != F.max("comp")).alias("loose")), "components")
        if names.where("loose").isEmpty():
            return names.select("node", "comp")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _large_star(links: DataFrame, few: bool) -> DataFrame:
    """Every node's larger neighbours point to the smallest of its neighbourhood, itself included."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(F.broadcast(least) if few else stored(least, "least").hint("merge"), "u")
    moved = larger.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved if few else moved.distinct()


def _small_star(links: DataFrame, few: bool) -> DataFrame:
    """Every node and its smaller neighbours point to the smallest of these."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    smaller = links.join(F.broadcast(least) if few else stored(least, "least").hint("merge"), "u")
    # the smallest needs no link to itself: its row is the node's own
    moved = smaller.select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
    return moved if few else moved.distinct()

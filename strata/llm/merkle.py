"""Merkle manifest of a dataset: a tree for each group of rows, and a tree over the groups.

Digests are lowercase hex SHA-256; a node is the digest of its children's hex texts, one after the other.
Leaves have positions in their group. Only every LEVELS-th level is stored, as rows (group, block, nodes) that hold the
2 ** LEVELS nodes of one aligned subtree: a block's root is a node of the next stored level. What lies between is recomputed
from a block's stored nodes whenever it is needed, when the tree is built and when proofs are taken, and dropped again.

Proofs are taken from the top down: the siblings above a block's root are known from the stored level above, so a
block needs no more than its own nodes and that list. A block is the unit of work: groups are cut into blocks whatever
their size, so a group that holds all rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.operators.guards import maybe_broadcast
from strata.operators.skew import blocked_totals

# Levels of the tree between two stored ones; a block has 2 ** LEVELS nodes at most.
LEVELS = 8
NODE = "pos bigint, digest string, id string, claim string"
RAISED = "grp string, pos bigint, digest string, last boolean"
PATHS = "grp string, pos bigint, subroot string, path array<string>"
PROOFS = "id string, leaf string, subroot string, proof array<string>, proof_sha256 string, folded_root string"


@dataclass
class Manifest:
    """The root, the subroots (grp, subroot), and the stored levels below and above the subroots."""

    root: str | None
    subroots: DataFrame
    inner: list[DataFrame] = field(default_factory=list)
    outer: list[DataFrame] = field(default_factory=list)


def leaf_of(values: list[Column]) -> Column:
    """Digest of a row: every value as its length in UTF-8 bytes, a colon and its text, ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does by its UTF-8 bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def parent(*children: str) -> str:
    return sha256("".join(children).encode()).hexdigest()


def subtree(nodes: list[str], height: int) -> list[list[str]]:
    """All levels of a block from its stored nodes up to ``height`` levels above; a node without a sibling is hashed alone."""
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([parent(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def height_of(n: int, last: bool) -> int:
    """Levels that a block of n nodes rises: all of them, or until one node is left if the group has no other block."""
    return (n - 1).bit_length() if last else LEVELS


def siblings(levels: list[list[str]], i: int) -> list[str]:
    """The path of node i up to the root of its block: an entry for each level, ``L`` or ``R`` and the sibling on that side, or empty."""
    path = []
    for level in levels[:-1]:
        j = i ^ 1
        path.append(("L" if j < i else "R") + level[j] if j < len(level) else "")
        i >>= 1
    return path


def fold(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its path lead to."""
    for step in path:
        leaf = parent(step[1:], leaf) if step[:1] == "L" else parent(leaf, step[1:])
    return leaf


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    names, types = zip(*(c.rsplit(" ", 1) for c in schema.split(", ")))
    cols = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(cols, types)], list(names))


def _raised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The root of every block."""
    for batch in batches:
        out = []
        for grp, block, last, nodes in zip(*(batch.column(c).to_pylist() for c in ("grp", "block", "last", "nodes"))):
            out.append((grp, block, subtree([x["digest"] for x in nodes], height_of(len(nodes), last))[-1][0], last))
        yield _batch(out, RAISED)


def _per_node(make, schema):
    """Rows that ``make`` gives for every node of a block, its own path and that of the block's root together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                levels = subtree([x["digest"] for x in row["nodes"]], height_of(len(row["nodes"]), row["last"]))
                yield _batch([make(row, x, siblings(levels, i) + row["path"]) for i, x in enumerate(row["nodes"])], schema)

    return run


def _path_row(row: dict, node: dict, path: list[str]) -> tuple:
    return row["grp"], node["pos"], row["subroot"], path


def _proof_row(row: dict, node: dict, path: list[str]) -> tuple:
    # the proof is what the path holds besides the sides; siblings follow each other from the leaf to the root
    proof = parent(*[step[1:] for step in path])
    return node["id"], node["digest"], row["subroot"], path, proof, fold(node["claim"] or node["digest"], path)


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (grp, pos, digest, id, claim) as stored blocks; ``last`` marks the block of a group that has no other."""
    many = stored(nodes.where(F.col("pos") >= 1 << LEVELS).select("grp").distinct().withColumn("more", F.lit(True)), "merkle-groups")
    block = F.shiftright("pos", LEVELS).alias("block")
    node = F.struct("pos", "digest", "id", "claim")
    blocks = nodes.groupBy("grp", block).agg(F.sort_array(F.collect_list(node)).alias("nodes"))
    marked = blocks.join(maybe_broadcast(many), "grp", "left").withColumn("last", F.col("more").isNull()).drop("more")
    return stored(marked, "merkle-level")


def _grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels above the nodes, and (grp, digest) of the root of every group."""
    levels, roots = [], []
    while True:
        levels.append(_blocks(nodes))
        raised = stored(levels[-1].mapInArrow(_raised, RAISED), "merkle-roots")
        roots.append(raised.where("last").select("grp", "digest"))
        nodes = raised.where("not last").select("grp", "pos", "digest", F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("claim"))
        if nodes.isEmpty():
            every = roots[0]
            for more in roots[1:]:
                every = every.unionByName(more)
            return levels, stored(every, "merkle-subroots")


def _placed(leaves: DataFrame, order: str) -> DataFrame:
    """Add ``pos``, the place of a leaf in its group from 0; rows are cut by position, not by group."""
    counted = leaves.withColumn("one", F.lit(1).cast("bigint"))
    placed = blocked_totals(counted, ["grp"], order, "digest", {"place": "one"})
    return placed.withColumn("pos", F.col("place") - 1).drop("one", "place")


def build(leaves: DataFrame) -> Manifest:
    """The manifest of leaves (grp, ord, digest, id, claim).

    ``grp`` is never null (see ``group_key``); groups follow each other by code point, leaves of a group by ``ord`` (null
    first), then by digest, so that repeated rows and ids have a fixed result. ``id`` (text) and ``claim`` (a digest to be
    verified in the leaf's place, null for the leaf itself) go with the leaf. No leaves: no subroots, the root is null.
    """
    inner, roots = _grow(_placed(leaves, "ord").drop("ord"))
    groups = roots.select(F.lit("").alias("grp"), F.col("grp").alias("id"), "digest", F.lit(None).cast("string").alias("claim"))
    outer, top = _grow(_placed(groups, "id"))
    root = top.first()
    return Manifest(root["digest"] if root else None, roots.withColumnRenamed("digest", "subroot"), inner, outer)


def _descend(levels: list[DataFrame], tops: DataFrame, make, schema: str) -> DataFrame:
    """Rows of every lowest node, level by level from the paths (grp, subroot, path) of the groups' roots.

    A block is joined with the one path of its root, so both sides of the join have unique keys.
    """
    above = None
    for k in reversed(range(len(levels))):
        blocks = levels[k]
        done = blocks.where("last").join(tops, "grp")
        if above is not None:
            paths = above.withColumnRenamed("pos", "block")
            done = done.unionByName(blocks.where("not last").join(paths, ["grp", "block"]))
        if k == 0:
            return done.mapInArrow(_per_node(make, schema), schema)
        above = stored(done.mapInArrow(_per_node(_path_row, PATHS), PATHS), "merkle-paths")


def proofs(manifest: Manifest) -> DataFrame:
    """For every leaf: id, leaf, subroot, its inclusion ``proof`` up to the root, the digest of its siblings, and the root its claim folds to.

    ``proof`` has an entry for each level: ``L`` or ``R`` and the digest of the sibling on that side, or an empty text.
    """
    spark = manifest.subroots.sparkSession
    start = spark.createDataFrame([("", "", [])], "grp string, subroot string, path array<string>")
    # an outer node's id is the name of the group whose root it is
    upper = _descend(manifest.outer, start, lambda row, node, path: (node["id"], node["digest"], path), "grp string, subroot string, path array<string>")
    return _descend(manifest.inner, maybe_broadcast(stored(upper, "merkle-tops")), _proof_row, PROOFS)


def verify(docs: DataFrame, fields: list[str], group: str, order: str, claims: dict[str, Column] | None = None) -> DataFrame:
    """Manifest and proofs of all rows: id (``order`` as text), leaf, subroot, root, proof, proof_sha256, folded_root, verified.

    A leaf is the digest of ``fields``; leaves are grouped by ``group`` and ordered by ``order``. ``claims`` replaces
    fields by other values in the row that is to be verified: a row is verified if its claimed fields and the siblings of
    its leaf lead to the root. Null fields, groups and orders are values like others; empty texts differ from null; repeated
    rows are a leaf each. Other columns of ``docs`` are not read. An empty table has no rows.
    """
    named = {c: F.col(f"`{c}`") for c in fields}
    own = leaf_of(list(named.values()))
    changed = leaf_of([(claims or {}).get(c, v) for c, v in named.items()])
    leaves = docs.select(
        group_key(F.col(f"`{group}`")).alias("grp"), F.col(f"`{order}`").alias("ord"), own.alias("digest"),
        F.col(f"`{order}`").cast("string").alias("id"), (changed if claims else F.lit(None).cast("string")).alias("claim"))
    manifest = build(leaves)
    return proofs(manifest).withColumn("root", F.lit(manifest.root)).withColumn("verified", F.col("folded_root") == F.col("root"))

"""Cleaning and enrichment: deduplication, defaults, dimension joins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.columns import names
from strata.operators.guards import maybe_broadcast, present
from strata.session import session_conf


def dedupe_by_key(df: DataFrame, keys: str | Sequence[str], order_by: str | Column | Sequence[str | Column]) -> DataFrame:
    """Keep the first row per key by ``order_by``, which must break every tie.

    The ``row_number() = 1`` filter is planned with a group limit on both sides
    of the shuffle, so each map task sends at most one row of a key however many
    copies it holds.
    """
    order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    if not order:
        raise ValueError("dedupe_by_key needs an order, or the surviving row is arbitrary")
    w = Window.partitionBy(*names(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def dedupe_exact(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of a column list."""
    return df.select(*cols).distinct()


def fill_unknown(df: DataFrame, cols: Sequence[str], literal: str = "unknown") -> DataFrame:
    """Null dimension values become a literal."""
    return df.fillna({c: literal for c in cols})


def require_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose listed columns are all non-null."""
    return present(df, cols)


def enrich(
    events: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    renames: dict[str, str] | None = None,
    upper: Iterable[str] = (),
) -> DataFrame:
    """Join a dimension onto events, rename columns, upper-case some of them.

    The dimension is broadcast only after its size was measured.
    """
    if how not in ("inner", "left"):
        raise ValueError("enrich joins inner or left")
    out = events.join(maybe_broadcast(dim), names(on), how)
    out = out.withColumnsRenamed(renames or {})
    return out.withColumns({c: F.upper(c) for c in upper}) if upper else out


def join_as_pair(left: DataFrame, right: DataFrame, condition: Column, how: str = "inner") -> DataFrame:
    """Join two tables and keep each side as one nested record.

    ``condition`` names the sides ``l`` and ``r``; an unmatched side of an outer
    join is a null record.
    """
    lhs = left.select(F.struct(*left.columns).alias("left"))
    rhs = right.select(F.struct(*right.columns).alias("right"))
    a = lhs.select("left", "left.*").alias("l")
    b = rhs.select("right", "right.*").alias("r")
    return a.join(b, condition, how).select("left", "right")


def upsert_by_key(target: DataFrame, new: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The target with ``new`` rows inserted, replacing those of the same key."""
    return target.join(new.select(*names(keys)), names(keys), "left_anti").unionByName(new)


PART = "_part"


def _key_part(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(parts)).cast("int")


def create_upsert_table(df: DataFrame, table: str, keys: str | Sequence[str], parts: int = 64, path: str | None = None) -> None:
    """Write a table that ``upsert_partitions`` changes: divided by a hash of the key into ``parts`` partitions (column ``_part``).

    Choose ``parts`` so that a partition is a few hundred MB to some GB: it is what a single changed key rewrites.
    """
    keys = names(keys)
    rows = df.withColumn(PART, _key_part(keys, parts))
    writer = rows.hint("rebalance", PART).write.partitionBy(PART).format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def upsert_partitions(spark: SparkSession, table: str, new: DataFrame, keys: str | Sequence[str], parts: int = 64) -> list[int]:
    """Insert ``new`` rows into a table of ``create_upsert_table``, replacing those of the same key; returns the partitions touched.

    Only partitions that a new key falls into are read and written; the files of all others stay as they are. ``new`` has
    one row a key and is read twice. A null key matches no row, as in any join. A write that fails leaves the table as it
    was, and the same call can be repeated. The list of partitions, at most ``parts`` numbers, is all that reaches the driver.
    """
    keys = names(keys)
    arriving = new.withColumn(PART, _key_part(keys, parts))
    touched = sorted(r[0] for r in arriving.select(PART).distinct().collect())
    if not touched:
        return []
    kept = spark.table(table).where(F.col(PART).isin(*touched))
    columns = spark.table(table).columns
    merged = kept.join(arriving.select(*keys, PART), [*keys, PART], "left_anti").select(*columns).unionByName(arriving.select(*columns))
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        merged.hint("rebalance", PART).write.mode("overwrite").insertInto(table)
    return touched

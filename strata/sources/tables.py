"""Batch sources and sinks: typed reads, period writes, bucketed and clustered layouts."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.columns import names
from strata.operators.guards import maybe_broadcast
from strata.session import session_conf


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    require: Sequence[str] = (),
    infer: bool = False,
) -> DataFrame:
    """Read Parquet or CSV (with header), optionally only rows whose ``require`` columns are present.

    Without a schema a CSV is all strings; ``infer`` reads the file once more to
    guess its types.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", infer and schema is None)
    df = reader.load(path)
    for c in require:
        df = df.where(F.col(c).isNotNull())
    return df


def write_period(df: DataFrame, table: str, period_col: str, path: str | None = None, period: object = None) -> None:
    """Write the periods present in ``df``; a re-run replaces them and leaves the others alone.

    The first write creates the table, partitioned by the period; later ones match
    columns by name. Rows are rebalanced by period: few files per period, and
    several for one that holds most of the rows. Name the ``period`` that is run, so
    that a re-run without any rows empties it.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        writer = df.hint("rebalance", period_col).write.partitionBy(period_col).format("parquet")
        (writer if path is None else writer.option("path", path)).saveAsTable(table)
        return
    ordered = df.select(*spark.table(table).columns)
    if period is not None and ordered.isEmpty():
        value = F.lit(period).cast(spark.table(table).schema[period_col].dataType).alias("v")
        text = str(spark.range(1).select(value.cast("string")).first()[0]).replace("'", "\\'")
        nothing = f"nothing_{uuid.uuid4().hex}"
        spark.createDataFrame([], ordered.drop(period_col).schema).createTempView(nothing)
        try:
            with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
                spark.sql(f"insert overwrite table {table} partition (`{period_col}` = '{text}') select * from {nothing}")
        finally:
            spark.catalog.dropTempView(nothing)
        return
    with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        ordered.hint("rebalance", period_col).write.mode("overwrite").insertInto(table)


def run_periods(
    spark: SparkSession,
    table: str,
    period_col: str,
    periods: Sequence[int],
    step: Callable[[DataFrame | None, int], DataFrame],
    path: str | None = None,
) -> DataFrame:
    """Run a cumulative job period by period, each reading the period the run before it wrote.

    ``step(previous rows, period)`` returns the period's rows; the previous rows are
    None where the table holds no earlier period at all. Where it does, the period
    before must be there: a gap raises, as the history would be lost. Every period is a
    table write of its own, so no plan grows with the number of periods, and a run
    that was stopped goes on from (or repeats) any period.
    """
    for period in periods:
        prev = None
        if spark.catalog.tableExists(table):
            # the period is the partition column: both tests read only the partitions they need
            earlier = spark.table(table).where(F.col(period_col) < F.lit(period))
            before = earlier.where(F.col(period_col) == F.lit(period - 1))
            if not before.isEmpty():
                prev = before
            elif not earlier.isEmpty():
                raise ValueError(f"{table} holds earlier periods but none before {period}: run {period - 1} first")
        write_period(step(prev, period), table, period_col, path, period)
    return spark.table(table)


def materialize(df: DataFrame, table: str, mode: str = "overwrite", path: str | None = None) -> DataFrame:
    """Create a table from a query (for a dashboard) and return it."""
    writer = df.write.mode(mode).format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return df.sparkSession.table(table)


def write_bucketed(
    df: DataFrame,
    table: str,
    key: str,
    n: int = 16,
    sort: str | Sequence[str] | None = None,
    partition_by: str | None = None,
    path: str | None = None,
) -> None:
    """Write a table bucketed (and sorted within buckets) on the join key.

    Every row is in the table. Choose ``n`` for buckets of a few hundred MB
    (``bucket_count``); tables joined without a shuffle need the same ``n``. Rows are first hash-partitioned
    into the buckets, and adaptive execution divides the partition of a hot key, whose
    bucket then has several files but is read by one task: write tables with hot keys by ``write_salted``, or
    name the keys to ``bucket_join``.
    """
    writer = df.hint("rebalance", n, key).write.mode("overwrite").format("parquet").bucketBy(n, key).sortBy(*names(sort or key))
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def bucket_salts(hot: DataFrame, key: str, n: int, tries: int = 32) -> DataFrame:
    """(key, ``salts``) for the hot keys: salts that send (key, salt) to every one of ``n`` buckets, one salt for each.

    Rows are bucketed by the same hash that ``hash`` computes, so the salts of a key can be chosen instead of drawn: the
    lowest of ``tries`` x n numbers for each bucket. A bucket that none of them meets (a chance of n x exp(-tries)) gets no rows
    of the key. ``hot`` is short by its nature: fewer than n keys can each have more rows than a fair bucket.
    """
    tried = hot.select(key).distinct().select(key, F.explode(F.sequence(F.lit(1), F.lit(n * tries))).alias("_salt"))
    bucket = F.pmod(F.hash(key, "_salt"), F.lit(n))
    return tried.groupBy(key, bucket.alias("_bucket")).agg(F.min("_salt").alias("_salt")).groupBy(key).agg(
        F.sort_array(F.collect_list("_salt")).alias("salts"))


def write_salted(
    df: DataFrame,
    table: str,
    key: str,
    n: int,
    salts: DataFrame,
    copies: bool = False,
    sort: str | Sequence[str] | None = None,
    path: str | None = None,
) -> None:
    """Write a table bucketed on (key, ``_salt``), in which a hot key fills all buckets evenly.

    ``salts`` comes from ``bucket_salts`` and must be the same, with the same ``n``, for all tables that ``salted_join`` joins. Each
    row of a hot key gets one of its salts, by a hash of the whole row (equal rows share a salt); with ``copies``,
    for the side that has few rows a key, a row is written once for each salt. All other keys have salt 0.
    """
    deal = F.element_at("salts", (F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.size("salts")) + 1).cast("int"))
    few = maybe_broadcast(salts.withColumnRenamed(key, "_key"))
    joined = df.join(few, F.col(f"`{key}`").eqNullSafe(F.col("_key")), "left")
    salt = F.explode(F.coalesce("salts", F.array(F.lit(0)))) if copies else F.when(F.col("salts").isNull(), F.lit(0)).otherwise(deal)
    salted = joined.withColumn("_salt", salt).select(*[F.col(f"`{c}`") for c in df.columns], "_salt")
    writer = salted.hint("rebalance", n, key, "_salt").write.mode("overwrite").format("parquet").bucketBy(n, key, "_salt").sortBy(*names(sort or [key, "_salt"]))
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def bucket_count(rows: int, row_bytes: int, bucket_bytes: int = 256 * 1024 * 1024) -> int:
    """The power of two, so that tables of different sizes nest, that gives buckets of about ``bucket_bytes``."""
    wanted = max(1, rows * row_bytes / bucket_bytes)
    return 1 << math.ceil(math.log2(wanted))


def write_clustered(
    df: DataFrame,
    path: str,
    by: str | Sequence[str],
    sort_cols: Sequence[str],
    n: int | None = None,
    global_sort: bool = False,
) -> None:
    """Write Parquet whose files are sorted, so that equal values compress together.

    By default rows are rebalanced on ``by`` (a hash partitioning into ``n`` parts
    whose oversized parts adaptive execution splits and whose small ones it merges)
    and sorted inside partitions. ``global_sort`` range-partitions on the sort
    columns instead, which costs a sampling pass and spreads a hot value only as
    far as the remaining sort columns tell its rows apart.
    """
    if global_sort:
        parts = df.repartitionByRange(n, *sort_cols) if n else df.repartitionByRange(*sort_cols)
    else:
        parts = df.hint("rebalance", *([n] if n else []), *names(by))
    parts.sortWithinPartitions(*sort_cols).write.mode("overwrite").parquet(path)


def layout_report(spark: SparkSession, layouts: Mapping[str, str]) -> DataFrame:
    """Data files and bytes per layout; lists files without reading their rows."""
    reports = None
    for label, path in layouts.items():
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
                 .load(path).select("path", "length"))
        report = files.agg(F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size")).select(
            F.lit(label).alias("layout"), "num_files", "size")
        reports = report if reports is None else reports.unionByName(report)
    return reports


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep a shared aggregate for the block and release it afterwards.

    Blocks lost with an executor are computed again from the aggregate's inputs.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()

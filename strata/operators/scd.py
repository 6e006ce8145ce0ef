"""Slowly changing dimensions, type 2.

Layout: key columns, attribute columns, ``start_period``, ``end_period`` and,
where asked for, ``as_of`` (the period the table was computed at).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.columns import names
from strata.session import session_conf


def scd2_backfill(
    snapshots: DataFrame,
    key: str | Sequence[str],
    period: str,
    attrs: str | Sequence[str],
    as_of: int | None = None,
) -> DataFrame:
    """Runs of unchanged attributes as (start, end), null equal to null.

    ``snapshots`` holds one row per key and period without gaps (a run follows
    row order and does not notice a missing period). The window and the final
    grouping share one shuffle on the key, whose group is at most one row per
    period. ``as_of`` stops at that period and stamps it on the rows.
    """
    keys, attrs = names(key), names(attrs)
    rows = snapshots.select(*keys, period, *attrs)
    if as_of is not None:
        rows = rows.where(F.col(period) <= F.lit(as_of))
    w = Window.partitionBy(*keys).orderBy(period)
    state = F.struct(*attrs)
    changed = ~state.eqNullSafe(F.lag(state).over(w))
    runs = rows.withColumn("_new", changed.cast("int")).withColumn("_run", F.sum("_new").over(w))
    out = runs.groupBy(*keys, *attrs, "_run").agg(
        F.min(period).alias("start_period"), F.max(period).alias("end_period")).drop("_run")
    return out if as_of is None else out.withColumn("as_of", F.lit(as_of))


def scd2_incremental(
    scd: DataFrame,
    snapshots: DataFrame,
    key: str | Sequence[str],
    attrs: str | Sequence[str],
    period: str,
    run_period: int,
) -> DataFrame:
    """The SCD table as of ``run_period`` from the one as of ``run_period - 1`` and one new period.

    Closed rows pass through without a shuffle. The open row of a key and its
    new snapshot row meet in one full join, which yields the extended row, the
    closed and the opened row, the first row of a new key, or the untouched row
    of a key that is missing from the new period.
    """
    keys, attrs = names(key), names(attrs)
    before = scd.where(F.col("as_of") == F.lit(run_period - 1)).drop("as_of")
    closed = before.where(F.col("end_period") < F.lit(run_period - 1))
    current = before.where(F.col("end_period") == F.lit(run_period - 1)).select(
        *keys, F.struct(*attrs).alias("_old"), "start_period", "end_period")
    arriving = snapshots.where(F.col(period) == F.lit(run_period)).select(*keys, F.struct(*attrs).alias("_now"))

    now = F.lit(run_period).cast(scd.schema["end_period"].dataType)

    def row(state, start, end):
        return F.struct(*[state[a].alias(a) for a in attrs], start.alias("start_period"), end.alias("end_period"))

    old, new = F.col("_old"), F.col("_now")
    start, end = F.col("start_period"), F.col("end_period")
    rows = (
        F.when(new.isNull(), F.array(row(old, start, end)))
        .when(old.isNull(), F.array(row(new, now, now)))
        .when(old.eqNullSafe(new), F.array(row(old, start, now)))
        .otherwise(F.array(row(old, start, end), row(new, now, now)))
    )
    touched = current.join(arriving, keys, "full").select(*keys, F.inline(rows))
    return closed.unionByName(touched).withColumn("as_of", F.lit(run_period))


OPEN, CLOSED, KIND, AS_OF = "open", "closed", "kind", "as_of"


def open_rows(spark: SparkSession, table: str, period: int) -> DataFrame:
    """The open rows as of a period: one partition."""
    return spark.table(table).where((F.col(AS_OF) == F.lit(period)) & (F.col(KIND) == OPEN))


def scd2_run(
    spark: SparkSession,
    table: str,
    snapshots: DataFrame,
    key: str | Sequence[str],
    attrs: str | Sequence[str],
    period: str,
    run_period: int,
    path: str | None = None,
) -> DataFrame:
    """Bring an SCD table that keeps open and closed rows apart to ``run_period``, and return it as of that period.

    The table is partitioned by ``as_of`` and ``kind``: a period writes its open rows and the rows that it closed (changed
    or missing keys), and nothing else. It reads the open rows of the period before and the new snapshot rows, so a run costs the
    current keys, however long the history has grown; closed partitions are written once and never read again.
    A repeated run replaces what it wrote, a period that has no predecessor where there are earlier ones raises.
    """
    keys, attrs = names(key), names(attrs)
    schema = snapshots.select(*keys, *attrs, F.col(period).alias("start_period"), F.col(period).alias("end_period"), F.lit(0).alias(AS_OF)).schema
    if spark.catalog.tableExists(table):
        before = open_rows(spark, table, run_period - 1).drop(KIND)
        if before.isEmpty() and not spark.table(table).where(F.col(AS_OF) < F.lit(run_period)).isEmpty():
            raise ValueError(f"{table} holds earlier periods but none before {run_period}: run {run_period - 1} first")
    else:
        before = spark.createDataFrame([], schema)
    rows = scd2_incremental(before, snapshots, keys, attrs, period, run_period)
    kind = F.when(F.col("end_period") == F.lit(run_period), F.lit(OPEN)).otherwise(F.lit(CLOSED))
    rows = rows.withColumn(KIND, kind).select(*keys, *attrs, "start_period", "end_period", AS_OF, KIND)
    if not spark.catalog.tableExists(table):
        writer = rows.hint("rebalance", KIND).write.partitionBy(AS_OF, KIND).format("parquet")
        (writer if path is None else writer.option("path", path)).saveAsTable(table)
    else:
        _empty_period(spark, table, run_period)
        with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            rows.select(*spark.table(table).columns).hint("rebalance", KIND).write.mode("overwrite").insertInto(table)
    return scd2_as_of(spark, table, run_period)


def _empty_period(spark: SparkSession, table: str, period: int) -> None:
    """Remove what an earlier run of the period wrote: it may have closed rows where this one closes none."""
    written = spark.table(table)
    if written.where(F.col(AS_OF) == F.lit(period)).isEmpty():
        return
    nothing = f"nothing_{uuid.uuid4().hex}"
    spark.createDataFrame([], written.drop(AS_OF).schema).createTempView(nothing)
    try:
        with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
            spark.sql(f"insert overwrite table {table} partition (`{AS_OF}` = {int(period)}, `{KIND}`) select * from {nothing}")
    finally:
        spark.catalog.dropTempView(nothing)


def scd2_as_of(spark: SparkSession, table: str, period: int) -> DataFrame:
    """The SCD table as of any period that was run: its open rows and all rows closed by then."""
    rows = spark.table(table)
    open_now = (F.col(KIND) == OPEN) & (F.col(AS_OF) == F.lit(period))
    closed = (F.col(KIND) == CLOSED) & (F.col(AS_OF) <= F.lit(period))
    return rows.where(open_now | closed).drop(KIND).withColumn(AS_OF, F.lit(period))

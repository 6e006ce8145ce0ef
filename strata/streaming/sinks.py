"""Stream sinks that write every micro-batch once to one or more tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.functions.columns import names
from strata.sources import files
from strata.sources.tables import reused

BATCH_COL = "batch_id"
Sink = Callable[[DataFrame, int], None]
Undo = Callable[[int], None]


def parquet_sink(
    path: str, transform: Callable[[DataFrame], DataFrame] | None = None, partition_by: str | Sequence[str] = ()
) -> Sink:
    """Write each batch to its own ``batch_id=`` folder; a replayed batch replaces itself.

    ``partition_by`` names columns (an event date) by which the files of a batch are divided, so that
    readers prune them.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        out = rows if transform is None else transform(rows)
        out.write.mode("overwrite").partitionBy(*names(partition_by)).parquet(f"{path}/{BATCH_COL}={batch_id}")
    return write


def append_sink(path: str, label: str = "stream") -> Sink:
    """Append each batch to one Parquet folder, without a folder per batch, exactly once.

    A batch is written to a hidden folder first; its files are then renamed into the table under names made of the label
    and the batch id. A replayed batch removes what a failed attempt left under its names before it moves its
    own files, so every row is there once. Readers never see a half-written file; while a batch is being moved they may
    see part of it. Streams that share a folder need different labels.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        spark, hidden = rows.sparkSession, f"{path}/_arriving-{label}-{batch_id}"
        rows.write.mode("overwrite").parquet(hidden)
        for name in files.listed(spark, path, f"{label}-{batch_id}-*.parquet"):
            files.remove(spark, f"{path}/{name}")
        for n, name in enumerate(files.listed(spark, hidden, "*.parquet")):
            files.move(spark, f"{hidden}/{name}", f"{path}/{label}-{batch_id}-{n:05d}.parquet")
        files.remove(spark, hidden)
    return write


def format_sink(fmt: str, options: Mapping[str, str]) -> Sink:
    """Append each batch through any batch writer, such as ``kafka`` with ``to_kafka_json`` rows and its topic and servers.

    By itself at least once: a batch that is replayed after a failure is written again. ``once`` narrows that to a failure
    inside the write.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.format(fmt).options(**options).mode("append").save()
    return write


def jdbc_sink(url: str, table: str, properties: Mapping[str, str]) -> Sink:
    """Append each batch to a database table with its batch id.

    By itself at least once, see ``format_sink``; replayed rows have the same batch id, by which ``undo`` of ``once`` can delete them.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.withColumn(BATCH_COL, F.lit(batch_id)).write.jdbc(url, table, mode="append", properties=dict(properties))
    return write


def once(sink: Sink, ledger: str, label: str, undo: Undo | None = None) -> Sink:
    """A sink that skips the batches it has committed, by a ledger of empty files, ``<label>/<batch>.begun`` and ``.done``.

    Both marks are read before a batch is written; the first is set before, the second after the write. A batch that is replayed
    because a later sink failed is skipped. A batch that was begun and not done may be there in part: ``undo(batch_id)``
    removes what it left (rows of a batch id in a database, say) before it is written again, which makes the sink exactly
    once; without ``undo`` that one batch is written at least once. The ledger belongs to one stream: keep it next to its checkpoint.
    """
    def write(rows: DataFrame, batch_id: int) -> None:
        spark, mark = rows.sparkSession, f"{ledger}/{label}/{batch_id}"
        if files.exists(spark, f"{mark}.done"):
            return
        if undo is not None and files.exists(spark, f"{mark}.begun"):
            undo(batch_id)
        files.touch(spark, f"{mark}.begun")
        sink(rows, batch_id)
        files.touch(spark, f"{mark}.done")
    return write


def committed(spark: SparkSession, ledger: str, label: str) -> list[int]:
    """Ids of the batches that a sink has committed."""
    return sorted(int(name.removesuffix(".done")) for name in files.listed(spark, f"{ledger}/{label}", "*.done"))


def write_stream_table(
    df: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    available_now: bool = False,
    every: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Start a query that hands every micro-batch to all sinks, computing it once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        with reused(batch) if len(sinks) > 1 else nullcontext(batch) as rows:
            for sink in sinks:
                sink(rows, batch_id)

    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def read_sink(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """What a ``parquet_sink`` wrote so far, without the batch id. With a schema no file is opened to learn it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop(BATCH_COL)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the query's stateful operators dropped behind the watermark (after partial aggregation).

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` progress reports (100 by
    default). A longer run would be counted in part, and raises instead: set more of them, or
    use ``progress.ProgressTable``, which counts any number of reports and restarts.
    """
    kept = int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))
    if len(query.recentProgress) >= kept:
        raise RuntimeError(f"only the last {kept} progress reports are known; raise spark.sql.streaming.numRecentProgressUpdates")
    return sum(
        op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in progress["stateOperators"])

"""A table of what streams report: rows that arrived and rows that were dropped behind the watermark."""

from __future__ import annotations

import queue
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from strata.sources import files

# One row for each batch and stateful operator; ``arrived`` is the observed count, repeated for each operator.
REPORTS = "query_id string, run_id string, batch_id bigint, operator int, dropped bigint, arrived bigint"
ARRIVED = "strata_arrived"


def observed(df: DataFrame) -> DataFrame:
    """The same stream, whose rows are counted as they arrive, before any stateful operator; the count is in the reports."""
    return df.observe(ARRIVED, F.count(F.lit(1)).alias("n"))


class ProgressTable(StreamingQueryListener):
    """Appends every progress report to a Parquet table while streams run. Use it as a context around them.

    Unlike ``recentProgress``, which keeps the last hundred reports of a run in the driver's memory, the table has all of
    them, over any number of runs and restarts. Reports of idle triggers (nothing arrived, nothing dropped) are left
    out. A thread of its own writes, so that a slow write never holds up the streams' events; leaving the context waits until the
    reports of all runs that ended inside it are written.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._todo: queue.Queue = queue.Queue()
        self._ended: set[str] = set()
        self._news = threading.Condition()
        self._failed: list[BaseException] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        seen = p.observedMetrics.get(ARRIVED)
        arrived = seen["n"] if seen is not None else p.numInputRows
        dropped = [op.numRowsDroppedByWatermark for op in p.stateOperators] or [0]
        if arrived or any(dropped):
            self._todo.put([(str(p.id), str(p.runId), p.batchId, n, d, arrived) for n, d in enumerate(dropped)])

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        # comes after the last report of the run
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        self._writer = threading.Thread(target=self._write, daemon=True)
        self._writer.start()
        return self

    def __exit__(self, *_) -> None:
        self._todo.put(None)
        self._writer.join()
        self.spark.streams.removeListener(self)
        if self._failed:
            raise self._failed[0]

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait until all reports of a run that has ended have come in (Spark delivers them later than the run's end)."""
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of run {query.runId} was reported within {seconds} seconds")

    def _write(self) -> None:
        ended = False
        while not ended:
            rows, part = [], self._todo.get()
            while part is not None:
                rows += part
                try:
                    part = self._todo.get_nowait()
                except queue.Empty:
                    break
            ended = part is None
            try:
                if rows:
                    self.spark.createDataFrame(rows, REPORTS).coalesce(1).write.mode("append").parquet(self.path)
            except BaseException as error:  # raised again where the context is left
                self._failed.append(error)


def batch_reports(spark: SparkSession, path: str) -> DataFrame:
    """query_id, batch_id, arrived, dropped: one row for each batch, however often it was run.

    A batch that was replayed after a failure has the same rows again, so its reports are not added up.
    """
    if not files.exists(spark, path):
        return spark.createDataFrame([], "query_id string, batch_id bigint, arrived bigint, dropped bigint")
    reports = spark.read.schema(REPORTS).parquet(path)
    each = reports.groupBy("query_id", "batch_id", "operator").agg(F.max("arrived").alias("arrived"), F.max("dropped").alias("dropped"))
    return each.groupBy("query_id", "batch_id").agg(F.max("arrived").alias("arrived"), F.sum("dropped").alias("dropped"))


def open_rows(spark: SparkSession, checkpoint: str, count: str = "count") -> DataFrame:
    """Rows held in windows that are still open, in one row ``open``: the sum of a count in the state of a stream that has stopped.

    Reads the state that the last committed batch left in the checkpoint; ``count`` is the name of the count among the values.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return state.agg(F.coalesce(F.sum(F.col("value")[count]), F.lit(0)).alias("open"))


def late_rows(spark: SparkSession, reports: str, closed: DataFrame, hits: str, checkpoint: str, count: str = "count") -> DataFrame:
    """One row for a stream of windowed counts over all its runs: rows ``arrived``, ``counted`` in closed windows, ``open`` and ``dropped``.

    A row that arrived is in a window that was emitted, or in one that is open, or was dropped behind the watermark; Spark's own
    metric counts what is dropped after partial aggregation, so it depends on how rows fell into tasks. ``closed`` is what the stream
    has emitted, with ``hits`` rows a window.
    """
    # one row each: summed side by side, not joined
    parts = [
        batch_reports(spark, reports).agg(F.coalesce(F.sum("arrived"), F.lit(0)).alias("n")).select(F.lit("arrived").alias("what"), "n"),
        closed.agg(F.coalesce(F.sum(hits), F.lit(0)).alias("n")).select(F.lit("counted").alias("what"), "n"),
        open_rows(spark, checkpoint, count).select(F.lit("open").alias("what"), F.col("open").alias("n"))]
    of = lambda name: F.sum(F.when(F.col("what") == name, F.col("n")))
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2]).agg(of("arrived").alias("arrived"), of("counted").alias("counted"), of("open").alias("open"))
    return summed.withColumn("dropped", F.col("arrived") - F.col("counted") - F.col("open"))

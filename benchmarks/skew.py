"""Share of the largest task when one key holds a third of all rows.

Usage: python -m benchmarks.skew [rows]. Writes the made-up events once to a
scratch folder, runs the operators on them and reads Spark's event log: for each
query, the largest share of a stage's shuffled records that one task read, over
the stages that read at least a tenth as many records as there are events.
Adaptive thresholds are scaled down to the size of the data.
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile

from pyspark.sql import functions as F

from strata.operators import activity as act
from strata.operators import clean, experiment, graph, patterns
from strata.session import local_session
from strata.streaming.events import sessionize


def made_up(spark, rows: int, path: str):
    """A third of the rows belong to user 0 on one device kind; the others are spread over rows / 100 users."""
    n = F.col("id")
    hot = n % 3 == 0
    spark.range(rows).select(
        n.alias("event_id"),
        F.when(hot, 0).otherwise(1 + F.pmod(F.xxhash64(n), F.lit(rows // 100))).alias("user_id"),
        F.pmod(F.xxhash64(n, F.lit(1)), F.lit(rows // 20)).alias("device_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(n * 2_592_000 / rows).cast("decimal(18,6)"))).alias("ts"),
        F.element_at(F.array(*map(F.lit, ["/view", "/cart", "/purchase", "/signup"])), (F.pmod(F.xxhash64(n, F.lit(2)), F.lit(4)) + 1).cast("int")).alias("url"),
        F.pmod(F.xxhash64(n, F.lit(3)), F.lit(100)).cast("double").alias("value"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def queries(ev):
    arms = experiment.assign_arms(ev.select("user_id").distinct(), "user_id", "s")
    shown = experiment.exposures(ev, arms, "user_id", "ts", "url", "/signup", "x")
    dated = ev.withColumn("day", F.to_date("ts"))
    won = (F.col("value") > 50).cast("int")
    # user 0 does everything on one day
    one_day = ev.withColumn("ts", F.when(F.col("user_id") == 0, F.date_trunc("month", "ts").cast("timestamp_ntz") + (F.col("ts") - F.date_trunc("day", "ts").cast("timestamp_ntz"))).otherwise(F.col("ts")))
    members = ev.select(F.when(F.col("event_id") % 400 == 0, 0).otherwise(F.col("event_id")).alias("event"), "device_id", F.lit("t").alias("team"), "value")
    return {
        "dedupe_by_key": lambda: clean.dedupe_by_key(ev, "user_id", ["ts", "event_id"]),
        "daily_activity": lambda: act.daily_activity(ev, "user_id", "ts"),
        "host_activity": lambda: act.host_activity_backfill(ev.withColumn("host", F.col("user_id")), "host", "device_id", "ts", "2024-01-30"),
        "user_devices": lambda: act.user_devices(act.pair_activity(ev, "user_id", "device_id", "url"), "user_id", "device_id", 64),
        "funnel": lambda: patterns.funnel_conversion(one_day, "user_id", "ts", "url", "/purchase", most=50_000),
        "sessionize": lambda: sessionize(ev, "user_id", 300, "ts"),
        "best_stretch": lambda: patterns.best_stretch(dated.withColumn("win", won), "user_id", "day", "event_id", "win", 90, width=50_000),
        "longest_streak": lambda: patterns.longest_streak(dated, "user_id", "day", "event_id", F.col("value") > 10, width=50_000),
        "readout": lambda: experiment.experiment_readout(shown, ev.where("url = '/purchase'"), "user_id", "ts", "value", most=50_000),
        "cooccurrence": lambda: graph.cooccurrence_edges(
            members.withColumn("name", F.col("device_id")), "event", "device_id", "name", "team", "value", ["value"], most=500),
    }


def shares(log_dir: str, rows: int) -> dict[str, tuple[float, int]]:
    """Per job description: the largest task's share of a stage's shuffle records, and that task's records."""
    label, tasks = {}, {}
    for path in glob.glob(log_dir + "/**/events_*", recursive=True) + glob.glob(log_dir + "/local-*"):
        try:
            lines = open(path)
        except IsADirectoryError:
            continue
        for line in lines:
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for s in e["Stage IDs"]:
                    label[s] = e["Properties"].get("spark.job.description", "")
            elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                tasks.setdefault(e["Stage ID"], []).append(e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"])
    worst = {}
    for stage, read in tasks.items():
        total = sum(read)
        if total >= rows / 10 and label.get(stage):
            worst[label[stage]] = max(worst.get(label[stage], (0.0, 0)), (max(read) / total, max(read)))
    return worst


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(
        "strata-skew", 8, spark__eventLog__enabled="true", spark__eventLog__dir=scratch, spark__eventLog__rolling__enabled="false",
        spark__eventLog__compress="false",
        spark__sql__shuffle__partitions="64", spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="512KB", spark__sql__adaptive__skewJoin__skewedPartitionFactor="3",
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    ev = made_up(spark, rows, scratch + "/events")
    found = {}
    for name, run in queries(ev).items():
        spark.sparkContext.setJobDescription(name)
        run().write.format("noop").mode("overwrite").save()
    spark.stop()
    found = shares(scratch, rows)
    for name, (share, largest) in found.items():
        print(f"{name:18s} largest task read {share:6.1%} of its stage ({largest:,} records)")


if __name__ == "__main__":
    main()

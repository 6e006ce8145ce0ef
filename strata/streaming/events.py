"""Event streams: decoding, event time, tumbling counts, sessions, landing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.columns import names
from strata.operators.geo import geo_enrich
from strata.operators.guards import maybe_broadcast
from strata.sources import files

# The fields of the event messages, the text format of their
# event time and the watermark delay.
EVENT_SCHEMA = (
    "url string, referrer string, user_agent string, host string, ip string, "
    "headers string, geodata string, event_time string"
)
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
WATERMARK_DELAY = "15 seconds"

# Merge a key's sessions inside each map task before the shuffle, so that a hot
# key sends sessions instead of events. Set it when the query is started.
SESSION_STREAM_CONF = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def decode_json(df: DataFrame, schema: StructType | str = EVENT_SCHEMA, value: str = "value") -> DataFrame:
    """The fields of a JSON message column."""
    return df.select(F.from_json(F.col(value).cast("string"), schema).alias("_e")).select("_e.*")


def read_event_stream(
    spark: SparkSession, fmt: str, options: Mapping[str, str], schema: StructType | str = EVENT_SCHEMA, path: str | None = None,
    start: str | None = None, marks: str | None = None,
) -> DataFrame:
    """An event stream from Kafka (JSON values) or from files, from its beginning or from what comes after its start.

    ``start`` is "latest" (the default of Kafka) or "earliest" (that of files). Kafka keeps its position in the checkpoint. For files
    "latest" needs ``marks``, a folder of its own next to the checkpoint: the names of the files that exist when the stream is first
    made are stored there, and a restart reads the same list, so that files which came in between are not lost.
    """
    if start not in (None, "earliest", "latest"):
        raise ValueError("a stream starts at the earliest or the latest event")
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").option("startingOffsets", start or "latest").options(**options).load()
        return decode_json(raw, schema)
    reader = lambda of: of.format(fmt).options(**options) if fmt == "text" else of.format(fmt).schema(schema).options(**options)
    raw = reader(spark.readStream).load(path)
    if start == "latest":
        raw = _after(raw, _marked(spark, lambda: reader(spark.read).load(path), marks))
    return decode_json(raw, schema) if fmt == "text" else raw


_FILE = "_metadata.file_path"


def _marked(spark: SparkSession, there: Callable[[], DataFrame], marks: str | None) -> DataFrame:
    """Names of the files that were there when the stream was first made; stored by the first call, in one commit."""
    if marks is None:
        raise ValueError("the latest position of a file stream needs a place for its marks")
    if not files.exists(spark, f"{marks}/_SUCCESS"):
        there().select(F.col(_FILE).alias("_old")).distinct().write.mode("overwrite").parquet(marks)
    return spark.read.schema("_old string").parquet(marks)


def _after(raw: DataFrame, old: DataFrame) -> DataFrame:
    """The rows of files that are not marked."""
    return raw.select("*", F.col(_FILE).alias("_file")).join(maybe_broadcast(old), F.col("_file") == F.col("_old"), "left_anti").drop("_file")


def with_event_time(
    df: DataFrame, col: str = "event_time", fmt: str | None = EVENT_TIME_FORMAT,
    delay: str = WATERMARK_DELAY, name: str = "event_timestamp",
) -> DataFrame:
    """Event time from text (null if malformed) or from a timestamp column (``fmt=None``), with a watermark."""
    ts = F.col(col).cast("timestamp") if fmt is None else F.try_to_timestamp(F.col(col), F.lit(fmt))
    return df.withColumn(name, ts).withWatermark(name, delay)


def tumbling_counts(
    df: DataFrame, width: str, key: str | Sequence[str], ts: str = "event_timestamp", counted: str | None = None
) -> DataFrame:
    """Events per tumbling window and key: ``window_start``, keys, ``num_hits`` (non-null ``counted``, default first key).

    Counts are added up inside each task before the shuffle, on batches and streams.
    """
    keys = names(key)
    counts = df.groupBy(F.window(ts, width).alias("_w"), *keys).agg(F.count(counted or keys[0]).alias("num_hits"))
    return counts.select(F.col("_w.start").alias("window_start"), *keys, "num_hits")


def sessionize(df: DataFrame, key: str | Sequence[str], gap_seconds: int = 300, ts: str = "event_timestamp") -> DataFrame:
    """Sessions per key: ``session_start``, ``session_end`` (last event + gap), ``num_events``.

    A new session starts when more than the gap has passed since the last event.
    A stream needs a watermark and emits closed sessions (append mode). On a batch,
    events are first reduced to one row per key and gap-long time slot (two events
    of one slot are always in one session), so the session window of a key sorts at
    most one row per slot however many events the key has.
    """
    keys = names(key)
    if df.isStreaming:
        found = df.groupBy(*keys, F.session_window(ts, f"{gap_seconds} seconds").alias("_s")).agg(
            F.count(F.lit(1)).alias("num_events"))
        return found.select(*keys, F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"), "num_events")
    gap = gap_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    slots = df.where(F.col(ts).isNotNull()).groupBy(*keys, F.floor(micros / F.lit(gap)).alias("_slot")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_slot")
    idle = F.unix_micros(F.col("_first").cast("timestamp")) - F.unix_micros(F.lag("_last").over(w).cast("timestamp"))
    runs = slots.withColumn("_new", F.coalesce((idle > gap).cast("int"), F.lit(1))).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy(*keys, "_run").agg(
        F.min("_first").alias("session_start"),
        (F.max("_last") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
        F.sum("_n").alias("num_events"),
    ).drop("_run")


def session_summary(sessions: DataFrame, by: str | Sequence[str], hosts: str | None = None, host: str = "host") -> DataFrame:
    """Sessions, events and mean events per session; ``hosts`` is a regular expression the host must match."""
    rows = sessions if hosts is None else sessions.where(F.col(host).rlike(hosts))
    return rows.groupBy(*names(by)).agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("num_events").alias("events"),
        F.avg("num_events").alias("avg_events_per_session"))


def land_events(df: DataFrame, geo_ranges: DataFrame, prefix_bits: int = 16) -> DataFrame:
    """The landed event: ip, event_timestamp, referrer, host, url and the place of the ip."""
    kept = df.select("ip", "event_timestamp", "referrer", "host", "url")
    return geo_enrich(kept, "ip", geo_ranges, prefix_bits)


def to_kafka_json(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Rows as Kafka messages: ``key`` (the key columns joined by |) and ``value`` (JSON with nulls kept)."""
    return df.select(
        F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols]).alias("key"),
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))

"""Streaming queries: file streams over the driver's events, run to the end of the data.

Each returns its sink as a batch DataFrame. Streams keep timestamps with the
session's zone; results go back to plain timestamps.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata.functions.columns import number_ip
from strata.operators.geo import geo_enrich, geo_segments
from strata.plans import inputs as i
from strata.session import session_conf, shared_dir
from strata.streaming import events as ev
from strata.streaming import progress as pr
from strata.streaming import sinks as out


def _event_stream(spark, sf):
    """The events file as a stream of page views with event time and watermark."""
    raw = ev.read_event_stream(spark, "parquet", {"pathGlobFilter": "events.parquet"}, i.table(spark, sf, "events").schema, sf)
    return ev.with_event_time(_with_user_ip(i.web_columns(raw)), "event_time", None)


def _with_user_ip(web):
    """An address per user, so that an address has several events."""
    return web.withColumn("ip", number_ip(F.pmod(F.col("user_id") * F.lit(i.IP_FACTOR), F.lit(i.IP_SPACE))))


def _drain(df, checkpoint, sinks):
    """Run a stream to the end of its data."""
    query = out.write_stream_table(df, sinks, checkpoint, available_now=True)
    query.awaitTermination()
    return query


def _run(df, label, *transforms):
    """Drain a stream into one Parquet sink per transform (one plain sink without any) and read them back."""
    spark = df.sparkSession
    root = shared_dir(spark, label)
    transforms = transforms or (None,)
    paths = [f"{root}/out{n}" for n in range(len(transforms))]
    _drain(df, f"{root}/checkpoint", [out.parquet_sink(p, t) for p, t in zip(paths, transforms)])
    return [out.read_sink(spark, p) for p in paths]


def _plain(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _messages(spark, sf):
    """Events as the JSON messages of the topic, one per line."""
    web = i.web_with_ip(i.table(spark, sf, "events"))
    return web.select("event_id", "ip", F.date_format("event_time", ev.EVENT_TIME_FORMAT).alias("event_time"), "referrer", "host", "url")


def to_kafka_json(spark, sf):
    return ev.to_kafka_json(_messages(spark, sf), ["host", "event_id"])


def _message_stream(spark, sf):
    path = shared_dir(spark, "messages")
    ev.to_kafka_json(_messages(spark, sf), ["event_id"]).select("value").write.text(path)
    return ev.read_event_stream(spark, "text", {}, path=path)


def read_event_stream(spark, sf):
    """JSON messages decoded from a stream; the event time is still text."""
    (rows,) = _run(_message_stream(spark, sf).select("ip", "event_time", "referrer", "host", "url"), "decoded")
    return rows


def read_from_both_starts(spark, sf):
    """One topic read from its beginning and from its latest position, started when the first hosts' messages were there, over a restart."""
    root = shared_dir(spark, "starts")
    hosts = [F.col("host") == host for host in i.HOSTS]
    messages = _messages(spark, sf)
    for n, part in enumerate(hosts):
        ev.to_kafka_json(messages.where(part), ["event_id"]).select("value").write.mode("append").text(f"{root}/topic")
        for start in ("earliest", "latest"):
            stream = ev.read_event_stream(spark, "text", {}, path=f"{root}/topic", start=start, marks=f"{root}/marks")
            _drain(stream.select("ip", "host", "url"), f"{root}/checkpoint-{start}", [out.parquet_sink(f"{root}/{start}")])
    both = [out.read_sink(spark, f"{root}/{start}", "ip string, host string, url string, batch_id int").withColumn("start", F.lit(start)) for start in ("earliest", "latest")]
    return both[0].unionByName(both[1])


def with_event_time(spark, sf):
    """Event time parsed from text on the stream."""
    stream = ev.with_event_time(_message_stream(spark, sf))
    (rows,) = _run(stream.select("ip", "event_timestamp", "host", "url"), "event-time")
    return _plain(rows, "event_timestamp")


def write_stream_table(spark, sf):
    """One stream into two tables per micro-batch: all purchases, and hits per host, url and batch day."""
    stream = _event_stream(spark, sf).select("event_id", "event_timestamp", "host", "url")
    bought, hits = _run(
        stream, "two-tables", lambda b: b.where(F.col("url") == "/purchase"),
        lambda b: b.groupBy("host", "url", F.to_date("event_timestamp").alias("day")).agg(F.count(F.lit(1)).alias("hits")))
    bought = bought.groupBy("host").agg(F.count(F.lit(1)).alias("n")).select(F.lit("purchases").alias("sink"), "host", "n")
    hits = hits.groupBy("host").agg(F.sum("hits").alias("n")).select(F.lit("hits").alias("sink"), "host", "n")
    return bought.unionByName(hits)


def tumbling_counts(spark, sf):
    (rows,) = _run(ev.tumbling_counts(_event_stream(spark, sf), "5 minutes", ["host"]), "tumbling-host")
    return _plain(rows, "window_start")


def tumbling_counts_by_referrer(spark, sf):
    (rows,) = _run(ev.tumbling_counts(_event_stream(spark, sf), "5 minutes", ["host", "referrer"]), "tumbling-referrer")
    return _plain(rows, "window_start")


def _batch_sessions(spark, sf, key):
    web = _with_user_ip(i.web_events(spark, sf))
    return ev.sessionize(web, key, 300, "event_time")


def sessionize(spark, sf):
    return _batch_sessions(spark, sf, ["ip", "host"])


def sessionize_host(spark, sf):
    return _batch_sessions(spark, sf, "host")


def sessionize_stream(spark, sf):
    with session_conf(spark, ev.SESSION_STREAM_CONF):
        (rows,) = _run(ev.sessionize(_event_stream(spark, sf), ["host"], 300), "sessions")
    return _plain(rows, "session_start", "session_end")


def session_summary(spark, sf):
    return ev.session_summary(sessionize_host(spark, sf), "host")


def session_summary_hosts(spark, sf):
    return ev.session_summary(sessionize(spark, sf), "host", hosts=r"\.alpha\.example$")


def geo_enrich_batch(spark, sf):
    web = i.web_with_ip(i.table(spark, sf, "events")).select("event_id", "ip")
    return geo_enrich(web, "ip", i.geo_ranges(spark, sf), i.GEO_PREFIX_BITS)


def land_events(spark, sf):
    """The landing job: decoded messages, event time, place of the address; the files of a batch are divided by event date."""
    root = shared_dir(spark, "processed-events")
    geo_segments(i.geo_ranges(spark, sf), i.GEO_PREFIX_BITS).write.parquet(f"{root}/segments")
    stream = ev.land_events(ev.with_event_time(_message_stream(spark, sf)), spark.read.parquet(f"{root}/segments"), i.GEO_PREFIX_BITS)
    dated = out.parquet_sink(f"{root}/out", lambda rows: rows.withColumn("event_date", F.to_date("event_timestamp")), "event_date")
    _drain(stream, f"{root}/checkpoint", [dated])
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema.fields)
    landed = out.read_sink(spark, f"{root}/out", f"{kind}, event_date date, batch_id int")
    return _plain(landed.drop("event_date"), "event_timestamp")


# Arrival: days up to ON_TIME_1, the rest, then error events of the first days, long after their windows closed.
ON_TIME_1, LATE_UNTIL = "2024-01-16", "2024-01-11"


def _late_stream(spark, sf, root, progress=None):
    """Three restarts of one stream of counts from its checkpoint, each with another arrival; the emitted windows."""
    source = i.table(spark, sf, "events")
    late = (F.col("event_type") == "error") & (F.col("ts") < F.lit(LATE_UNTIL).cast("timestamp_ntz"))
    first = F.col("ts") < F.lit(ON_TIME_1).cast("timestamp_ntz")
    for arriving in (first & ~late, ~first, late):
        source.where(arriving).write.mode("append").parquet(f"{root}/in")
        raw = ev.read_event_stream(spark, "parquet", {}, source.schema, f"{root}/in")
        web = i.web_columns(raw)
        stream = ev.with_event_time(web if progress is None else pr.observed(web), "event_time", None)
        query = _drain(ev.tumbling_counts(stream, "5 minutes", ["host"]), f"{root}/checkpoint", [out.parquet_sink(f"{root}/out")])
        if progress is not None:
            progress.wait(query)
    return out.read_sink(spark, f"{root}/out")


def late_drop(spark, sf):
    """Rows of closed windows are dropped, over three restarts of one stream from its checkpoint."""
    return _plain(_late_stream(spark, sf, shared_dir(spark, "late")), "window_start")


def late_drop_counted(spark, sf):
    """The same windows next to a row that says how many rows were dropped, complete over the three runs, and how many are still open."""
    root = shared_dir(spark, "late-counted")
    with pr.ProgressTable(spark, f"{root}/progress") as progress:
        windows = _late_stream(spark, sf, root, progress)
    total = pr.late_rows(spark, f"{root}/progress", windows, "num_hits", f"{root}/checkpoint")
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("window_start", "timestamp"), ("host", "string"), ("num_hits", "bigint"))]
    counts = [F.lit(None).cast("bigint").alias(c) for c in ("arrived", "open", "dropped")]
    both = windows.select(F.lit("window").alias("kind"), "window_start", "host", "num_hits", *counts).unionByName(
        total.select(F.lit("total").alias("kind"), *none[:2], F.col("counted").alias("num_hits"), "arrived", "open", "dropped"))
    return _plain(both, "window_start")


def append_once(spark, sf):
    """A stream into two append-only tables that fails between them and is started again: every row is in each once."""
    root = shared_dir(spark, "append-once")
    stream = _event_stream(spark, sf).select("event_id", "host", "url", F.to_date("event_timestamp").alias("day"))
    failing = [True]

    def fails_once(rows, batch_id):
        if failing.pop() if failing else False:
            raise RuntimeError("a sink fails after another one has written")

    sinks = [
        out.once(out.format_sink("json", {"path": f"{root}/messages"}), f"{root}/ledger", "messages"),
        out.append_sink(f"{root}/rows"), fails_once]
    for _ in range(2):
        try:
            _drain(stream, f"{root}/checkpoint", sinks)
        except StreamingQueryException:
            continue
    messages = spark.read.schema(stream.schema).json(f"{root}/messages").select(F.lit("messages").alias("sink"), "event_id", "host", "url", "day")
    return messages.unionByName(spark.read.schema(stream.schema).parquet(f"{root}/rows").withColumn("sink", F.lit("rows")))


QUERIES = {
    "to_kafka_json": to_kafka_json,
    "read_event_stream": read_event_stream,
    "read_from_both_starts": read_from_both_starts,
    "with_event_time": with_event_time,
    "write_stream_table": write_stream_table,
    "tumbling_counts": tumbling_counts,
    "tumbling_counts_by_referrer": tumbling_counts_by_referrer,
    "sessionize": sessionize,
    "sessionize_host": sessionize_host,
    "sessionize_stream": sessionize_stream,
    "session_summary": session_summary,
    "session_summary_hosts": session_summary_hosts,
    "geo_enrich": geo_enrich_batch,
    "land_events": land_events,
    "late_drop": late_drop,
    "late_drop_counted": late_drop_counted,
    "append_once": append_once,
}

_MESSAGES = f"""{i.WEB}, msg as (
  select event_id, {i.DOTTED_SQL} as ip, {i.IP_SQL} as ip_no, date_trunc('milliseconds', event_time) as event_timestamp,
         strftime(date_trunc('milliseconds', event_time), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' as event_time, referrer, host, url from web)"""
_DOTTED_USER = i.DOTTED_SQL.replace("event_id", "user_id")
_CLOSED = "(select max(event_time) from web) - interval 15 seconds"
_TUMBLE = f"""select * from (
    select time_bucket(interval 5 minutes, event_time) as window_start, {{key}}, count(host) as num_hits from {{src}} group by all)
  where window_start + interval 5 minutes <= {_CLOSED}"""
_SESSIONS = """marked as (select *, case when event_time - lag(event_time) over w <= interval 5 minutes then 0 else 1 end as fresh
  from v window w as (partition by {key} order by event_time)),
numbered as (select *, sum(fresh) over (partition by {key} order by event_time rows unbounded preceding) as run from marked),
sessions as (select {key}, min(event_time) as session_start, max(event_time) + interval 5 minutes as session_end, count(*) as num_events
  from numbered group by {key}, run)"""
_BY_IP = f"with {i.WEB}, v as (select *, {_DOTTED_USER} as ip from web), " + _SESSIONS.format(key="ip, host")
_BY_HOST = f"with {i.WEB}, v as (select * from web), " + _SESSIONS.format(key="host")
_SUMMARY = "select host, count(*) as sessions, cast(sum(num_events) as bigint) as events, avg(num_events) as avg_events_per_session from sessions"
_PLACED = f"""{i.GEO}, hit as (
  select m.event_id, arg_min('{{"country":"' || r.country || '","state":"' || r.state || '","city":"' || r.city || '"}}', r.hi - r.lo) as geodata
  from msg m join ranges r on m.ip_no between r.lo and r.hi group by m.event_id)"""

ORACLES = {
    "to_kafka_json": f"""with {_MESSAGES} select host || '|' || event_id as key,
        cast(json_object('event_id', event_id, 'ip', ip, 'event_time', event_time, 'referrer', referrer, 'host', host, 'url', url) as varchar) as value from msg""",
    "read_event_stream": f"with {_MESSAGES} select ip, event_time, referrer, host, url from msg",
    "read_from_both_starts": f"""with {_MESSAGES} select ip, host, url, start from msg, (values ('earliest'), ('latest')) as s(start)
        where start = 'earliest' or host <> '{i.HOSTS[0]}'""",
    "with_event_time": f"with {_MESSAGES} select ip, event_timestamp, host, url from msg",
    "write_stream_table": f"""with {i.WEB} select 'purchases' as sink, host, count(*) as n from web where url = '/purchase' group by host
        union all select 'hits', host, count(*) from web group by host""",
    "tumbling_counts": f"with {i.WEB} " + _TUMBLE.format(key="host", src="web"),
    "tumbling_counts_by_referrer": f"with {i.WEB} " + _TUMBLE.format(key="host, referrer", src="web"),
    "sessionize": f"{_BY_IP} select * from sessions",
    "sessionize_host": f"{_BY_HOST} select * from sessions",
    "sessionize_stream": f"{_BY_HOST} select * from sessions where session_end <= {_CLOSED}",
    "session_summary": f"{_BY_HOST} {_SUMMARY} group by host",
    "session_summary_hosts": f"{_BY_IP} {_SUMMARY} where host like '%.alpha.example' group by host",
    "geo_enrich": f"""with {_MESSAGES}, {_PLACED} select m.event_id, m.ip, coalesce(h.geodata, '{{}}') as geodata
        from msg m left join hit h on h.event_id = m.event_id""",
    "land_events": f"""with {_MESSAGES}, {_PLACED} select m.ip, m.event_timestamp, m.referrer, m.host, m.url, coalesce(h.geodata, '{{}}') as geodata
        from msg m left join hit h on h.event_id = m.event_id""",
    "late_drop": f"with {i.WEB}, kept as (select * from web where not (url = '/error' and event_time < timestamp '{LATE_UNTIL}')) "
                 + _TUMBLE.format(key="host", src="kept"),
    "late_drop_counted": f"""with {i.WEB}, marked as (select *, url = '/error' and event_time < timestamp '{LATE_UNTIL}' as late from web),
        kept as (select * from marked where not late),
        closed as ({_TUMBLE.format(key="host", src="kept")})
        select 'window' as kind, window_start, host, num_hits, cast(null as bigint) as arrived, cast(null as bigint) as open, cast(null as bigint) as dropped from closed
        union all select 'total', null, null, (select cast(sum(num_hits) as bigint) from closed), count(*),
               cast(count(*) filter (where not late) - (select sum(num_hits) from closed) as bigint), count(*) filter (where late) from marked""",
    "append_once": f"""with {i.WEB} select sink, event_id, host, url, cast(event_time as date) as day from web, (values ('messages'), ('rows')) as s(sink)""",
}

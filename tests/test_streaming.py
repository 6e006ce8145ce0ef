import datetime as dt
import json
import random
import uuid

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from strata.session import session_conf
from strata.streaming import events as ev
from strata.streaming import progress, sinks

BASE = dt.datetime(2024, 1, 1, 12)
SCHEMA = "host string, ts timestamp"


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def batch(spark, data):
    return spark.createDataFrame([(h, at(s)) for h, s in data], SCHEMA)


def drain(df, checkpoint, *targets):
    query = sinks.write_stream_table(df, [sinks.parquet_sink(str(t)) for t in targets], str(checkpoint), available_now=True)
    query.awaitTermination()
    return query


def source(spark, path):
    return ev.with_event_time(ev.read_event_stream(spark, "parquet", {}, SCHEMA, str(path)), "ts", None)


def test_event_time_text(spark):
    df = spark.createDataFrame([("2023-01-02T03:04:05.678Z",), ("2023-01-02 03:04",), (None,)], "event_time string")
    got = [r["event_timestamp"] for r in ev.with_event_time(df).collect()]
    assert got == [dt.datetime(2023, 1, 2, 3, 4, 5, 678000), None, None]


def test_json_both_ways(spark):
    df = spark.createDataFrame([("h", None, "1.2.3.4")], "host string, referrer string, ip string")
    (m,) = ev.to_kafka_json(df, ["host", "ip"]).collect()
    assert (m["key"], m["value"]) == ("h|1.2.3.4", '{"host":"h","referrer":null,"ip":"1.2.3.4"}')
    back = ev.decode_json(ev.to_kafka_json(df, ["host"]).withColumn("value", F.col("value").cast("binary"))).first()
    assert (back["host"], back["referrer"], back["ip"], back["url"]) == ("h", None, "1.2.3.4", None)


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    """The stream restarts from its checkpoint for each arrival; rows of closed windows are dropped."""
    checkpoint, out, inbox = tmp_path / "c", tmp_path / "out", tmp_path / "in"
    dropped = 0
    for arrival in ([("a", 0), ("a", 10)], [("a", 1000)], [("a", 20), ("a", 1010)], [("a", 2000)]):
        batch(spark, arrival).write.mode("append").parquet(str(inbox))
        query = drain(ev.tumbling_counts(source(spark, inbox), "5 minutes", "host"), checkpoint, out)
        dropped += sinks.dropped_rows(query)
    assert rows(sinks.read_sink(spark, str(out))) == [(at(0), "a", 2), (at(900), "a", 2)]
    assert dropped == 1


def test_two_sinks_and_replay(spark, tmp_path):
    batch(spark, [("a", 0), ("b", 1)]).write.parquet(str(tmp_path / "in"))
    drain(source(spark, tmp_path / "in").select("host"), tmp_path / "c", tmp_path / "x", tmp_path / "y")
    assert rows(sinks.read_sink(spark, str(tmp_path / "x"))) == rows(sinks.read_sink(spark, str(tmp_path / "y"))) == [("a",), ("b",)]
    sink = sinks.parquet_sink(str(tmp_path / "z"))
    for _ in range(2):  # the same batch handed over twice
        sink(spark.range(3), 0)
    assert sinks.read_sink(spark, str(tmp_path / "z")).count() == 3


def sessions(spark, data, gap=300):
    return ev.sessionize(batch(spark, data), "host", gap, "ts")


def test_session_gap_edges(spark):
    got = rows(sessions(spark, [("a", 0), ("a", 300), ("a", 600.5), ("b", 10)]))
    assert got == [("a", at(0), at(600), 2), ("a", at(600.5), at(900.5), 1), ("b", at(10), at(310), 1)]


def test_sessions_equal_session_window(spark, tmp_path):
    """Slot-wise batch sessions equal Spark's session window; the stream yields the closed ones."""
    rnd = random.Random(5)
    data = [(rnd.choice("ab"), round(rnd.uniform(0, 40_000), 3)) for _ in range(250)]
    mine = sessions(spark, data)
    df = batch(spark, data)
    theirs = df.groupBy("host", F.session_window("ts", "300 seconds").alias("w")).agg(F.count(F.lit(1)).alias("n")).select("host", "w.start", "w.end", "n")
    assert rows(mine) == rows(theirs)
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    with session_conf(spark, ev.SESSION_STREAM_CONF):
        drain(ev.sessionize(source(spark, tmp_path / "in"), "host", 300), tmp_path / "c", tmp_path / "out")
    closed = mine.where(F.col("session_end") <= at(max(s for _, s in data) - 15))
    assert rows(sinks.read_sink(spark, str(tmp_path / "out"))) == rows(closed)


def test_session_summary(spark):
    got = rows(ev.session_summary(sessions(spark, [("x.a", 0), ("x.a", 1), ("x.a", 1000), ("y.b", 0)]), "host"))
    assert got == [("x.a", 2, 3, 1.5), ("y.b", 1, 1, 1.0)]
    assert rows(ev.session_summary(sessions(spark, [("x.a", 0), ("y.b", 0)]), "host", hosts=r"\.a$")) == [("x.a", 1, 1, 1.0)]


def test_sinks_by_date_and_format(spark, tmp_path):
    rows_in = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")], "id int, day string")
    dated = sinks.parquet_sink(str(tmp_path / "dated"), partition_by="day")
    for _ in range(2):  # a replayed batch replaces itself
        dated(rows_in, 0)
    back = sinks.read_sink(spark, str(tmp_path / "dated"), "id int, day string, batch_id int")
    assert rows(back) == rows(rows_in)
    assert (tmp_path / "dated" / "batch_id=0" / "day=2024-01-02").is_dir()
    sinks.format_sink("json", {"path": str(tmp_path / "json")})(rows_in, 0)
    assert rows(spark.read.schema("id int, day string").json(str(tmp_path / "json"))) == rows(rows_in)


def test_dropped_rows_refuse_a_cut_history(spark):
    class Query:
        recentProgress = [{"stateOperators": [{"numRowsDroppedByWatermark": 2}]}] * 99

    assert sinks.dropped_rows(Query()) == 198
    Query.recentProgress = Query.recentProgress + Query.recentProgress[:1]
    with pytest.raises(RuntimeError, match="numRecentProgressUpdates"):
        sinks.dropped_rows(Query())


def test_every_dropped_row_is_counted_over_restarts(spark, tmp_path):
    """Arrivals, emitted, open and dropped rows add up, whatever Spark keeps of its progress reports; a replayed batch counts once."""
    checkpoint, out, inbox, log = (str(tmp_path / n) for n in ("c", "out", "in", "log"))
    # the second row of a dropped window would be lost to a count after partial aggregation
    arrivals = ([("a", 0), ("a", 10)], [("a", 1000)], [("a", 20), ("a", 21), ("b", 22), ("a", 1010)], [("a", 2000)])
    with session_conf(spark, {"spark.sql.streaming.numRecentProgressUpdates": "1"}), progress.ProgressTable(spark, log) as table:
        for arrival in arrivals:
            batch(spark, arrival).coalesce(1).write.mode("append").parquet(inbox)
            stream = ev.with_event_time(progress.observed(ev.read_event_stream(spark, "parquet", {}, SCHEMA, inbox)), "ts", None)
            table.wait(drain(ev.tumbling_counts(stream, "5 minutes", "host"), checkpoint, out))
    closed = sinks.read_sink(spark, out)
    assert rows(closed) == [(at(0), "a", 2), (at(900), "a", 2)]
    assert progress.late_rows(spark, log, closed, "num_hits", checkpoint).first().asDict() == {"arrived": 8, "counted": 4, "open": 1, "dropped": 3}
    assert progress.batch_reports(spark, log).agg(F.sum("arrived"), F.sum("dropped")).first() == (8, 2)
    again = spark.read.schema(progress.REPORTS).parquet(log).withColumn("run_id", F.lit("replay")).collect()
    spark.createDataFrame(again, progress.REPORTS).write.mode("append").parquet(log)
    assert progress.late_rows(spark, log, closed, "num_hits", checkpoint).first()["dropped"] == 3


def test_reports_of_nothing(spark, tmp_path):
    with progress.ProgressTable(spark, str(tmp_path / "log")):
        pass
    assert progress.batch_reports(spark, str(tmp_path / "log")).count() == 0


def test_sinks_write_once_when_a_later_sink_fails(spark, tmp_path):
    """A batch that fails between two sinks is replayed; each row is in each table once, without batch folders."""
    inbox, log = str(tmp_path / "in"), str(tmp_path / "ledger")
    batch(spark, [("a", 0), ("b", 1)]).write.parquet(inbox)
    fails = [True, False, True, False]

    def failing(rows_, batch_id):
        if fails.pop(0):
            raise RuntimeError("between two sinks")

    targets = [
        sinks.once(sinks.format_sink("json", {"path": str(tmp_path / "json")}), log, "json"), sinks.append_sink(str(tmp_path / "rows"), "s"), failing]
    stream = source(spark, inbox).select("host")
    for n in range(4):
        if n == 2:
            batch(spark, [("c", 2)]).write.mode("append").parquet(inbox)
        try:
            sinks.write_stream_table(stream, targets, str(tmp_path / "c"), available_now=True).awaitTermination()
        except StreamingQueryException as error:
            assert n in (0, 2) and "between two sinks" in str(error)
    want = [("a",), ("b",), ("c",)]
    assert rows(spark.read.schema("host string").json(str(tmp_path / "json"))) == want
    assert rows(spark.read.schema("host string").parquet(str(tmp_path / "rows"))) == want
    assert not any(p.is_dir() for p in (tmp_path / "rows").iterdir())
    assert sinks.committed(spark, log, "json") == [0, 1] and sinks.committed(spark, log, "other") == []


def test_a_half_written_batch_is_undone(spark, tmp_path):
    """A batch that failed inside its write is taken back by its id before it is written again."""
    held, attempts = [], [True]

    def partial(rows_, batch_id):
        held.extend((batch_id, r["id"]) for r in rows_.limit(2).collect())
        if attempts:
            attempts.pop()
            raise RuntimeError("inside the write")
        held.append((batch_id, "rest"))

    def undo(batch_id):
        held[:] = [h for h in held if h[0] != batch_id]

    sink = sinks.once(partial, str(tmp_path / "ledger"), "db", undo)
    with pytest.raises(RuntimeError):
        sink(spark.range(3), 7)
    for _ in range(2):
        sink(spark.range(3), 7)
    assert [h[1] for h in held] == [0, 1, "rest"]
    # and files left by a failed move are replaced under the names of their batch
    table = tmp_path / "rows"
    append = sinks.append_sink(str(table), "s")
    append(spark.range(3), 0)
    append(spark.range(4).coalesce(1), 1)
    append(spark.range(5).repartition(3), 1)
    assert spark.read.parquet(str(table)).count() == 8


def test_latest_start_skips_what_was_there(spark, tmp_path):
    """A stream from the latest position takes files that come after it was first made, over restarts; the earliest takes all."""
    inbox, marks = str(tmp_path / "in"), str(tmp_path / "marks")
    got = {}
    for n, host in enumerate("abc"):
        batch(spark, [(host, n)]).write.mode("append").parquet(inbox)
        for start in ("earliest", "latest"):
            stream = ev.read_event_stream(spark, "parquet", {}, SCHEMA, inbox, start=start, marks=marks)
            assert stream.columns == ["host", "ts"]
            drain(stream, tmp_path / f"c-{start}", tmp_path / start)
            got[start] = rows(sinks.read_sink(spark, str(tmp_path / start), f"{SCHEMA}, batch_id int").select("host"))
        assert got == {"earliest": [(h,) for h in "abc"[:n + 1]], "latest": [(h,) for h in "bc"[:n]]}
    with pytest.raises(ValueError, match="marks"):
        ev.read_event_stream(spark, "parquet", {}, SCHEMA, inbox, start="latest")
    with pytest.raises(ValueError, match="earliest or the latest"):
        ev.read_event_stream(spark, "parquet", {}, SCHEMA, inbox, start="yesterday")


def stub_topic():
    """A data source that takes messages as a broker would: needs a topic, keys and values as text; keeps what each task sent."""
    class Writer(DataSourceWriter):
        def __init__(self, options):
            self.path, self.topic = options["path"], options["topic"]

        def write(self, iterator):
            sent = [(self.topic, r["key"], r["value"]) for r in iterator]
            with open(f"{self.path}/{uuid.uuid4().hex}.json", "w") as f:
                json.dump(sent, f)
            return WriterCommitMessage()

    class Topic(DataSource):
        @classmethod
        def name(cls):
            return "stub_topic"

        def writer(self, schema, overwrite):
            assert schema.fieldNames() == ["key", "value"] and not overwrite
            return Writer(self.options)

    return Topic


def test_messages_are_published(spark, tmp_path):
    """JSON messages of a stream go through the format sink to a topic, once although the stream is started twice."""
    (tmp_path / "topic").mkdir()
    spark.dataSource.register(stub_topic())
    batch(spark, [("a", 0), ("b", 1), ("b", 2)]).write.parquet(str(tmp_path / "in"))
    publish = sinks.format_sink("stub_topic", {"path": str(tmp_path / "topic"), "topic": "events"})
    once = sinks.once(lambda rows_, batch_id: publish(ev.to_kafka_json(rows_, ["host"]), batch_id), str(tmp_path / "ledger"), "events")
    for n in range(2):
        # a new checkpoint replays the first batch
        sinks.write_stream_table(source(spark, tmp_path / "in").select("host"), [once], str(tmp_path / f"c{n}"), available_now=True).awaitTermination()
    sent = sorted(tuple(m) for f in (tmp_path / "topic").glob("*.json") for m in json.loads(f.read_text()))
    assert sent == [("events", "a", '{"host":"a"}'), ("events", "b", '{"host":"b"}'), ("events", "b", '{"host":"b"}')]

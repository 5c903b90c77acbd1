"""Sinks (print, upsert/retract, side outputs) and the Kafka source surface."""

import time

from pyspark.sql import functions as F

from eventflow.operators.caps import split_outputs
from eventflow.sources import kafka
from eventflow.sources.sinks import append_sink, print_sink, read_upserts, side_output_sink, upsert_sink
from eventflow.sources.tables import table
from eventflow.sources.text import USER_BEHAVIOR, format_delimited, parse_delimited, read_lines
from eventflow.streaming.runner import checkpoint_for
from eventflow.streaming.windows import stream_windowed_count

from base_rows import SF_SMALL


def _events_stream(spark, tmp_path):
    d = str(tmp_path / "ev")
    ev = table(spark, SF_SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    ev.write.parquet(d)
    return ev, spark.readStream.schema(ev.schema).parquet(d)


def test_upsert_sink_keeps_latest_per_key(spark, tmp_path):
    ev, s = _events_stream(spark, tmp_path)
    counts = stream_windowed_count(s, ["event_type"], "ts", "1 day")
    out = str(tmp_path / "upserts")
    q = upsert_sink(counts.withColumn("count", F.col("count")), out, checkpoint_for(spark, "ups"), "update")
    q.processAllAvailable()
    q.stop()
    cur = read_upserts(spark, out, ["event_type", "window_end"])
    want = ev.groupBy("event_type", F.window("ts", "1 day").alias("w")).count()
    assert cur.count() == want.count()
    assert cur.agg(F.sum("count")).first()[0] == ev.count()


def test_side_outputs_split_by_tag(spark, tmp_path):
    ev, s = _events_stream(spark, tmp_path)
    tagged = s.select("event_id", F.when(F.col("event_type") == "error", "blacklist").otherwise("pass").alias("verdict"))
    out = str(tmp_path / "side")
    q = side_output_sink(tagged, "verdict", ["pass", "blacklist"], out, checkpoint_for(spark, "side"))
    q.processAllAvailable()
    q.stop()
    n_err = ev.filter("event_type = 'error'").count()
    assert spark.read.parquet(f"{out}/blacklist").count() == n_err
    assert spark.read.parquet(f"{out}/pass").count() == ev.count() - n_err
    parts = split_outputs(ev.select(F.lit("pass").alias("verdict")), ["pass", "blacklist"])
    assert parts["pass"].count() == ev.count() and parts["blacklist"].count() == 0


def test_print_sink_memory(spark, tmp_path):
    _, s = _events_stream(spark, tmp_path)
    q = print_sink(s.select("event_id"), "labelled_events", checkpoint_for(spark, "print"), fmt="memory")
    q.processAllAvailable()
    q.stop()
    assert spark.table("labelled_events").count() > 0


def test_kafka_surface_and_line_roundtrip(spark):
    opts = kafka.source_options("broker:9092")
    assert opts["subscribe"] == "user-behaviors" and opts["startingOffsets"] == "latest"
    assert opts["kafka.group.id"] == "consumer-group"
    assert isinstance(kafka.connector_available(spark), bool)
    rows = spark.createDataFrame([(1, 2, 3, "pv", 1511658000)], "u long, i long, c int, b string, t long")
    lines = format_delimited(rows, ["u", "i", "c", "b", "t"])
    back = parse_delimited(lines, USER_BEHAVIOR).first()
    assert (back.user_id, back.item_id, back.category_id, back.behavior, back.ts_sec) == (1, 2, 3, "pv", 1511658000)


def test_append_sink_writes_closed_windows_once(spark, tmp_path):
    ev, s = _events_stream(spark, tmp_path)
    counts = stream_windowed_count(s, ["event_type"], "ts", "1 day")
    out = str(tmp_path / "closed")
    q = append_sink(counts, out, checkpoint_for(spark, f"append-{tmp_path.name}"))
    q.processAllAvailable()
    q.stop()
    got = {(r.event_type, r.window_end): r["count"] for r in spark.read.parquet(out).collect()}
    last = ev.agg(F.max("ts")).first()[0]
    want = {(r.event_type, int(r.w.end.timestamp() * 1000)): r["count"]
            for r in ev.groupBy("event_type", F.window("ts", "1 day").alias("w")).count().collect() if r.w.end <= last}
    assert got == want


def test_read_lines_batch_and_stream(spark, tmp_path):
    src = tmp_path / "lines"
    src.mkdir()
    (src / "a.txt").write_text("1,2,3,pv,10\n\n4,5,6,buy,20")
    assert [r.value for r in read_lines(spark, str(src)).collect()] == ["1,2,3,pv,10", "", "4,5,6,buy,20"]
    from eventflow.streaming.runner import run_available

    got = run_available(read_lines(spark, str(src), streaming=True, max_files_per_trigger=1), f"lines_{abs(hash(tmp_path))}")
    assert sorted(r.value for r in got.collect()) == ["", "1,2,3,pv,10", "4,5,6,buy,20"]


def test_side_outputs_by_given_tags(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "verdict string")
    parts = split_outputs(df, ["a", "b"], rest="other")
    assert {k: v.count() for k, v in parts.items()} == {"a": 1, "b": 1, "other": 2}

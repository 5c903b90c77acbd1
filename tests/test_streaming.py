"""Streaming forms agree with the batch operators on everything the final watermark has closed."""

import itertools
import time

import pytest
from pyspark.sql import functions as F

from eventflow.operators.caps import click_cap
from eventflow.operators.distinct import unique_visitors
from eventflow.operators.joins import reconcile
from eventflow.operators.patterns import match_followed_by, match_next
from eventflow.operators.ranking import top_n
from eventflow.operators.windows import windowed_count
from eventflow.sources.tables import (ad_clicks, login_events, order_events, streaming_tables, table,
                                      user_behavior)
from eventflow.streaming.joins import stream_followed_by, stream_reconcile
from eventflow.streaming.runner import run_available
from eventflow.streaming.state import stream_click_cap, stream_match_next
from eventflow.streaming.windows import (stream_sliding_count, stream_unique_visitors, stream_windowed_count,
                                         top_n_writer)

from base_rows import SF_SMALL

_n = itertools.count()


@pytest.fixture(scope="module")
def stream_dir(spark, tmp_path_factory):
    """events of sf0.001 as four files in time order (one micro-batch each)."""
    d = str(tmp_path_factory.mktemp("events_stream"))
    ev = table(spark, SF_SMALL, "events")
    bounds = ev.select(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [0.25, 0.5, 0.75])).first()[0]
    edges = [None, *bounds, None]
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    for lo, hi in zip(edges, edges[1:]):
        part = ev
        if lo is not None:
            part = part.filter(t > lo)
        if hi is not None:
            part = part.filter(t <= hi)
        part.coalesce(1).write.mode("append").parquet(d)
        time.sleep(1.1)  # the file source orders files by modification time
    return d, None


def _wm_ms(df, ts="ts"):
    """Final watermark (delay 0) of a stream = max event time of the rows that reach the watermark."""
    return df.select(F.max(F.unix_millis(ts))).first()[0]


def _stream(stream_dir):
    return streaming_tables(("events",), max_files_per_trigger=1, paths={"events": stream_dir[0]})


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_tumbling_and_sliding_counts(spark, stream_dir):
    batch = user_behavior(spark, SF_SMALL, "pv")
    with _stream(stream_dir):
        s = user_behavior(spark, SF_SMALL, "pv")
    wm_ms = _wm_ms(batch)
    got = run_available(stream_windowed_count(s, ["item_id"], "ts", "1 hour"), f"tumble{next(_n)}")
    want = windowed_count(batch, ["item_id"], "ts", "1 hour").filter(F.col("window_end") <= wm_ms)
    cols = ["item_id", "window_end", "count"]
    assert _rows(got, cols) == _rows(want, cols)
    got = run_available(stream_sliding_count(s, ["item_id"], "ts", "1 hour", "5 minutes"), f"slide{next(_n)}")
    want = windowed_count(batch, ["item_id"], "ts", "1 hour", "5 minutes").filter(F.col("window_end") <= wm_ms)
    assert _rows(got, cols) == _rows(want, cols)
    assert got.count() > 0


def test_unique_visitors_stream(spark, stream_dir):
    with _stream(stream_dir):
        s = user_behavior(spark, SF_SMALL, "pv")
    got = run_available(stream_unique_visitors(s, "ts", "1 hour"), f"uv{next(_n)}")
    want = unique_visitors(user_behavior(spark, SF_SMALL, "pv"), "ts", "1 hour").filter(
        F.col("window_end") <= _wm_ms(user_behavior(spark, SF_SMALL, "pv")))
    assert _rows(got, ["window_end", "uv_count"]) == _rows(want, ["window_end", "uv_count"])


def test_top_n_foreach_batch(spark, stream_dir, tmp_path):
    with _stream(stream_dir):
        s = user_behavior(spark, SF_SMALL, "pv")
    out = str(tmp_path / "top")
    counts = stream_sliding_count(s, ["item_id"], "ts", "1 hour", "5 minutes")
    sink = lambda df, bid: df.write.mode("append").parquet(out)
    run_available(counts, f"top{next(_n)}", foreach_batch=top_n_writer(3, "count", ["item_id"], sink))
    got = spark.read.parquet(out)
    batch = windowed_count(user_behavior(spark, SF_SMALL, "pv"), ["item_id"], "ts", "1 hour", "5 minutes")
    want = top_n(batch, "window_end", "count", 3, ["item_id"]).filter(
        F.col("window_end") <= _wm_ms(user_behavior(spark, SF_SMALL, "pv")))
    cols = ["window_end", "rank", "item_id", "count"]
    assert _rows(got, cols) == _rows(want, cols)


def test_match_next_stream(spark, stream_dir):
    with _stream(stream_dir):
        s = login_events(spark, SF_SMALL)
    got = run_available(stream_match_next(s, within="6 hours", delay="0 seconds"), f"mn{next(_n)}")
    want = match_next(login_events(spark, SF_SMALL), "user_id", "ts", "event_type", "fail", "fail", "6 hours")
    want = want.filter(F.col("second_ts") < _wm_ms(login_events(spark, SF_SMALL)))
    cols = ["user_id", "first_ts", "second_ts", "msg"]
    assert _rows(got, cols) == _rows(want, cols)
    assert got.count() > 0


def test_click_cap_stream(spark, stream_dir):
    with _stream(stream_dir):
        s = ad_clicks(spark, SF_SMALL)
    got = run_available(stream_click_cap(s, ("user_id",), max_count=1), f"cap{next(_n)}")
    # rows are released once ts <= watermark; the watermark is kept in whole ms
    want = click_cap(ad_clicks(spark, SF_SMALL), ("user_id",), max_count=1).filter(
        F.unix_micros("ts") <= _wm_ms(ad_clicks(spark, SF_SMALL)) * 1000).select(
        "user_id", "event_id", F.unix_millis("ts").alias("ts_ms"), "click_no", "verdict", "msg")
    cols = ["user_id", "event_id", "ts_ms", "click_no", "verdict", "msg"]
    assert _rows(got, cols) == _rows(want, cols)


def test_followed_by_stream(spark, stream_dir):
    with _stream(stream_dir):
        s = order_events(spark, SF_SMALL)
    got = run_available(stream_followed_by(s, within="1 day"), f"fb{next(_n)}")
    wm = _wm_ms(order_events(spark, SF_SMALL))
    want = match_followed_by(order_events(spark, SF_SMALL), within="1 day").filter(
        F.col("first_ts") + 86_400_000 < wm)
    cols = ["order_id", "first_ts", "second_ts", "verdict"]
    g = _rows(got.filter(F.col("first_ts") + 86_400_000 < wm), cols)
    assert g == _rows(want, cols)
    assert len(g) > 0


def test_reconcile_stream(spark, stream_dir, tmp_path):
    ev = table(spark, SF_SMALL, "events")
    pays = ev.filter("event_type = 'purchase'").select(F.col("user_id").cast("string").alias("tx_id"),
                                                        F.col("ts").cast("timestamp").alias("ts"))
    receipts = ev.filter("event_type = 'view'").select(F.col("user_id").cast("string").alias("tx_id"),
                                                        F.col("ts").cast("timestamp").alias("ts"))
    pd, rd = str(tmp_path / "p"), str(tmp_path / "r")
    pays.write.parquet(pd)
    receipts.write.parquet(rd)
    sp = spark.readStream.schema(pays.schema).parquet(pd)
    sr = spark.readStream.schema(receipts.schema).parquet(rd)
    got = run_available(stream_reconcile(sp, sr, "tx_id", "ts", "2 hours", "1 hour"), f"rc{next(_n)}")
    want = reconcile(pays, receipts, "tx_id", "ts", "2 hours", "1 hour")
    cols = ["tx_id", "verdict", "pay_ts", "receipt_ts"]
    g = _rows(got.filter("verdict = 'matched'"), cols)
    assert g == _rows(want.filter("verdict = 'matched'"), cols)
    assert len(g) > 0


def test_allowed_lateness_update_mode(spark, tmp_path):
    """Watermark = delay + lateness: a row later than the out-of-orderness delay but within
    the allowed lateness still updates its window, re-emitted in update mode. (Rows behind
    the watermark may or may not be aggregated by Spark, so that side is not asserted.)"""
    base = 1_700_000_000
    base -= base % 3600
    batches = [
        [(1, base + 10, "/a"), (2, base + 20, "/a")],
        [(3, base + 3630, "/a")],   # watermark -> base + 3630 - 61 s, first window still open
        [(4, base + 3590, "/a")],   # 40 s behind the max: late for a 1 s delay, inside 60 s lateness
    ]
    src = str(tmp_path / "late")
    for rows in batches:
        spark.createDataFrame(rows, "event_id long, sec long, url string").withColumn(
            "ts", F.timestamp_seconds("sec")).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    schema = spark.read.parquet(src).schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    counts = stream_windowed_count(s, ["url"], "ts", "1 hour", delay="1 second", lateness="60 seconds")
    got = run_available(counts, f"late{next(_n)}", output_mode="update")
    emitted = {}
    for r in got.collect():
        emitted.setdefault(r.window_end, []).append(r["count"])
    first_end = (base + 3600) * 1000
    assert sorted(emitted[first_end]) == [2, 3]     # on-time result, then the late correction
    assert emitted[first_end + 3_600_000] == [1]


def test_hot_urls_stream_reranks_corrected_windows(spark, stream_dir, tmp_path):
    """Q5 on a stream with allowed lateness: update-mode counts, whole windows re-ranked."""
    from eventflow.plans.networkflow import hot_urls
    from eventflow.sources.tables import access_log_lines
    from eventflow.sources.text import parse_access_log
    from eventflow.functions.text import is_not_static
    from eventflow.streaming.windows import corrected_top_n_writer, read_latest_rankings

    with _stream(stream_dir):
        logs = parse_access_log(access_log_lines(spark, SF_SMALL))
    pages = logs.filter(is_not_static("url")).select("url", "ts")
    counts = stream_windowed_count(pages, ["url"], "ts", "10 minutes", "5 seconds", delay="1 second",
                                   lateness="60 seconds")
    out, log = str(tmp_path / "rank"), str(tmp_path / "counts")
    run_available(counts, f"hu{next(_n)}", output_mode="update",
                  foreach_batch=corrected_top_n_writer(3, "url", log, out))
    got = read_latest_rankings(spark, out)
    batch_logs = parse_access_log(access_log_lines(spark, SF_SMALL))
    wm = _wm_ms(batch_logs.filter(is_not_static("url"))) - 61_000
    want = hot_urls(batch_logs, "10 minutes", "5 seconds", 3).filter(F.col("window_end") <= wm)
    cols = ["window_end", "rank", "url", "count"]
    assert _rows(got.filter(F.col("window_end") <= wm), cols) == _rows(want, cols)


def test_pay_verdict_and_burst_streams(spark, stream_dir):
    from eventflow.operators.patterns import login_fail_burst, pay_event_verdict
    from eventflow.streaming.state import stream_login_fail_burst, stream_pay_event_verdict

    with _stream(stream_dir):
        orders, logins = order_events(spark, SF_SMALL), login_events(spark, SF_SMALL)
    got = run_available(stream_pay_event_verdict(orders, within="1 day"), f"pv{next(_n)}")
    wm = _wm_ms(order_events(spark, SF_SMALL))
    want = pay_event_verdict(order_events(spark, SF_SMALL), within="1 day").filter(F.col("pay_ts") < wm)
    cols = ["order_id", "pay_ts", "verdict", "result_msg"]
    assert _rows(got, cols) == _rows(want, cols) and got.count() > 0

    got = run_available(stream_login_fail_burst(logins, window="6 hours", delay="0 seconds"), f"lb{next(_n)}")
    wm = _wm_ms(login_events(spark, SF_SMALL))
    want = login_fail_burst(login_events(spark, SF_SMALL), window="6 hours").filter(
        F.col("first_fail") + 6 * 3_600_000 < wm)
    cols = ["user_id", "first_fail", "last_fail", "msg"]
    assert _rows(got, cols) == _rows(want, cols) and got.count() > 0


def test_deadline_verdict_stream(spark, stream_dir):
    from eventflow.operators.patterns import order_deadline_verdict
    from eventflow.streaming.state import stream_order_deadline_verdict

    with _stream(stream_dir):
        orders = order_events(spark, SF_SMALL)
    got = run_available(stream_order_deadline_verdict(orders, within="1 day"), f"dv{next(_n)}")
    wm = _wm_ms(order_events(spark, SF_SMALL))
    want = order_deadline_verdict(order_events(spark, SF_SMALL), within="1 day").filter(F.col("deadline") <= wm)
    cols = ["order_id", "create_ts", "deadline", "verdict", "result_msg"]
    g = _rows(got.filter(F.col("deadline") <= wm), cols)
    assert g == _rows(want, cols) and len(g) > 0


def test_interval_join_and_bitmap_uv_streams(spark, stream_dir, tmp_path):
    from eventflow.operators.distinct import unique_visitors_bitmap
    from eventflow.operators.joins import interval_join
    from eventflow.streaming.joins import stream_interval_join
    from eventflow.streaming.windows import stream_unique_visitors_bitmap

    with _stream(stream_dir):
        s = user_behavior(spark, SF_SMALL, "pv")
    got = run_available(stream_unique_visitors_bitmap(s, "ts", "1 hour", bits=5), f"ub{next(_n)}")
    batch = user_behavior(spark, SF_SMALL, "pv")
    want = unique_visitors_bitmap(batch, "ts", "1 hour", bits=5).filter(F.col("window_end") <= _wm_ms(batch))
    assert _rows(got, ["window_end", "uv_count"]) == _rows(want, ["window_end", "uv_count"])

    ev = table(spark, SF_SMALL, "events")
    a = ev.filter("event_type = 'signup'").select(F.col("user_id").cast("string").alias("k"),
                                                  F.col("ts").cast("timestamp").alias("ts"))
    b = ev.filter("event_type = 'purchase'").select(F.col("user_id").cast("string").alias("k"),
                                                    F.col("ts").cast("timestamp").alias("ts"))
    ad, bd = str(tmp_path / "a"), str(tmp_path / "b")
    a.write.parquet(ad)
    b.write.parquet(bd)
    sa = spark.readStream.schema(a.schema).parquet(ad)
    sb = spark.readStream.schema(b.schema).parquet(bd)
    got = run_available(stream_interval_join(sa, sb, "k", "ts", "-2 hours", "6 hours"), f"ij{next(_n)}")
    want = interval_join(a, b, "k", "ts", "ts", "-2 hours", "6 hours")
    cols = ["l_k", "l_ts", "r_ts"]
    assert _rows(got, cols) == _rows(want, cols) and got.count() > 0


def test_hot_items_sql_on_stream(spark, stream_dir, tmp_path):
    from eventflow.plans.hotitems import hot_items_sql, hot_items_sql_stream

    with _stream(stream_dir):
        s = user_behavior(spark, SF_SMALL, "pv")
    out = str(tmp_path / "sqltop")
    sink = lambda df, bid: df.write.mode("append").parquet(out)
    counts = hot_items_sql_stream(spark, s, "1 hour")
    run_available(counts, f"sq{next(_n)}", foreach_batch=top_n_writer(5, "cnt", ["item_id"], sink,
                                                                      rank_col="row_num"))
    got = spark.read.parquet(out)
    batch = user_behavior(spark, SF_SMALL, "pv")
    # Q4 labels the window start as window_end; a window is closed once start + 1 h <= watermark
    want = hot_items_sql(spark, batch, "1 hour", 5).filter(F.col("window_end") + 3_600_000 <= _wm_ms(batch))
    cols = ["item_id", "cnt", "window_end", "row_num"]
    assert _rows(got, cols) == _rows(want, cols) and got.count() > 0


def _run_and_explain(df, path, checkpoint):
    """Runs the stream to its end into ``path``; the physical plan of its last micro-batch."""
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q._jsq.explainInternal(False)


def test_fine_slides_from_pane_state(spark, stream_dir, tmp_path):
    """1 h / 5 s: no Expand in the stream's plan, equal to the batch form; late events count in open windows."""
    batch = ad_clicks(spark, SF_SMALL)
    with _stream(stream_dir):
        s = ad_clicks(spark, SF_SMALL)
    counts = stream_sliding_count(s, ["province"], "ts", "1 hour", "5 seconds")
    path = str(tmp_path / "fine")
    name = f"fine{next(_n)}"
    plan = _run_and_explain(counts, path, str(tmp_path / name))
    assert "FlatMapGroupsInPandasWithState" in plan and "Expand" not in plan
    want = windowed_count(batch, ["province"], "ts", "1 hour", "5 seconds").filter(F.col("window_end") <= _wm_ms(batch))
    cols = ["province", "window_start", "window_end", "count"]
    assert _rows(spark.read.parquet(path), cols) == _rows(want, cols)


def test_pane_state_with_late_events_and_null_keys(spark, tmp_path):
    base = 1_700_000_000 - 1_700_000_000 % 28_800
    batches = [[("a", base + 10), (None, base + 20), ("a", None)], [("a", base + 4000), ("b", base + 28_790)], [("a", base + 28_000), (None, base + 28_795)],
               [("z", base + 60_000)]]
    src = str(tmp_path / "panes")
    for rows in batches:
        spark.createDataFrame(rows, "k string, sec long").withColumn("ts", F.timestamp_seconds("sec")).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    s = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = run_available(stream_sliding_count(s, ["k"], "ts", "1 hour", "5 minutes", delay="20 minutes"), f"panes{next(_n)}")
    rows = spark.read.parquet(src).where("ts is not null")
    want = windowed_count(rows, ["k"], "ts", "1 hour", "5 minutes").filter(F.col("window_end") <= (base + 60_000 - 1200) * 1000)
    key = lambda r: (r[0] or "", *r[1:])
    cols = ["k", "window_end", "count"]
    assert sorted(_rows_any(got, cols), key=key) == sorted(_rows_any(want, cols), key=key) and got.count() > 30


def _rows_any(df, cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_running_unique_visitors(spark, stream_dir, tmp_path):
    """Update mode over four batches: the last update of each window is the batch result, updates only rise."""
    from eventflow.operators.distinct import unique_visitors_bitmap
    from eventflow.streaming.windows import last_updates, merge_visitors, running_visitors_writer, stream_running_visitors

    for bits in (29, 5):
        with _stream(stream_dir):
            s = user_behavior(spark, SF_SMALL, "pv")
        path = str(tmp_path / f"uv{bits}")
        pieces = stream_running_visitors(s, "ts", "1 hour", bits=bits, delay="1 hour")
        run_available(pieces, f"ruv{next(_n)}", "update", running_visitors_writer(path))
        want = unique_visitors_bitmap(user_behavior(spark, SF_SMALL, "pv"), "ts", "1 hour", bits=bits)
        assert _rows(last_updates(spark, path), ["window_end", "uv_count"]) == _rows(want, ["window_end", "uv_count"])
        seen = {}
        for r in spark.read.parquet(f"{path}/updates").orderBy("_batch").collect():
            seen.setdefault(r["window_end"], []).append(r["uv_count"])
        assert all(v == sorted(v) and len(v) == len(set(v)) or v == sorted(v) for v in seen.values())
    batch = user_behavior(spark, SF_SMALL, "pv")
    days = unique_visitors_bitmap(batch, "ts", "1 day", bits=29)
    assert _rows(merge_visitors(stream_running_visitors(batch, "ts", "1 hour"), "1 day"), ["window_end", "uv_count"]) == _rows(days, ["window_end", "uv_count"])


def test_one_hot_key_in_stream_joins(spark, tmp_path):
    """All rows of one key: the bucket is a join key of the stream, and unmatched rows come out once."""
    hour = 3_600_000
    base = 1_700_000_000_000 - 1_700_000_000_000 % (24 * hour)
    rng = __import__("random").Random(5)
    pays = [("hot", base + rng.randrange(40 * hour)) for _ in range(60)] + [("hot", base + 90 * hour)]
    receipts = [("hot", base + rng.randrange(40 * hour)) for _ in range(60)] + [("hot", base + 90 * hour)]
    sides = []
    for name, rows in (("p", pays), ("r", receipts)):
        d = str(tmp_path / name)
        rows = sorted(rows)
        for lo in range(0, len(rows), 21):
            spark.createDataFrame(rows[lo:lo + 21], "tx_id string, ms long").select("tx_id", F.timestamp_millis("ms").alias("ts")).coalesce(1).write.mode("append").parquet(d)
            time.sleep(1.1)
        sides.append((spark.read.parquet(d), spark.readStream.schema("tx_id string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(d)))
    (bp, sp), (br, sr) = sides
    for pay_wait, receipt_wait in (("20 minutes", "10 minutes"), ("2 hours", "0 seconds")):
        out = stream_reconcile(sp, sr, "tx_id", "ts", pay_wait, receipt_wait)
        path = str(tmp_path / f"hot{next(_n)}")
        keys = _run_and_explain(out, path, path + "-c").split("StreamingSymmetricHashJoin [")[1].split("]")[0]
        assert "_kl" in keys and "_bl" in keys
        want = reconcile(bp, br, "tx_id", "ts", pay_wait, receipt_wait).filter(F.coalesce("pay_ts", "receipt_ts") < F.timestamp_millis(F.lit(base + 80 * hour)))
        got = spark.read.parquet(path).filter(F.coalesce("pay_ts", "receipt_ts") < F.timestamp_millis(F.lit(base + 80 * hour)))
        cols = ["tx_id", "verdict", "pay_ts", "receipt_ts"]
        key = lambda r: tuple(str(x) for x in r)
        assert sorted(_rows_any(got, cols), key=key) == sorted(_rows_any(want, cols), key=key)
        naive = [(p, r) for p in pays[:-1] for r in receipts[:-1] if -(600_000 if receipt_wait == "10 minutes" else 0) <= r[1] - p[1] <= (1_200_000 if pay_wait == "20 minutes" else 2 * hour)]
        assert sum(r[1] == "matched" for r in _rows_any(want, cols)) == len(naive) > 0
        assert {r[1] for r in _rows_any(want, cols)} == {"matched", "unmatched_pay", "unmatched_receipt"}


def test_folds_with_null_times_and_tie_breaks(spark, tmp_path):
    """Rows without a time are left out, null tie-breaks come first among equal times, as in the batch form."""
    rows = [("b", 1, "fail", 10), (None, 1, "success", 10), ("c", 1, "fail", 11), (None, 1, "fail", None),
            (None, 2, "fail", 10), ("a", 2, "success", 10), ("d", 2, "fail", 11), (None, 3, "success", 100)]
    df = spark.createDataFrame(rows, "event_id string, user_id long, event_type string, s long")
    df = df.select("event_id", "user_id", "event_type", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("ts"))
    path = str(tmp_path / "logins")
    df.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    got = run_available(stream_match_next(stream, "user_id", "ts", "event_type", "fail", "fail", "2 seconds", delay="0 seconds"), f"nf{next(_n)}")
    want = match_next(df.where("ts is not null"), "user_id", "ts", "event_type", "fail", "fail", "2 seconds")
    cols = ["user_id", "first_ts", "second_ts", "msg"]
    assert _rows(got, cols) == _rows(want, cols) and got.count() == 1

"""Streaming forms as registered queries: the whole ``events`` table is streamed to its end.

What a stream in append mode gives are the windows that the last watermark (the latest event time, in whole
milliseconds) has closed, and the oracles say so; in update mode every window has a last update.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.text import is_not_static
from eventflow.plans.hotitems import Q4_SQL, hot_items_sql_stream
from eventflow.plans.market import CLICKS_SQL
from eventflow.plans.networkflow import Q5_MINUTES_SQL, Q8_SQL
from eventflow.plans.orderpay import PAY_WAIT, RECEIPT_WAIT, TX_SQL
from eventflow.plans.registry import register
from eventflow.session import shared_dir
from eventflow.sources.tables import access_log_lines, ad_clicks, pay_events, receipt_events, streaming_tables, user_behavior
from eventflow.sources.text import parse_access_log
from eventflow.streaming.changelog import ChangeLog, by_day, ranking_changes_writer, rising_ranking_writer
from eventflow.streaming.connected import reconcile_connected, verdicts
from eventflow.streaming.runner import run_available
from eventflow.streaming.windows import (last_updates, running_visitors_writer, stream_running_visitors, stream_sliding_count,
                                         stream_windowed_count)


def _run(spark: SparkSession, name: str) -> tuple[str, str]:
    """A name of this run, and a folder for its results."""
    own = f"{name}-{uuid.uuid4().hex}"
    return own, f"{shared_dir(spark)}/results/{own}"


Q24_SQL = f"""WITH {CLICKS_SQL},
w AS (SELECT province, unnest(generate_series(t - t % 5000 + 5000, t - t % 5000 + 3600000, 5000)) AS window_end FROM c)
SELECT province, window_end, count(*) AS count FROM w
WHERE window_end <= (SELECT max(t) FROM c) GROUP BY province, window_end"""


@register("q24_ad_clicks_stream", Q24_SQL)
def q24(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11 on a stream: hour windows that slide by five seconds, from pane state."""
    with streaming_tables(("events",)):
        clicks = ad_clicks(spark, sf_dir)
    name, path = _run(spark, "q24")
    counts = stream_sliding_count(clicks, ["province"], "ts", "1 hour", "5 seconds")
    return run_available(counts.select("province", "window_end", "count"), name, path=path)


@register("q25_running_unique_visitors", Q8_SQL)
def q25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8 as it runs: unique visitors of every window after its last update."""
    with streaming_tables(("events",)):
        views = user_behavior(spark, sf_dir, "pv")
    name, path = _run(spark, "q25")
    run_available(stream_running_visitors(views, "ts", "1 hour", "user_id", 29), name, "update", running_visitors_writer(path))
    return last_updates(spark, path).select("window_end", "uv_count")


def hot_items_changes(spark: SparkSession, sf_dir: str, n: int = 5, files: int = 8, files_a_batch: int = 2) -> ChangeLog:
    """Q4's top ``n`` as a retract stream: the views arrive in ``files`` files of mixed times, so that later batches
    change counts and push items out of rankings; no view is late."""
    name, path = _run(spark, "q26")
    views = user_behavior(spark, sf_dir, "pv").select("item_id", "behavior", "ts")
    views.repartition(files).write.parquet(f"{path}/views")
    stream = spark.readStream.schema(views.schema).option("maxFilesPerTrigger", files_a_batch).parquet(f"{path}/views")
    day = by_day("window_end")
    counts = ChangeLog(f"{path}/counts", "item_id long, cnt long, window_end long", ["window_end", "item_id"], day)
    ranks = ChangeLog(f"{path}/ranks", "item_id long, cnt long, window_end long, row_num long", ["window_end", "item_id"], day)
    write = ranking_changes_writer(counts, ranks, n, "window_end", "cnt", ["item_id"], "row_num", compact_every=2)
    run_available(hot_items_sql_stream(spark, stream, "1 hour", "10000 days"), name, "update", write)
    return ranks


@register("q26_hot_items_changes", Q4_SQL)
def q26(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 from the replay of its retract stream."""
    return hot_items_changes(spark, sf_dir).current(spark).drop("_part")


def hot_urls_corrections(spark: SparkSession, sf_dir: str, n: int = 3, files: int = 6, files_a_batch: int = 2) -> ChangeLog:
    """Q5's top ``n`` (10 minutes, a slide of one) with late corrections: the pages arrive in ``files`` files of mixed
    times, so most rows of a later batch are late for their windows, and all are within the lateness."""
    name, path = _run(spark, "q27")
    pages = parse_access_log(access_log_lines(spark, sf_dir)).filter(is_not_static("url")).select("url", "ts")
    pages.repartition(files).write.parquet(f"{path}/pages")
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", files_a_batch).parquet(f"{path}/pages")
    counts = stream_windowed_count(stream, ["url"], "ts", "10 minutes", "1 minute", delay="1 second", lateness="10000 days")
    ranks = ChangeLog(f"{path}/ranks", "window_end long, rank long, url string, count long", ["window_end", "url"], by_day("window_end", 28))
    run_available(counts, name, "update", rising_ranking_writer(ranks, n, "window_end", "count", ["url"], compact_every=2))
    return ranks


@register("q27_hot_urls_late_corrections", Q5_MINUTES_SQL)
def q27(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5 after the last late correction, from the replay of its changes."""
    return hot_urls_corrections(spark, sf_dir).current(spark).drop("_part")


#: Rows of both inputs for each bucket of connected states.
ROWS_A_BUCKET, LEAST_BUCKETS = 1000, 200


def reconcile_stream(spark: SparkSession, sf_dir: str, slices: int = 2) -> DataFrame:
    """Q19 as two connected streams that arrive in ``slices`` spans of time, the query started anew for each."""
    name, path = _run(spark, "q29")
    sides = {"pays": pay_events(spark, sf_dir), "receipts": receipt_events(spark, sf_dir)}
    for side, rows in sides.items():  # made once, read for the edges and for each span
        rows.write.parquet(f"{path}/all/{side}")
    sides = {side: spark.read.schema(rows.schema).parquet(f"{path}/all/{side}") for side, rows in sides.items()}
    first, last, n = (sides["pays"].select("ts").unionAll(sides["receipts"].select("ts"))
                      .agg(F.min(F.unix_millis("ts")), F.max(F.unix_millis("ts")), F.count("*")).first())
    buckets = max(LEAST_BUCKETS, n // ROWS_A_BUCKET)
    edges = [first + (last + 1 - first) * k // slices for k in range(slices + 1)] if first is not None else []
    for lo, hi in zip(edges, edges[1:]):
        for side, rows in sides.items():
            rows.where(F.unix_millis("ts").between(lo, hi - 1)).write.mode("append").parquet(f"{path}/{side}")
        streams = [spark.readStream.schema(rows.schema).parquet(f"{path}/{side}") for side, rows in sides.items()]
        found = reconcile_connected(*streams, "tx_id", "ts", PAY_WAIT, RECEIPT_WAIT, buckets=buckets)
        rows = verdicts(found, ["pay_tx_id", "receipt_tx_id", "pay_order_id", "pay_ts", "receipt_pay_channel", "receipt_ts"])
        done = run_available(rows.withColumn("mark", F.lit(last)), name, path=f"{path}/out")
    if not edges:
        return spark.createDataFrame([], "tx_id string, verdict string, pay_order_id long, pay_ts long, receipt_pay_channel string, receipt_ts long")
    # Rows of the very time where the stream ends are not over yet.
    done = done.where(F.greatest("pay_ts", "receipt_ts") < F.col("mark"))
    return done.select(F.coalesce("pay_tx_id", "receipt_tx_id").alias("tx_id"), "verdict", "pay_order_id", "pay_ts", "receipt_pay_channel", "receipt_ts")


Q29_SQL = f"""WITH {TX_SQL},
m AS (SELECT greatest((SELECT max(ts) FROM pays), (SELECT max(ts) FROM rc)) AS mark),
j AS (SELECT p.tx_id AS pt, p.order_id, p.ts AS pay_at, r.tx_id AS rt, r.pay_channel, r.ts AS receipt_at
      FROM pays p FULL OUTER JOIN rc r ON p.tx_id = r.tx_id AND r.ts BETWEEN p.ts - INTERVAL 30 DAY AND p.ts + INTERVAL 60 DAY)
SELECT coalesce(pt, rt) AS tx_id,
       CASE WHEN pt IS NOT NULL AND rt IS NOT NULL THEN 'matched' WHEN pt IS NOT NULL THEN 'unmatched_pay' ELSE 'unmatched_receipt' END AS verdict,
       order_id AS pay_order_id, epoch_us(pay_at) // 1000 AS pay_ts, pay_channel AS receipt_pay_channel, epoch_us(receipt_at) // 1000 AS receipt_ts
FROM j, m
WHERE CASE WHEN pt IS NOT NULL AND rt IS NOT NULL THEN greatest(pay_at, receipt_at) < mark
           WHEN pt IS NOT NULL THEN pay_at + INTERVAL 60 DAY < mark ELSE receipt_at + INTERVAL 30 DAY < mark END"""


@register("q29_reconcile_connected", Q29_SQL)
def q29(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q19 by two connected streams with one keyed state, a timer a side and an output a verdict."""
    return reconcile_stream(spark, sf_dir)

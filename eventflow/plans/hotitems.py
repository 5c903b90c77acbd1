"""Hot items: top-N viewed items per sliding/tumbling window (Q1-Q4) and the truncating mean (Q21)."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.text import REPORT_ITEM_LABEL
from eventflow.operators.accumulate import accumulate
from eventflow.operators.aggregates import truncated_mean, truncated_mean_accumulator
from eventflow.operators.ranking import top_n, top_n_report
from eventflow.operators.windows import tumbling_agg, windowed_count
from eventflow.plans.registry import register
from eventflow.sources.tables import as_instant, behavior_lines, table, user_behavior
from eventflow.sources.text import USER_BEHAVIOR, parse_delimited

_view_ids = itertools.count()

# DuckDB form of sources.tables.user_behavior.
UB_SQL = """ub AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior,
         epoch_us(ts) // 1000 AS t
  FROM events)"""


def hot_items(behavior: DataFrame, size="1 hour", slide="5 minutes", n: int = 3,
              ts: str = "ts", method: str = "auto") -> DataFrame:
    """Q1: top-``n`` viewed items per sliding window -> window_end, rank, item_id, count."""
    pv = behavior.filter(F.col("behavior") == "pv").select("item_id", ts)
    counts = windowed_count(pv, ["item_id"], ts, size, slide, method=method)
    return top_n(counts, "window_end", "count", n, ["item_id"]).select("window_end", "rank", "item_id", "count")


def hot_items_tumbling(behavior: DataFrame, size="1 hour", n: int = 5, ts: str = "ts") -> DataFrame:
    """Q3 (DataFrame form): tumbling count + row_number <= n -> item_id, cnt, window_end, row_num."""
    pv = behavior.filter(F.col("behavior") == "pv").select("item_id", ts)
    counts = tumbling_agg(pv, ["item_id"], ts, size, (("cnt", "count", "item_id"),))
    return top_n(counts, "window_end", "cnt", n, ["item_id"], rank_col="row_num").select(
        "item_id", "cnt", "window_end", "row_num")


def hot_items_sql(spark: SparkSession, behavior: DataFrame, size: str = "1 hour", n: int = 5) -> DataFrame:
    """Q4 (SQL form). As in the reference, the column named ``window_end`` holds the window start."""
    view = f"ef_user_behavior_{next(_view_ids)}"
    behavior.select("item_id", "behavior", "ts").createOrReplaceTempView(view)
    return spark.sql(f"""
        SELECT item_id, cnt, window_end, CAST(row_num AS BIGINT) AS row_num FROM (
          SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num FROM (
            SELECT item_id, count(item_id) AS cnt, unix_millis(window(ts, '{size}').start) AS window_end
            FROM {view} WHERE behavior = 'pv'
            GROUP BY window(ts, '{size}'), item_id))
        WHERE row_num <= {n}""")


# ---------------------------------------------------------------- registered analytics
Q1_SQL = f"""WITH {UB_SQL},
w AS (SELECT item_id, unnest(generate_series(t - t % 300000 + 300000, t - t % 300000 + 3600000, 300000)) AS window_end
      FROM ub WHERE behavior = 'pv'),
c AS (SELECT window_end, item_id, count(*) AS count FROM w GROUP BY window_end, item_id),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY count DESC, item_id) AS rank FROM c)
SELECT window_end, rank, item_id, count FROM r WHERE rank <= 3"""


@register("q01_hot_items", Q1_SQL)
def q01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot_items(user_behavior(spark, sf_dir, "pv"), "1 hour", "5 minutes", 3)


Q1R_SQL = f"""WITH {UB_SQL},
w AS (SELECT item_id, unnest(generate_series(t - t % 300000 + 300000, t - t % 300000 + 3600000, 300000)) AS window_end
      FROM ub WHERE behavior = 'pv'),
c AS (SELECT window_end, item_id, count(*) AS count FROM w GROUP BY window_end, item_id),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY count DESC, item_id) AS rank FROM c)
SELECT window_end,
       '时间：' || strftime(epoch_ms(window_end), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
       || string_agg('No' || rank || ':' || ' 商品id=' || item_id || ' 浏览量=' || count || chr(10), '' ORDER BY rank)
       || '======================' AS report
FROM r WHERE rank <= 3 GROUP BY window_end"""


@register("q01r_hot_items_report", Q1R_SQL)
def q01r(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = hot_items(user_behavior(spark, sf_dir, "pv"), "1 hour", "5 minutes", 3)
    return top_n_report(ranked, "window_end", "rank", "item_id", "count", REPORT_ITEM_LABEL, whole_seconds=True)


Q2_SQL = f"""WITH b AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         epoch_ms(date_trunc('second', ts)) AS t FROM events WHERE event_type = 'view'),
w AS (SELECT item_id, unnest(generate_series(t - t % 300000 + 300000, t - t % 300000 + 3600000, 300000)) AS window_end FROM b),
c AS (SELECT window_end, item_id, count(*) AS count FROM w GROUP BY window_end, item_id),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY count DESC, item_id) AS rank FROM c)
SELECT window_end, rank, item_id, count FROM r WHERE rank <= 3"""


@register("q02_hot_items_from_lines", Q2_SQL)
def q02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2's transform: CSV lines (as a Kafka value or a text file carries them) -> parse -> Q1."""
    parsed = parse_delimited(behavior_lines(spark, sf_dir), USER_BEHAVIOR)
    return hot_items(parsed, "1 hour", "5 minutes", 3)


Q3_SQL = f"""WITH {UB_SQL},
c AS (SELECT item_id, count(item_id) AS cnt, t - t % 3600000 + 3600000 AS window_end
      FROM ub WHERE behavior = 'pv' GROUP BY item_id, t - t % 3600000 + 3600000),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num FROM c)
SELECT item_id, cnt, window_end, row_num FROM r WHERE row_num <= 5"""


@register("q03_hot_items_tumbling", Q3_SQL)
def q03(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot_items_tumbling(user_behavior(spark, sf_dir, "pv"), "1 hour", 5)


Q4_SQL = f"""WITH {UB_SQL},
c AS (SELECT item_id, count(item_id) AS cnt, t - t % 3600000 AS window_end
      FROM ub WHERE behavior = 'pv' GROUP BY item_id, t - t % 3600000),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num FROM c)
SELECT item_id, cnt, window_end, row_num FROM r WHERE row_num <= 5"""


@register("q04_hot_items_sql", Q4_SQL)
def q04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot_items_sql(spark, user_behavior(spark, sf_dir, "pv"), "1 hour", 5)


Q21_SQL = """SELECT event_type, CAST(sum(event_id) // count(event_id) AS DOUBLE) AS mean
FROM events GROUP BY event_type"""


@register("q21_truncated_mean", Q21_SQL)
def q21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated_mean(table(spark, sf_dir, "events"), ["event_type"], "event_id")


Q28_SQL = """WITH v AS (SELECT event_type, event_id, epoch_us(ts) // 1000 AS t FROM events),
w AS (SELECT event_type, event_id, unnest(generate_series(t - t % 300000 + 300000, t - t % 300000 + 3600000, 300000)) AS window_end FROM v)
SELECT event_type, window_end, CAST(sum(event_id) // count(event_id) AS DOUBLE) AS mean FROM w GROUP BY event_type, window_end"""


@register("q28_sliding_truncated_mean", Q28_SQL)
def q28(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG9 over sliding windows, as a user accumulator merged over panes."""
    v = table(spark, sf_dir, "events").select("event_type", "event_id", as_instant("ts").alias("ts"))
    means = accumulate(v, ["event_type"], "ts", "1 hour", truncated_mean_accumulator("event_id"), ["event_id"], "5 minutes", out="mean")
    return means.select("event_type", "window_end", "mean")



def hot_items_kafka(spark: SparkSession, servers: str, topic: str = "user-behaviors",
                    size="1 hour", slide="5 minutes", n: int = 3, delay="0 seconds"):
    """Q2: hot items over a Kafka topic of UserBehavior lines (needs the Kafka connector).

    Returns the streaming count DataFrame and the ``foreachBatch`` ranking function; start it
    with ``counts.writeStream.foreachBatch(rank).option("checkpointLocation", ...).start()``.
    """
    from eventflow.sources.kafka import read_kafka_lines
    from eventflow.streaming.windows import stream_sliding_count, top_n_writer

    parsed = parse_delimited(read_kafka_lines(spark, servers, topic), USER_BEHAVIOR)
    pv = parsed.filter(F.col("behavior") == "pv").select("item_id", "ts")
    counts = stream_sliding_count(pv, ["item_id"], "ts", size, slide, delay)

    def rank(write_ranked):
        return top_n_writer(n, "count", ["item_id"], write_ranked)

    return counts, rank


def hot_items_sql_stream(spark: SparkSession, behavior_stream: DataFrame, size: str = "1 hour",
                         delay: str = "0 seconds") -> DataFrame:
    """Q4 on a stream: the watermarked stream is registered as a temp view (column pruning +
    event-time attribute) and aggregated in SQL. Streams do not support ``row_number``, so the
    ranking (``row_num <= n``, window start labelled ``window_end`` as in Q4) is applied per
    micro-batch with ``streaming.windows.top_n_writer(n, "cnt", ["item_id"], sink,
    rank_col="row_num")``."""
    view = f"ef_behavior_stream_{next(_view_ids)}"
    (behavior_stream.select("item_id", "behavior", "ts").withWatermark("ts", delay)
                    .createOrReplaceTempView(view))
    return spark.sql(f"""
        SELECT item_id, count(item_id) AS cnt, unix_millis(window(ts, '{size}').start) AS window_end
        FROM {view} WHERE behavior = 'pv'
        GROUP BY window(ts, '{size}'), item_id""")

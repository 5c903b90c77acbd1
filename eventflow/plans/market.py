"""Market analysis: app marketing counts (Q9, Q10), ad clicks by province (Q11) and the daily click cap (Q12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.text import TOTAL_BEHAVIOR, TOTAL_CHANNEL
from eventflow.functions.time import duration_ms, java_timestamp_text
from eventflow.operators.caps import click_cap
from eventflow.operators.windows import sliding_agg, windowed_count
from eventflow.plans.registry import register
from eventflow.functions.time import as_instant
from eventflow.sources.tables import ad_clicks, marketing_events, table


def marketing_by_channel(events: DataFrame, size="1 hour", slide="10 seconds", ts: str = "ts") -> DataFrame:
    """Q9: count per (channel, behavior) per sliding window, uninstalls excluded.
    -> window_start, window_end (epoch-ms text), channel, behavior, count"""
    e = events.filter(F.col("behavior") != "UNINSTALL").select("channel", "behavior", ts)
    c = windowed_count(e, ["channel", "behavior"], ts, size, slide)
    return c.select(F.col("window_start").cast("string").alias("window_start"),
                    F.col("window_end").cast("string").alias("window_end"), "channel", "behavior", "count")


def marketing_total(events: DataFrame, size="1 hour", slide="10 seconds", ts: str = "ts") -> DataFrame:
    """Q10: total count per sliding window with constant labels ``app`` / ``total``."""
    e = events.filter(F.col("behavior") != "UNINSTALL").select(ts)
    c = windowed_count(e, [], ts, size, slide)
    return c.select(F.col("window_start").cast("string").alias("window_start"),
                    F.col("window_end").cast("string").alias("window_end"),
                    F.lit(TOTAL_CHANNEL).alias("channel"), F.lit(TOTAL_BEHAVIOR).alias("behavior"), "count")


def ad_clicks_by_province(clicks: DataFrame, size="1 hour", slide="5 seconds", ts: str = "ts") -> DataFrame:
    """Q11: clicks per province per sliding window -> window_end (timestamp text), province, count."""
    c = windowed_count(clicks.select("province", ts), ["province"], ts, size, slide)
    whole = duration_ms(slide) % 1000 == 0 and duration_ms(size) % 1000 == 0
    return c.select(java_timestamp_text(F.col("window_end"), whole).alias("window_end"), "province", "count")


def capped_clicks(clicks: DataFrame, keys: Sequence[str], max_count: int, policy: str) -> DataFrame:
    """Q12a output: every click with its number of the day, verdict and warning text."""
    c = click_cap(clicks, keys, "ts", "event_id", max_count, policy)
    return c.select("event_id", "user_id", "ad_id", "province", F.unix_millis("ts").alias("ts_ms"),
                    "click_no", "verdict", "msg")


# ---------------------------------------------------------------- registered analytics
MK_SQL = """m AS (
  SELECT CASE WHEN event_type = 'error' THEN 'UNINSTALL' ELSE upper(event_type) END AS behavior,
         CASE WHEN user_id % 2 = 0 THEN 'Play Store' ELSE 'AppStore' END AS channel,
         epoch_us(ts) // 1000 AS t FROM events)"""

Q9_SQL = f"""WITH {MK_SQL},
w AS (SELECT channel, behavior, unnest(generate_series(t - t % 10000 + 10000, t - t % 10000 + 3600000, 10000)) AS e
      FROM m WHERE behavior <> 'UNINSTALL')
SELECT CAST(e - 3600000 AS VARCHAR) AS window_start, CAST(e AS VARCHAR) AS window_end, channel, behavior,
       count(*) AS count
FROM w GROUP BY e, channel, behavior"""


@register("q09_marketing_by_channel", Q9_SQL)
def q09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marketing_by_channel(marketing_events(spark, sf_dir, drop_uninstall=True), "1 hour", "10 seconds")


Q10_SQL = f"""WITH {MK_SQL},
w AS (SELECT unnest(generate_series(t - t % 10000 + 10000, t - t % 10000 + 3600000, 10000)) AS e
      FROM m WHERE behavior <> 'UNINSTALL')
SELECT CAST(e - 3600000 AS VARCHAR) AS window_start, CAST(e AS VARCHAR) AS window_end,
       'app' AS channel, 'total' AS behavior, count(*) AS count
FROM w GROUP BY e"""


@register("q10_marketing_total", Q10_SQL)
def q10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marketing_total(marketing_events(spark, sf_dir, drop_uninstall=True), "1 hour", "10 seconds")


CLICKS_SQL = """c AS (
  SELECT e.event_id, e.user_id, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS ad_id,
         n.n_name AS province, e.ts, epoch_us(e.ts) // 1000 AS t
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
  WHERE e.event_type = 'click')"""

Q11_SQL = f"""WITH {CLICKS_SQL},
w AS (SELECT province, unnest(generate_series(t - t % 5000 + 5000, t - t % 5000 + 3600000, 5000)) AS e FROM c)
SELECT strftime(epoch_ms(e), '%Y-%m-%d %H:%M:%S') || '.0' AS window_end, province, count(*) AS count
FROM w GROUP BY e, province"""


@register("q11_ad_clicks_by_province", Q11_SQL)
def q11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_clicks_by_province(ad_clicks(spark, sf_dir), "1 hour", "5 seconds")


# Scaled to the driver tables: cap 1 click per user per day (FIXTURES.md).
CAP_KEYS = ("user_id",)
CAP_MAX = 1


def _q12_sql(policy: str) -> str:
    warn = CAP_MAX + 2
    dropped = f"WHEN click_no > {warn} THEN 'dropped' " if policy == "drop_all" else ""
    return f"""WITH {CLICKS_SQL},
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS click_no FROM c)
SELECT event_id, user_id, ad_id, province, t AS ts_ms, click_no,
       CASE WHEN click_no = {warn} THEN 'blacklist' {dropped}ELSE 'pass' END AS verdict,
       CASE WHEN click_no = {warn} THEN 'Click over {CAP_MAX} times today' END AS msg
FROM n"""


@register("q12a_click_cap", _q12_sql("as_written"))
def q12a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capped_clicks(ad_clicks(spark, sf_dir), CAP_KEYS, CAP_MAX, "as_written")


@register("q12a_click_cap_drop_all", _q12_sql("drop_all"))
def q12a_drop_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capped_clicks(ad_clicks(spark, sf_dir), CAP_KEYS, CAP_MAX, "drop_all")


Q12B_SQL = f"""WITH {CLICKS_SQL},
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS click_no FROM c),
w AS (SELECT province, unnest(generate_series(t - t % 5000 + 5000, t - t % 5000 + 3600000, 5000)) AS e
      FROM n WHERE click_no <> {CAP_MAX + 2})
SELECT strftime(epoch_ms(e), '%Y-%m-%d %H:%M:%S') || '.0' AS window_end, province, count(*) AS count
FROM w GROUP BY e, province"""


@register("q12b_capped_clicks_by_province", Q12B_SQL)
def q12b(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = click_cap(ad_clicks(spark, sf_dir), CAP_KEYS, "ts", "event_id", CAP_MAX, "as_written")
    return ad_clicks_by_province(c.filter(F.col("verdict") == "pass"), "1 hour", "5 seconds")


Q22_SQL = """WITH v AS (SELECT event_type, CAST(value AS DECIMAL(18, 4)) AS amount, epoch_us(ts) // 1000 AS t FROM events),
w AS (SELECT event_type, amount, unnest(generate_series(t - t % 300000 + 300000, t - t % 300000 + 3600000, 300000)) AS window_end FROM v)
SELECT event_type, window_end, count(*) AS n, CAST(sum(amount) AS VARCHAR) AS total FROM w GROUP BY event_type, window_end"""


@register("q22_sliding_sum", Q22_SQL)
def q22(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding totals of ``events.value`` (exact decimals) per event type."""
    v = table(spark, sf_dir, "events").select("event_type", F.col("value").cast("decimal(18,4)").alias("amount"), as_instant("ts").alias("ts"))
    out = sliding_agg(v, ["event_type"], "ts", "1 hour", "5 minutes", (("n", "count", None), ("total", "sum", "amount")))
    return out.select("event_type", "window_end", "n", F.col("total").cast("string").alias("total"))


Q23_SQL = """WITH v AS (SELECT event_type, value, epoch_us(ts) // 1000 AS t FROM events),
w AS (SELECT event_type, value, unnest(generate_series(t - t % 300000 + 300000, t - t % 300000 + 3600000, 300000)) AS window_end FROM v)
SELECT event_type, window_end, round(avg(value), 6) AS mean, max(value) AS largest FROM w GROUP BY event_type, window_end"""


@register("q23_sliding_mean", Q23_SQL)
def q23(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding means and maxima of ``events.value`` per event type (pane form)."""
    v = table(spark, sf_dir, "events").select("event_type", "value", as_instant("ts").alias("ts"))
    out = sliding_agg(v, ["event_type"], "ts", "1 hour", "5 minutes", (("mean", "avg", "value"), ("largest", "max", "value")))
    return out.select("event_type", "window_end", F.round("mean", 6).alias("mean"), "largest")

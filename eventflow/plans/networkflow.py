"""Network flow: hot URLs from access logs (Q5), page views (Q6), unique visitors (Q7, Q8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.hashing import poly_hash_sql
from eventflow.functions.text import REPORT_URL_LABEL, is_not_static
from eventflow.operators.distinct import unique_visitors, unique_visitors_bitmap
from eventflow.operators.ranking import top_n, top_n_report
from eventflow.operators.windows import windowed_count
from eventflow.plans.hotitems import UB_SQL
from eventflow.plans.registry import register
from eventflow.sources.tables import access_log_lines, user_behavior
from eventflow.sources.text import parse_access_log


def hot_urls(logs: DataFrame, size="10 minutes", slide="5 seconds", n: int = 3, ts: str = "ts") -> DataFrame:
    """Q5: top-``n`` non-static URLs per sliding window -> window_end, rank, url, count.

    (Allowed lateness only matters on streams: see streaming.windows.)"""
    pages = logs.filter(is_not_static("url")).select("url", ts)
    counts = windowed_count(pages, ["url"], ts, size, slide)
    return top_n(counts, "window_end", "count", n, ["url"]).select("window_end", "rank", "url", "count")


def page_views(behavior: DataFrame, size="1 hour", ts: str = "ts") -> DataFrame:
    """Q6: page views per tumbling window (global, partial aggregates first) -> window_end, pv."""
    pv = behavior.filter(F.col("behavior") == "pv").select(ts)
    return windowed_count(pv, [], ts, size, count_col="pv").select("window_end", "pv")


Q5_SQL = """WITH l AS (
  SELECT '/' || event_type || ['', '.html', '.css', '.js', '.css?v=1'][CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 + 1] AS url,
         epoch_ms(date_trunc('second', ts)) AS t FROM events),
f AS (SELECT url, t FROM l WHERE NOT regexp_matches(url, '\\.(css|js|ico|png)$')),
w AS (SELECT url, unnest(generate_series(t - t % 5000 + 5000, t - t % 5000 + 600000, 5000)) AS window_end FROM f),
c AS (SELECT window_end, url, count(*) AS count FROM w GROUP BY window_end, url),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY count DESC, url) AS rank FROM c)
SELECT window_end, rank, url, count FROM r WHERE rank <= 3"""


@register("q05_hot_urls", Q5_SQL)
def q05(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot_urls(parse_access_log(access_log_lines(spark, sf_dir)), "10 minutes", "5 seconds", 3)


#: Q5's windows with a slide of a minute.
Q5_MINUTES_SQL = Q5_SQL.replace("5000", "60000")

Q5R_SQL = Q5_SQL.replace("SELECT window_end, rank, url, count FROM r WHERE rank <= 3", """SELECT window_end,
       '时间：' || strftime(epoch_ms(window_end), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
       || string_agg('No' || rank || ':' || ' URL=' || url || ' 浏览量=' || count || chr(10), '' ORDER BY rank)
       || '======================' AS report
FROM r WHERE rank <= 3 GROUP BY window_end""")


@register("q05r_hot_urls_report", Q5R_SQL)
def q05r(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5's printed form: one ranking text per window end (`` URL=`` lines)."""
    ranked = hot_urls(parse_access_log(access_log_lines(spark, sf_dir)), "10 minutes", "5 seconds", 3)
    return top_n_report(ranked, "window_end", "rank", "url", "count", REPORT_URL_LABEL, whole_seconds=True)


Q6_SQL = f"""WITH {UB_SQL}
SELECT t - t % 3600000 + 3600000 AS window_end, count(*) AS pv
FROM ub WHERE behavior = 'pv' GROUP BY t - t % 3600000 + 3600000"""


@register("q06_page_views", Q6_SQL)
def q06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_views(user_behavior(spark, sf_dir, "pv"), "1 hour")


Q7_SQL = f"""WITH {UB_SQL}
SELECT t - t % 3600000 + 3600000 AS window_end, count(DISTINCT user_id) AS uv_count
FROM ub WHERE behavior = 'pv' GROUP BY t - t % 3600000 + 3600000"""


@register("q07_unique_visitors", Q7_SQL)
def q07(spark: SparkSession, sf_dir: str) -> DataFrame:
    pv = user_behavior(spark, sf_dir, "pv").filter(F.col("behavior") == "pv")
    return unique_visitors(pv, "ts", "1 hour", "user_id")


def _q8_sql(bits: int) -> str:
    return f"""WITH {UB_SQL}
SELECT t - t % 3600000 + 3600000 AS window_end,
       count(DISTINCT {poly_hash_sql('CAST(user_id AS VARCHAR)', 67, bits)}) AS uv_count
FROM ub WHERE behavior = 'pv' GROUP BY t - t % 3600000 + 3600000"""


Q8_SQL = _q8_sql(29)


@register("q08_unique_visitors_bitmap", Q8_SQL)
def q08(spark: SparkSession, sf_dir: str) -> DataFrame:
    pv = user_behavior(spark, sf_dir, "pv").filter(F.col("behavior") == "pv")
    return unique_visitors_bitmap(pv, "ts", "1 hour", "user_id", bits=29)


@register("q08b_unique_visitors_bitmap_5bits", _q8_sql(5))
def q08b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 32-slot bitmap, so hash collisions merge users and the count differs from Q7."""
    pv = user_behavior(spark, sf_dir, "pv").filter(F.col("behavior") == "pv")
    return unique_visitors_bitmap(pv, "ts", "1 hour", "user_id", bits=5)

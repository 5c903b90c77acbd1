"""Login failure detection (Q13-Q15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventflow.functions.text import MSG_LOGIN_PATTERN
from eventflow.functions.time import duration_ms
from eventflow.operators.patterns import login_fail_burst, login_fail_consecutive, match_next
from eventflow.plans.registry import register
from eventflow.sources.tables import login_events

# Scaled to the driver tables (a user logs an event every few hours): 6 h instead of 2 s.
GAP = "6 hours"
GAP_US = duration_ms(GAP) * 1000
GAP_S = duration_ms(GAP) // 1000

LG_SQL = """lg AS (
  SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS et,
         epoch_us(ts) AS t FROM events),
o AS (SELECT *, lag(et) OVER w AS pt, lag(t) OVER w AS ptt FROM lg
      WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))"""

Q13_SQL = f"""WITH RECURSIVE {LG_SQL},
f AS (SELECT user_id, event_id, t,
             sum(CASE WHEN pt IS NULL OR pt <> 'fail' OR t - ptt > {GAP_US} THEN 1 ELSE 0 END)
               OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS seg
      FROM o WHERE et = 'fail'),
nx AS (SELECT user_id, seg, t,
              min(t) OVER (PARTITION BY user_id, seg ORDER BY t
                           RANGE BETWEEN {GAP_US + 1} FOLLOWING AND UNBOUNDED FOLLOWING) AS nt FROM f),
starts AS (
  SELECT user_id, seg, min(t) AS s FROM f GROUP BY user_id, seg
  UNION ALL
  SELECT st.user_id, st.seg, nx.nt FROM starts st
  JOIN nx ON nx.user_id = st.user_id AND nx.seg = st.seg AND nx.t = st.s
  WHERE nx.nt IS NOT NULL)
SELECT st.user_id, st.s // 1000 AS first_fail, max(f.t) // 1000 AS last_fail,
       'Login fails in {GAP_S} seconds ' || count(*) || ' times' AS msg
FROM starts st JOIN f ON f.user_id = st.user_id AND f.seg = st.seg AND f.t >= st.s AND f.t <= st.s + {GAP_US}
GROUP BY st.user_id, st.seg, st.s HAVING count(*) >= 2"""


@register("q13_login_fail_burst", Q13_SQL)
def q13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return login_fail_burst(login_events(spark, sf_dir), window=GAP, max_failed=2)


Q14_SQL = f"""WITH {LG_SQL}
SELECT user_id, ptt // 1000 AS first_fail, t // 1000 AS last_fail, 'Login fails in {GAP_S} seconds' AS msg
FROM o WHERE et = 'fail' AND pt = 'fail' AND t - ptt < {GAP_US}"""


@register("q14_login_fail_consecutive", Q14_SQL)
def q14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return login_fail_consecutive(login_events(spark, sf_dir), gap=GAP)


Q15_SQL = f"""WITH {LG_SQL}
SELECT user_id, ptt // 1000 AS first_ts, t // 1000 AS second_ts, '{MSG_LOGIN_PATTERN}' AS msg
FROM o WHERE et = 'fail' AND pt = 'fail' AND t - ptt < {GAP_US}"""


@register("q15_login_fail_next", Q15_SQL)
def q15(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_next(login_events(spark, sf_dir), "user_id", "ts", "event_type", "fail", "fail", GAP)

"""Order payment detection (Q16-Q18) and payment/receipt matching (Q19, Q20)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.text import MSG_ORDER_PAID, MSG_ORDER_TIMEOUT
from eventflow.functions.time import duration_ms
from eventflow.operators.joins import interval_join, reconcile
from eventflow.operators.patterns import match_followed_by, order_deadline_verdict, pay_event_verdict
from eventflow.plans.registry import register
from eventflow.sources.tables import order_events, pay_events, receipt_events

# Scaled to the driver tables: a 1-day payment deadline instead of 15 minutes.
DEADLINE = "1 day"
D_MS = duration_ms(DEADLINE)
D_US = D_MS * 1000
# Reconciliation waits and the interval-join bound, in days instead of seconds.
PAY_WAIT, RECEIPT_WAIT = "60 days", "30 days"
TX_BOUND = "30 days"

OE_SQL = """oe AS (
  SELECT event_id, user_id AS order_id, CASE WHEN event_type = 'signup' THEN 'create' ELSE 'pay' END AS et,
         CASE WHEN event_type = 'signup' THEN 0 ELSE 1 END AS r, epoch_us(ts) AS t
  FROM events WHERE event_type IN ('signup', 'purchase'))"""

_MSG = f"""CASE WHEN {{ok}} THEN '{MSG_ORDER_PAID}' ELSE '{MSG_ORDER_TIMEOUT}' END"""

Q16_SQL = f"""WITH {OE_SQL},
m AS (SELECT c.order_id, c.event_id, c.t, min(p.t) AS pt
      FROM (SELECT * FROM oe WHERE et = 'create') c
      LEFT JOIN (SELECT * FROM oe WHERE et = 'pay') p
        ON p.order_id = c.order_id AND p.t >= c.t AND p.t < c.t + {D_US}
      GROUP BY c.order_id, c.event_id, c.t)
SELECT order_id, t // 1000 AS first_ts, pt // 1000 AS second_ts,
       CASE WHEN pt IS NOT NULL THEN 'paid' ELSE 'timeout' END AS verdict,
       {_MSG.format(ok='pt IS NOT NULL')} AS result_msg
FROM m"""


@register("q16_order_followed_by", Q16_SQL)
def q16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_followed_by(order_events(spark, sf_dir), "order_id", "ts", "event_type",
                             "create", "pay", DEADLINE)


Q17_SQL = f"""WITH {OE_SQL},
x AS (SELECT *,
        max(CASE WHEN et = 'pay' THEN t END) OVER (PARTITION BY order_id ORDER BY t, r, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_pay,
        max(CASE WHEN et = 'create' THEN t + {D_US} END) OVER (PARTITION BY order_id ORDER BY t
            RANGE BETWEEN UNBOUNDED PRECEDING AND {D_US + 1} PRECEDING) AS last_exp
      FROM oe),
c AS (SELECT * FROM x WHERE et = 'create'
        AND NOT (last_pay IS NOT NULL AND (last_exp IS NULL OR last_pay > last_exp))),
m AS (SELECT c.order_id, c.event_id, c.t, min(p.t) AS pt
      FROM c LEFT JOIN (SELECT * FROM oe WHERE et = 'pay') p
        ON p.order_id = c.order_id AND p.t >= c.t AND p.t < c.t + {D_US}
      GROUP BY c.order_id, c.event_id, c.t)
SELECT order_id, t // 1000 AS create_ts, t // 1000 + {D_MS} AS deadline,
       CASE WHEN pt IS NOT NULL THEN 'paid' ELSE 'timeout' END AS verdict,
       {_MSG.format(ok='pt IS NOT NULL')} AS result_msg
FROM m"""


@register("q17_order_deadline_verdict", Q17_SQL)
def q17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_deadline_verdict(order_events(spark, sf_dir), "order_id", "ts", "event_type", DEADLINE)


Q18_SQL = f"""WITH {OE_SQL},
y AS (SELECT *, lag(et, 1) OVER w AS p1, lag(t, 1) OVER w AS p1t, lag(et, 2) OVER w AS p2 FROM oe
      WINDOW w AS (PARTITION BY order_id ORDER BY t, r, event_id)),
p AS (SELECT *,
        (p1 IS NULL OR p1 <> 'create' OR p2 IS NULL OR p2 <> 'pay') AS head,
        CASE WHEN p1 IS NULL OR p1 <> 'create' THEN TRUE ELSE t < p1t + {D_US} END AS val
      FROM y WHERE et = 'pay'),
s AS (SELECT *, sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY order_id ORDER BY t, event_id
        ROWS UNBOUNDED PRECEDING) AS seg FROM p),
v AS (SELECT *, bool_or(val) OVER (PARTITION BY order_id, seg ORDER BY t, event_id
        ROWS UNBOUNDED PRECEDING) AS ok FROM s)
SELECT order_id, t // 1000 AS pay_ts, CASE WHEN ok THEN 'success' ELSE 'timeout' END AS verdict,
       {_MSG.format(ok='ok')} AS result_msg
FROM v"""


@register("q18_pay_event_verdict", Q18_SQL)
def q18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pay_event_verdict(order_events(spark, sf_dir), "order_id", "ts", "event_type", DEADLINE)


TX_SQL = """pays AS (SELECT CAST(o_orderkey AS VARCHAR) AS tx_id, o_orderkey AS order_id, o_orderdate AS ts FROM orders),
rc AS (SELECT CAST(l_orderkey AS VARCHAR) AS tx_id,
              CASE WHEN l_orderkey % 2 = 0 THEN 'wechat' ELSE 'alipay' END AS pay_channel,
              min(l_shipdate) AS ts
       FROM lineitem GROUP BY l_orderkey)"""

Q19_SQL = f"""WITH {TX_SQL}
SELECT coalesce(p.tx_id, r.tx_id) AS tx_id,
       CASE WHEN p.tx_id IS NOT NULL AND r.tx_id IS NOT NULL THEN 'matched'
            WHEN p.tx_id IS NOT NULL THEN 'unmatched_pay' ELSE 'unmatched_receipt' END AS verdict,
       p.order_id AS pay_order_id, epoch_us(p.ts) // 1000 AS pay_ts,
       r.pay_channel AS receipt_pay_channel, epoch_us(r.ts) // 1000 AS receipt_ts
FROM pays p FULL OUTER JOIN rc r
  ON p.tx_id = r.tx_id AND r.ts BETWEEN p.ts - INTERVAL 30 DAY AND p.ts + INTERVAL 60 DAY"""


@register("q19_reconcile", Q19_SQL)
def q19(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = reconcile(pay_events(spark, sf_dir), receipt_events(spark, sf_dir), "tx_id", "ts", PAY_WAIT, RECEIPT_WAIT)
    return j.select("tx_id", "verdict", "pay_order_id", F.unix_millis("pay_ts").alias("pay_ts"),
                    "receipt_pay_channel", F.unix_millis("receipt_ts").alias("receipt_ts"))


Q20_SQL = f"""WITH {TX_SQL}
SELECT p.tx_id AS tx_id, p.order_id AS order_id, epoch_us(p.ts) // 1000 AS pay_ts,
       r.pay_channel AS pay_channel, epoch_us(r.ts) // 1000 AS receipt_ts
FROM pays p JOIN rc r
  ON p.tx_id = r.tx_id AND r.ts BETWEEN p.ts - INTERVAL 30 DAY AND p.ts + INTERVAL 30 DAY"""


@register("q20_interval_join", Q20_SQL)
def q20(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = interval_join(pay_events(spark, sf_dir), receipt_events(spark, sf_dir), "tx_id", "ts", "ts",
                      "-" + TX_BOUND, TX_BOUND, how="inner", left_prefix="p_", right_prefix="r_")
    return j.select(F.col("p_tx_id").alias("tx_id"), F.col("p_order_id").alias("order_id"),
                    F.unix_millis("p_ts").alias("pay_ts"), F.col("r_pay_channel").alias("pay_channel"),
                    F.unix_millis("r_ts").alias("receipt_ts"))

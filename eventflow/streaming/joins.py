"""Stream-stream joins (JN1, JN2, ST13/ST14 on streams).

The batch operators already express the time bound in the join condition; with a
watermark on both inputs Spark's symmetric hash join evicts state by that bound and
emits the outer (unmatched) rows once the watermark passes the deadline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.functions.text import MSG_ORDER_PAID, MSG_ORDER_TIMEOUT
from eventflow.functions.time import duration_ms
from eventflow.operators.joins import interval_join, reconcile
from eventflow.streaming.windows import with_event_time


def stream_interval_join(left: DataFrame, right: DataFrame, key: str, ts: str, lower, upper,
                         delay="0 seconds", how: str = "inner") -> DataFrame:
    return interval_join(with_event_time(left, ts, delay), with_event_time(right, ts, delay),
                         key, ts, ts, lower, upper, how=how)


def stream_reconcile(pays: DataFrame, receipts: DataFrame, key: str = "tx_id", ts: str = "ts",
                     pay_wait="51 seconds", receipt_wait="5 seconds", delay="0 seconds") -> DataFrame:
    """Full-outer interval join: matched pairs at once, unmatched sides after their wait."""
    return reconcile(with_event_time(pays, ts, delay), with_event_time(receipts, ts, delay),
                     key, ts, pay_wait, receipt_wait)


def stream_followed_by(df: DataFrame, key: str = "order_id", ts: str = "ts", type_col: str = "event_type",
                       first: str = "create", second: str = "pay", within="15 minutes",
                       tiebreak: str = "event_id", delay="0 seconds") -> DataFrame:
    """Streaming Q16 as an ordered fold (no create x pay pairs are formed).

    Per key, creates wait in state; the first later pay resolves every waiting create
    (paid if it came within ``within``), and a create whose deadline the watermark has
    passed times out - no pay before it can still arrive. State holds only the creates
    of the last ``within``.
    """
    from eventflow.streaming.state import ordered_fold

    w_us = duration_ms(within) * 1000

    def row(carry, c, pay_t):
        ok = pay_t is not None and pay_t - c[0] < w_us
        return (carry["k"], c[0] // 1000, pay_t // 1000 if ok else None, "paid" if ok else "timeout",
                MSG_ORDER_PAID if ok else MSG_ORDER_TIMEOUT)

    def step(carry, r):
        carry["k"] = r[key]
        waiting = carry.setdefault("waiting", [])
        if r[type_col] == first:
            waiting.append([r["_t"], r[tiebreak]])
            return []
        out = [row(carry, c, r["_t"]) for c in waiting]
        carry.clear()   # nothing waits: the key's state is dropped
        return out

    def on_watermark(carry, wm_us):
        waiting = carry.get("waiting") or []
        done = [c for c in waiting if c[0] + w_us <= wm_us]
        out = [row(carry, c, None) for c in done]
        carry["waiting"] = [c for c in waiting if c[0] + w_us > wm_us]
        if not carry["waiting"]:
            carry.clear()
        return out

    def wake_at(carry):
        waiting = carry.get("waiting") or []
        return min(c[0] for c in waiting) + w_us if waiting else None

    key_type = dict(df.dtypes)[key]
    d = (df.filter(F.col(type_col).isin(first, second))
           .withColumn("_r", F.when(F.col(type_col) == first, F.lit(0)).otherwise(F.lit(1))))
    fold = ordered_fold(d, [key], ts, tiebreak, [type_col], {}, step,
                        f"{key} {key_type}, first_ts long, second_ts long, verdict string, result_msg string",
                        delay, on_watermark=on_watermark, wake_at=wake_at, rank="_r")
    return fold

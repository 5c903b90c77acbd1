"""Keyed, event-time ordered folds on streams (ST7-ST10, ST12) with ``applyInPandasWithState``.

Rows are buffered per key in the state store and released in (ts, tie-break) order
once the watermark has passed them, so the fold sees the same order as the batch
operators; an event-time timeout re-invokes the key when the watermark moves past
its oldest buffered row. The fold itself (``step``) is a small per-row function:
``step(carry: dict, row: dict) -> list[tuple]`` that updates ``carry`` in place.

Only the key's buffered rows and its small carry live in state; rows behind the
watermark are released and dropped from state every micro-batch. A call of Python costs
some milliseconds a group and trigger, so where keys are many and small, ``buckets``
groups of keys share a call and a state row.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from eventflow.functions.text import (MSG_CLICK_CAP, MSG_LOGIN_BURST, MSG_LOGIN_PATTERN, MSG_ORDER_PAID,
                                      MSG_ORDER_TIMEOUT, seconds_text)
from eventflow.functions.time import duration_ms
from eventflow.streaming.windows import with_event_time

STATE_SCHEMA = "pending string, carry string"
BUCKET_SCHEMA = "pending binary, carries binary"


def ordered_fold(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, fields: Sequence[str],
                 init: dict, step: Callable[[dict, dict], list], out_schema: str,
                 delay="0 seconds", closes_at: Callable[[tuple], int] | None = None,
                 on_watermark: Callable[[dict, int], list] | None = None,
                 wake_at: Callable[[dict], int | None] | None = None,
                 rank: str | None = None, buckets: int | None = None) -> DataFrame:
    """Apply ``step`` to each key's rows in event-time order, as the watermark allows.

    ``closes_at(group_key) -> epoch us``: after that event time the group gets no more rows
    (e.g. the end of its day); its state is removed once the watermark passes it.
    ``on_watermark(carry, wm_us) -> rows`` runs after each release (e.g. to close a window
    the watermark has passed) and ``wake_at(carry) -> epoch us`` asks for a timeout then.
    ``rank`` names a column ordering rows with equal time before the tie-break (type rank).
    Rows without a time are in no order and left out; null ranks and tie-breaks come first, as in ``orderBy``.
    ``buckets``: so many groups hold the keys, by their hash (not with ``closes_at``); each key keeps a carry of its
    own. A bucket is read and written whole: choose them for some hundred rows in state each, and keep their number
    for as long as the checkpoint is used.
    """
    if buckets is not None and closes_at is not None:
        raise ValueError("closes_at goes by the group, so it takes no buckets")
    cols = list(dict.fromkeys([*keys, *fields, *([rank] if rank else []), tiebreak]))
    d = with_event_time(df.where(F.col(ts).isNotNull()), ts, delay).select(*cols, ts, F.unix_micros(ts).alias("_t"))
    out_cols = [c.strip().split(" ")[0] for c in out_schema.split(",")]
    fields_of_row = [*cols, "_t"]

    def fn(key, pdfs, state):
        if state.exists:
            pending_s, carry_s = state.get
            pending, carry = json.loads(pending_s), json.loads(carry_s)
        else:
            pending, carry = [], dict(init)
        for pdf in pdfs:
            pending.extend(dict(zip(fields_of_row, row)) for row in zip(*(pdf[c].tolist() for c in fields_of_row)))
        wm_us = state.getCurrentWatermarkMs() * 1000
        pending.sort(key=lambda r: (r["_t"], _nulls_first(r[rank]) if rank else (), _nulls_first(r[tiebreak])))
        ready = [r for r in pending if r["_t"] <= wm_us]
        rest = [r for r in pending if r["_t"] > wm_us]
        out = []
        for r in ready:
            out.extend(step(carry, r))
        if on_watermark is not None:
            out.extend(on_watermark(carry, wm_us))
        close_us = closes_at(key) if closes_at else None
        wake_us = [u for u in ((rest[0]["_t"] if rest else None), close_us,
                               wake_at(carry) if wake_at else None) if u is not None and u >= wm_us]
        if not rest and (carry == init or (close_us is not None and wm_us >= close_us)):
            state.remove()
        else:
            state.update((json.dumps(rest, default=_plain), json.dumps(carry, default=_plain)))
            if wake_us:
                state.setTimeoutTimestamp(min(wake_us) // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=out_cols)

    def bucket_fn(key, pdfs, state):
        pending, carries = map(_unpack, state.get) if state.exists else (None, {})
        pending = pending or [[] for _ in fields_of_bucket]
        for pdf in pdfs:
            for have, c in zip(pending, fields_of_bucket):
                have.extend(pdf[c].tolist())
        wm_us = state.getCurrentWatermarkMs() * 1000
        ready, rest = [], []
        for row in zip(*pending):
            (ready if row[at_t] <= wm_us else rest).append(row)
        ready.sort(key=lambda r: (r[at_t], _nulls_first(r[at_rank]) if rank else (), _nulls_first(r[at_tie])))
        out = []
        for row in ready:
            carry = carries.setdefault(row[0], dict(init))
            out.extend(step(carry, dict(zip(fields_of_bucket, row))))
        if on_watermark is not None:
            for carry in carries.values():
                out.extend(on_watermark(carry, wm_us))
        carries = {k: carry for k, carry in carries.items() if carry != init}
        wake_us = [row[at_t] for row in rest]
        if wake_at is not None:
            wake_us += [u for u in map(wake_at, carries.values()) if u is not None and u >= wm_us]
        if not rest and not carries:
            state.remove()
        else:
            state.update((_pack(list(zip(*rest))), _pack(carries)))
            if wake_us:
                state.setTimeoutTimestamp(min(wake_us) // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=out_cols)

    if buckets is not None:
        fields_of_bucket = ["_key", *fields_of_row]
        at_t, at_tie, at_rank = (fields_of_bucket.index(c) if c else None for c in ("_t", tiebreak, rank))
        key_text = F.to_json(F.array(*[F.col(k).cast("string") for k in keys]))
        d = d.withColumns({"_key": key_text, "_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets))})
        return d.groupBy("_bucket").applyInPandasWithState(bucket_fn, out_schema, BUCKET_SCHEMA, "append",
                                                           GroupStateTimeout.EventTimeTimeout)
    return d.groupBy(*keys).applyInPandasWithState(fn, out_schema, STATE_SCHEMA, "append",
                                                   GroupStateTimeout.EventTimeTimeout)


def _pack(value) -> bytes:
    return zlib.compress(json.dumps(value, default=_plain).encode(), 1)


def _unpack(blob: bytes):
    return json.loads(zlib.decompress(blob))


def _nulls_first(v) -> tuple:
    return (True, v) if isinstance(v, (str, int)) or not pd.isna(v) else (False,)


def _plain(o):
    if hasattr(o, "item"):
        return o.item()
    return str(o)


# ------------------------------------------------------------------ folds of the reference
def stream_match_next(df: DataFrame, key: str = "user_id", ts: str = "ts", type_col: str = "event_type",
                      first: str = "fail", second: str = "fail", within="2 seconds",
                      tiebreak: str = "event_id", delay="5 seconds", message: str = MSG_LOGIN_PATTERN) -> DataFrame:
    """Streaming Q15 (strict ``first`` next ``second`` within): state = the previous event."""
    w_us = duration_ms(within) * 1000

    def step(carry, r):
        out = []
        if (r[type_col] == second and carry.get("type") == first
                and r["_t"] - carry["t"] < w_us):
            out.append((r[key], carry["t"] // 1000, r["_t"] // 1000, message))
        carry["type"], carry["t"] = r[type_col], r["_t"]
        return out

    def on_watermark(carry, wm_us):
        if carry and carry["t"] + w_us <= wm_us:   # too old to pair with any later event
            carry.clear()
        return []

    def wake_at(carry):
        return carry["t"] + w_us if carry else None

    key_type = dict(df.dtypes)[key]
    return ordered_fold(df, [key], ts, tiebreak, [type_col], {}, step,
                        f"{key} {key_type}, first_ts long, second_ts long, msg string", delay,
                        on_watermark=on_watermark, wake_at=wake_at)


def stream_click_cap(df: DataFrame, keys: Sequence[str] = ("user_id", "ad_id"), ts: str = "ts",
                     tiebreak: str = "event_id", max_count: int = 100, policy: str = "as_written",
                     delay="0 seconds") -> DataFrame:
    """Streaming Q12a: number each key's clicks per UTC day and tag pass / blacklist / dropped.

    State is keyed by (keys, day): the count restarts with the day, a hot key's days are
    separate groups, and a day's state is dropped once its rows are released.
    """
    warn_at = max_count + 2
    msg = MSG_CLICK_CAP.format(max_count=max_count)

    def step(carry, r):
        carry["n"] = carry.get("n", 0) + 1
        n = carry["n"]
        if n == warn_at:
            verdict, text = "blacklist", msg
        elif policy == "drop_all" and n > warn_at:
            verdict, text = "dropped", None
        else:
            verdict, text = "pass", None
        return [(*[r[k] for k in keys], r[tiebreak], r["_t"] // 1000, n, verdict, text)]

    types = dict(df.dtypes)
    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], f"{tiebreak} {types[tiebreak]}",
                        "ts_ms long", "click_no long", "verdict string", "msg string"])
    by_day = df.withColumn("_day", F.to_date(F.col(ts)))

    def day_end(group_key: tuple) -> int:
        day = group_key[-1]
        return (day.toordinal() - _EPOCH_ORDINAL + 1) * 86_400_000_000

    return ordered_fold(by_day, [*keys, "_day"], ts, tiebreak, [], {}, step, schema, delay, day_end)


_EPOCH_ORDINAL = __import__("datetime").date(1970, 1, 1).toordinal()


def stream_pay_event_verdict(df: DataFrame, key: str = "order_id", ts: str = "ts", type_col: str = "event_type",
                             within="15 minutes", tiebreak: str = "event_id", create: str = "create",
                             pay: str = "pay", delay="0 seconds") -> DataFrame:
    """Streaming Q18: the pay-time state machine as a fold (state: paid flag, deadline)."""
    w_us = duration_ms(within) * 1000

    def step(carry, r):
        if r[type_col] == create:
            if carry.get("paid"):
                carry["paid"], carry["deadline"] = False, None   # swallowed
            else:
                carry["paid"], carry["deadline"] = False, r["_t"] + w_us
            return []
        if r[type_col] != pay:
            return []
        deadline = carry.get("deadline")
        ok = deadline is None or r["_t"] < deadline
        carry["paid"], carry["deadline"] = ok, None
        return [(r[key], r["_t"] // 1000, "success" if ok else "timeout",
                 MSG_ORDER_PAID if ok else MSG_ORDER_TIMEOUT)]

    key_type = dict(df.dtypes)[key]
    d = (df.filter(F.col(type_col).isin(create, pay))
           .withColumn("_r", F.when(F.col(type_col) == create, F.lit(0)).otherwise(F.lit(1))))
    return ordered_fold(d, [key], ts, tiebreak, [type_col], {}, step,
                        f"{key} {key_type}, pay_ts long, verdict string, result_msg string", delay,
                        rank="_r")


def stream_login_fail_burst(df: DataFrame, key: str = "user_id", ts: str = "ts", type_col: str = "event_type",
                            window="2 seconds", max_failed: int = 2, tiebreak: str = "event_id",
                            delay="5 seconds") -> DataFrame:
    """Streaming Q13: greedy windows per success-free run; a window is emitted when a success
    or a later fail ends it, or when the watermark passes its start + window."""
    w_ms = duration_ms(window)
    w_us = w_ms * 1000
    head, tail = MSG_LOGIN_BURST.split("{count}")
    head = head.format(seconds=seconds_text(w_ms))

    def close(carry):
        out = []
        if carry.get("s") is not None and carry["n"] >= max_failed:
            out.append((carry["k"], carry["s"] // 1000, carry["e"] // 1000, f"{head}{carry['n']}{tail}"))
        carry.clear()   # no open window: the key's state is dropped
        return out

    def step(carry, r):
        if r[type_col] != "fail":
            return close(carry)
        if carry.get("s") is not None and r["_t"] <= carry["s"] + w_us:
            carry["e"], carry["n"] = r["_t"], carry["n"] + 1
            return []
        out = close(carry)
        carry.update(k=r[key], s=r["_t"], e=r["_t"], n=1)
        return out

    def on_watermark(carry, wm_us):
        if carry.get("s") is not None and wm_us > carry["s"] + w_us:
            return close(carry)
        return []

    def wake_at(carry):
        return carry["s"] + w_us + 1 if carry.get("s") is not None else None

    key_type = dict(df.dtypes)[key]
    return ordered_fold(df, [key], ts, tiebreak, [type_col], {}, step,
                        f"{key} {key_type}, first_fail long, last_fail long, msg string", delay,
                        on_watermark=on_watermark, wake_at=wake_at)


def stream_order_deadline_verdict(df: DataFrame, key: str = "order_id", ts: str = "ts",
                                  type_col: str = "event_type", within="15 minutes",
                                  tiebreak: str = "event_id", create: str = "create", pay: str = "pay",
                                  delay="0 seconds") -> DataFrame:
    """Streaming Q17, the batch definition as a fold: a create is absorbed when the key's last
    pay came after the last expired deadline (of any earlier create); otherwise it waits for
    the first later pay (paid if before its deadline) or times out when the watermark passes
    the deadline."""
    w_us = duration_ms(within) * 1000
    w_ms = w_us // 1000

    def verdict_row(k, c_t, ok):
        return (k, c_t // 1000, c_t // 1000 + w_ms, "paid" if ok else "timeout",
                MSG_ORDER_PAID if ok else MSG_ORDER_TIMEOUT)

    def step(carry, r):
        t = r["_t"]
        carry["k"] = r[key]
        if r[type_col] == pay:
            out = [verdict_row(r[key], c, t - c < w_us) for c in carry.get("waiting", [])]
            carry["waiting"] = []
            carry["last_pay"] = t
            return out
        # deadlines of earlier creates that expired before this create (c' + W < t)
        recent = carry.get("recent", [])
        expired = [c for c in recent if c + w_us < t]
        if expired:
            carry["exp"] = max(carry.get("exp") or 0, max(expired) + w_us)
        carry["recent"] = [c for c in recent if c + w_us >= t] + [t]
        last_pay, exp = carry.get("last_pay"), carry.get("exp")
        if last_pay is not None and (exp is None or last_pay > exp):
            return []                                   # absorbed: a pay is pending
        carry.setdefault("waiting", []).append(t)
        return []

    def on_watermark(carry, wm_us):
        waiting = carry.get("waiting", [])
        done = [c for c in waiting if c + w_us <= wm_us]
        carry["waiting"] = [c for c in waiting if c + w_us > wm_us]
        return [verdict_row(carry["k"], c, False) for c in done]

    def wake_at(carry):
        waiting = carry.get("waiting", [])
        return min(waiting) + w_us if waiting else None

    key_type = dict(df.dtypes)[key]
    d = (df.filter(F.col(type_col).isin(create, pay))
           .withColumn("_r", F.when(F.col(type_col) == create, F.lit(0)).otherwise(F.lit(1))))
    return ordered_fold(d, [key], ts, tiebreak, [type_col], {}, step,
                        f"{key} {key_type}, create_ts long, deadline long, verdict string, result_msg string",
                        delay, on_watermark=on_watermark, wake_at=wake_at, rank="_r")

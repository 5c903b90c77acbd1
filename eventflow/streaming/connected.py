"""Two connected streams with one keyed state (ST15, the two-input process function of section 2.10).

Both inputs become one tagged stream, whose rows reach a key in event-time order (``streaming.state.ordered_fold``).
The user gives a function for a row of either side and one for timers; all three see the same state and may emit
rows under tags, each tag a table with columns of its own. There is one timer a side: it fires in its place among the
rows (after all rows of its own time), or when the watermark has passed it and no row came.

A row reaches its function as a dict of its columns (times and decimals as JSON text); ``ctx.time`` is its time in
epoch microseconds. State holds plain JSON values; a key whose state is empty and that has no timer is dropped.
Rows without a time are left out; a null key is a key; rows of equal time come left before right, then by their text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.functions.time import duration_ms
from eventflow.streaming.state import ordered_fold

LEFT, RIGHT = "left", "right"


class Context:
    """What a handler sees: ``state`` (a dict it changes), ``time``, and where it sends rows and sets timers."""

    def __init__(self, carry: dict, out: list):
        self.state = carry.setdefault("state", {})
        self.time = 0
        self._timers, self._out, self._fired = carry.setdefault("timers", {}), out, False

    def emit(self, tag: str, **row) -> None:
        self._out.append((tag, json.dumps(row)))

    def set_timer(self, side: str, at: int | None) -> None:
        """The side's timer is at ``at`` (microseconds) from now on; None: it has none."""
        if at is None:
            self._timers.pop(side, None)
        elif at < self.time or self._fired and at == self.time:
            raise ValueError(f"a timer at {at} is over at {self.time}")
        else:
            self._timers[side] = at


def connected_fold(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, on_left: Callable, on_right: Callable,
                   on_timer: Callable, outputs: dict[str, str], delay="0 seconds", buckets: int | None = None) -> DataFrame:
    """``tag`` and a struct column per entry of ``outputs`` (tag: DDL), set where the row has that tag.

    ``on_left(ctx, row)``, ``on_right(ctx, row)``, ``on_timer(ctx, side)``. ``tagged`` takes one output. ``buckets``:
    so many groups hold the keys' states (see ``ordered_fold``); without, each key is a group."""
    def side(df: DataFrame, number: int) -> DataFrame:
        row = F.to_json(F.struct(*[c for c in df.columns if c != ts]), {"ignoreNullFields": "false"})
        return df.select(*keys, F.col(ts).alias("_ts"), F.lit(number).alias("_side"), row.alias("_row"))

    def fire(ctx: Context, before: int) -> None:
        while ctx._timers:
            name, at = min(ctx._timers.items(), key=lambda x: (x[1], x[0]))
            if at >= before:
                break
            del ctx._timers[name]
            ctx.time, ctx._fired = at, True
            on_timer(ctx, name)
        ctx._fired = False

    def advance(carry: dict, before: int, row: dict | None) -> list:
        out = []
        ctx = Context(carry, out)
        fire(ctx, before)
        if row is not None:
            ctx.time = before
            (on_right if row["_side"] else on_left)(ctx, json.loads(row["_row"]))
        if not ctx.state and not ctx._timers:
            carry.clear()
        return out

    fold = ordered_fold(side(left, 0).unionByName(side(right, 1)), list(keys), "_ts", "_row", ["_side", "_row"], {},
                        lambda carry, row: advance(carry, row["_t"], row), "tag string, row string", delay, rank="_side",
                        on_watermark=lambda carry, mark: advance(carry, mark, None) if carry else [],
                        wake_at=lambda carry: min(carry["timers"].values()) if carry.get("timers") else None, buckets=buckets)
    return fold.select("tag", *[F.when(F.col("tag") == t, F.from_json("row", ddl)).alias(t) for t, ddl in outputs.items()])


def tagged(df: DataFrame, tag: str) -> DataFrame:
    """The rows of one output, with its own columns."""
    return df.where(F.col("tag") == tag).select(f"{tag}.*")


MATCHED, UNMATCHED_PAY, UNMATCHED_RECEIPT = "matched", "unmatched_pay", "unmatched_receipt"


def reconcile_connected(pays: DataFrame, receipts: DataFrame, key: str = "tx_id", ts: str = "ts", pay_wait="51 seconds",
                        receipt_wait="5 seconds", delay="0 seconds", buckets: int | None = None) -> DataFrame:
    """JN2 as two connected streams: a pay waits ``pay_wait`` for receipts, a receipt ``receipt_wait`` for pays; every
    pair is given, at its later row, and who has met nobody when the wait is over goes to an output of its own.

    Tags matched, unmatched_pay, unmatched_receipt with ``pay_*`` and ``receipt_*`` (times in epoch ms). Empty keys
    match nothing (FLT3) and are left out. State: the rows whose wait is not over."""
    waits = {"pay": duration_ms(pay_wait) * 1000, "receipt": duration_ms(receipt_wait) * 1000}
    timers = {"pay": LEFT, "receipt": RIGHT}

    def named(side: str, t: int, row: dict) -> dict:
        return {f"{side}_{c}": v for c, v in row.items()} | {f"{side}_{ts}": t // 1000}

    def arrive(side: str, other: str) -> Callable:
        def run(ctx: Context, row: dict) -> None:
            mine = [ctx.time, row, False]
            for waiting in ctx.state.get(other, []):  # only rows whose wait is not over are here
                ctx.emit(MATCHED, **named(side, ctx.time, row), **named(other, waiting[0], waiting[1]))
                waiting[2] = mine[2] = True
            ctx.state.setdefault(side, []).append(mine)
            ctx.set_timer(timers[side], ctx.state[side][0][0] + waits[side])
        return run

    def on_timer(ctx: Context, which: str) -> None:
        side = "pay" if which == LEFT else "receipt"
        rows = ctx.state.pop(side)
        for t, row, met in (r for r in rows if r[0] + waits[side] <= ctx.time):
            if not met:
                ctx.emit(f"unmatched_{side}", **named(side, t, row))
        rest = [r for r in rows if r[0] + waits[side] > ctx.time]
        if rest:
            ctx.state[side] = rest
            ctx.set_timer(which, rest[0][0] + waits[side])

    pays, receipts = (d.where(F.col(key) != "") for d in (pays, receipts))
    ddl = {s: ", ".join(f"`{s}_{f}` {'long' if f == ts else kind}" for f, kind in d.dtypes) for s, d in (("pay", pays), ("receipt", receipts))}
    return connected_fold(pays, receipts, [key], ts, arrive("pay", "receipt"), arrive("receipt", "pay"), on_timer,
                          {MATCHED: f"{ddl['pay']}, {ddl['receipt']}", UNMATCHED_PAY: ddl["pay"], UNMATCHED_RECEIPT: ddl["receipt"]}, delay, buckets)


def verdicts(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The outputs of ``reconcile_connected`` as one table: verdict and ``columns``, null where an output has none."""
    def column(name: str):
        return F.coalesce(*[F.col(f"{t}.{name}") for t in (MATCHED, UNMATCHED_PAY, UNMATCHED_RECEIPT) if name in found.select(f"{t}.*").columns]).alias(name)
    return found.select(F.col("tag").alias("verdict"), *[column(c) for c in columns])

"""Sliding windows on streams from pane partials in keyed state (ST5), without expanding events or panes into windows.

A window of an hour that slides by five seconds holds each event 720 times. Here every Arrow batch is first
counted per (keys, pane of one slide), before the shuffle; a state per (keys, time block) keeps the panes that
still count - a ring of at most one window and one block, in two typed arrays - and gives, per trigger, the
*stretches* of window ends over which the value does not change: one row (first end, last end, value) instead of
one per window. ``sequence`` turns stretches into the output rows, which is the only place where rows multiply.

A pane goes to the one or two blocks that its window ends fall in, so a hot key's history is spread over blocks,
and a block's state ends when its last window has closed. Results are those of ``window(ts, size, slide)`` with a
watermark in append mode: each window once, when the watermark has passed its end; a late event counts in the
windows that are still open. (The state operator's own watermark lags by one window, so that such events reach
it; what it gives follows the true one.) Every live group is called on each advance of the watermark and gives all
its windows up to there, so that all rows of a window leave in the same trigger (``top_n_writer`` relies on it).
Rows without a time are in no window; null keys are keys.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from eventflow.functions.time import duration_ms

STATE = "ends array<bigint>, counts array<bigint>, done bigint"


def stretches(ends: np.ndarray, counts: np.ndarray, first: int, last: int, size: int, slide: int) -> list[tuple[int, int, int]]:
    """(first end, last end, count) of the window ends from ``first`` to ``last`` whose count is not 0. A pane
    that ends at p is in the windows that end at p to p + size - slide."""
    if not len(ends) or first > last:
        return []
    at = np.concatenate([ends, ends + size])
    step = np.concatenate([counts, -counts])
    order = np.argsort(at, kind="stable")
    at, total = at[order], np.cumsum(step[order])
    keep = np.append(at[1:] != at[:-1], True)  # the last of equal times has all their steps
    at, total = at[keep], total[keep]
    lo = np.maximum(at, first)
    hi = np.minimum(np.append(at[1:], at[-1]) - slide, last)
    live = (total > 0) & (lo <= hi)
    return list(zip(lo[live].tolist(), hi[live].tolist(), total[live].tolist()))


def _panes(keys: Sequence[str], size_ms: int, slide_ms: int, block_ms: int):
    """Events (keys, _t in ms) of each batch to counts per (keys, block, pane end) and the latest time among them."""
    def run(batches):
        for b in batches:
            t = b.column("_t").to_numpy()
            end = t - t % slide_ms + slide_ms
            table = pa.table([*(b.column(k) for k in keys), pa.array(end), b.column("_t")], names=[*keys, "_end", "_t"])
            got = table.group_by([*keys, "_end"], use_threads=False).aggregate([("_t", "count"), ("_t", "max")])
            end = got.column("_end").to_numpy()
            first, last = end // block_ms, (end + size_ms - slide_ms) // block_ms
            at = np.concatenate([np.arange(len(end)), np.flatnonzero(last > first)])
            block = np.concatenate([first, last[last > first]])
            got = got.take(pa.array(at)).append_column("_block", pa.array(block))
            latest = pc.multiply(got.column("_t_max"), 1000).cast(pa.timestamp("us", "UTC"))
            yield from pa.table([*(got.column(k) for k in keys), got.column("_block"), got.column("_end"), got.column("_t_count"), latest],
                                names=[*keys, "_block", "_end", "_count", "_at"]).combine_chunks().to_batches()
    return run


def sliding_count(df: DataFrame, keys: Sequence[str], ts: str, size, slide, delay="0 seconds", out: str = "count",
                  block_windows: int = 8) -> DataFrame:
    """keys..., window_start, window_end (epoch ms), ``out`` of each sliding window that is not empty."""
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    if size_ms % slide_ms:
        raise ValueError("pane aggregation needs size to be a multiple of slide")
    block_ms = size_ms * block_windows
    types = dict(df.dtypes)
    typed = [f"`{k}` {types[k]}" for k in keys]
    events = df.where(F.col(ts).isNotNull()).select(*keys, F.unix_millis(F.col(ts).cast("timestamp")).alias("_t"))
    panes = events.mapInArrow(_panes(list(keys), size_ms, slide_ms, block_ms), ", ".join([*typed, "_block long, _end long, _count long, _at timestamp"]))
    panes = panes.withWatermark("_at", f"{duration_ms(delay) + size_ms} milliseconds")

    def advance(key, batches, state):
        block = int(key[-1])
        lagging = state.getCurrentWatermarkMs()
        mark = lagging + size_ms if lagging > 0 else 0  # 0: nothing has come before
        # Without a state, what the watermark has passed may have been given before: those windows are closed.
        closed = max(block * block_ms, mark // slide_ms * slide_ms + slide_ms) - slide_ms
        ends, counts, done = state.get if state.exists else ([], [], closed)
        ends, counts = [np.array(ends, np.int64)], [np.array(counts, np.int64)]
        for b in batches:
            ends.append(b["_end"].to_numpy(np.int64))
            counts.append(b["_count"].to_numpy(np.int64))
        ends, back = np.unique(np.concatenate(ends), return_inverse=True)
        counts = np.bincount(back, np.concatenate(counts), len(ends)).astype(np.int64)
        last = min(mark // slide_ms * slide_ms, (block + 1) * block_ms - slide_ms)
        rows = stretches(ends, counts, done + slide_ms, last, size_ms, slide_ms)
        done = max(done, last)
        live = ends + (size_ms - slide_ms) > done
        ends, counts = ends[live], counts[live]
        if len(ends) and done < (block + 1) * block_ms - slide_ms:
            state.update((ends.tolist(), counts.tolist(), done))
            wanted = max(done + slide_ms, int(ends.min()))
            state.setTimeoutTimestamp(max(wanted - size_ms - 1, lagging + 1))
        elif state.exists:
            state.remove()
        lists = list(zip(*rows)) or [(), (), ()]
        yield pd.DataFrame({**{k: pd.Series([v] * len(rows), dtype=object) for k, v in zip(keys, key)},
                            **{n: pd.Series(v, dtype="int64") for n, v in zip(("_lo", "_hi", "_n"), lists)}})

    found = panes.groupBy(*keys, "_block").applyInPandasWithState(advance, ", ".join([*typed, "_lo long, _hi long, _n long"]), STATE, "append",
                                                                  GroupStateTimeout.EventTimeTimeout)
    rows = found.select(*keys, F.explode(F.sequence("_lo", "_hi", F.lit(slide_ms))).alias("window_end"), F.col("_n").alias(out))
    return rows.select(*keys, (F.col("window_end") - size_ms).alias("window_start"), "window_end", out)

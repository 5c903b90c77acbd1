"""Event-time windows: tumbling, sliding (pane aggregation) and the global variants.

Window bounds are epoch-aligned like Spark's ``window()``; bounds are emitted as
epoch-ms longs (``window_start``, ``window_end``).

Sliding windows with a large overlap (1 h / 5 s = 720 windows per event) are
computed by **pane aggregation** instead of ``window()``'s per-row Expand:

1. partial aggregate per (keys, pane) where a pane is one slide long
   (map-side combine, then one shuffle of pane partials);
2. counts and sums of exact types (``method='steps'``, the default for them): each pane is a +c / -c
   step at its end and one window later; a running sum per (keys, time block) gives
   every window's value and each constant stretch expands straight into its output
   rows - one more shuffle (of pane partials), no aggregation after the explode;
3. everything else (``method='pane'``): hash-partition the pane partials by (keys, time
   block) so the panes of one window mostly sit in one task, explode each pane into
   its window ends, merge map-side, then a final merge per (keys, window_end).

Hot keys do not land on one task: the time block splits a key's history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventflow.functions.time import duration_ms, epoch_ms

# (output column, kind, input column or None for rows)
AggSpec = tuple[str, str, str | None]

_PARTIAL = {"count": lambda c: F.count(F.lit(1)) if c is None else F.count(F.col(c)),
            "sum": lambda c: F.sum(F.col(c)), "min": lambda c: F.min(F.col(c)),
            "max": lambda c: F.max(F.col(c)), "avg": lambda c: F.avg(F.col(c)),
            "approx_distinct": lambda c: F.approx_count_distinct(F.col(c))}
# Aggregates as (parts of a pane, merge of each part, value from the merged parts).
_PANES = {
    "count": lambda c: ([_PARTIAL["count"](c)], [lambda p: F.sum(p).cast("long")], lambda m: m[0]),
    "sum": lambda c: ([F.sum(F.col(c))], [F.sum], lambda m: m[0]),
    "min": lambda c: ([F.min(F.col(c))], [F.min], lambda m: m[0]),
    "max": lambda c: ([F.max(F.col(c))], [F.max], lambda m: m[0]),
    "avg": lambda c: ([F.sum(F.col(c)), F.count(F.col(c))], [F.sum, F.sum], lambda m: F.when(m[1] > 0, m[0] / m[1])),
    "approx_distinct": lambda c: ([F.hll_sketch_agg(F.col(c))], [F.hll_union_agg], lambda m: F.coalesce(F.hll_sketch_estimate(m[0]), F.lit(0))),
}
# Sums that a +c / -c running sum gives exactly.
_EXACT = ("tinyint", "smallint", "int", "bigint")


def _exact_sum(df: DataFrame, c: str) -> bool:
    kind = dict(df.dtypes)[c]
    return kind in _EXACT or kind.startswith("decimal")


def _keys(keys: str | Sequence[str] | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ts_ms(df: DataFrame, ts_col: str) -> Column:
    dtype = dict(df.dtypes)[ts_col]
    if dtype in ("bigint", "int"):
        return F.col(ts_col)
    return epoch_ms(ts_col)


def tumbling_agg(df: DataFrame, keys, ts_col: str, size, aggs: Sequence[AggSpec] = (("count", "count", None),)) -> DataFrame:
    """Tumbling window aggregate: one partial+final hash aggregate, no Expand."""
    size_ms = duration_ms(size)
    ks = _keys(keys)
    t = _ts_ms(df, ts_col)
    start = (t - F.pmod(t, F.lit(size_ms))).alias("window_start")
    out = df.groupBy(*ks, start).agg(*[_PARTIAL[k](c).alias(n) for n, k, c in aggs])
    return out.withColumn("window_end", F.col("window_start") + F.lit(size_ms))


def sliding_agg(df: DataFrame, keys, ts_col: str, size, slide,
                aggs: Sequence[AggSpec] = (("count", "count", None),),
                method: str = "auto", block_windows: int = 8) -> DataFrame:
    """Sliding window aggregate -> keys..., window_start, window_end, aggs...

    Kinds: count, sum, min, max, avg and approx_distinct (a mergeable sketch). ``method='auto'``
    picks ``steps`` for counts and sums of exact types and ``pane`` otherwise (module docstring);
    ``method='direct'`` uses Spark's ``window(ts, size, slide)`` (one Expand row per
    window per event) and is kept for comparison and for tiny overlaps.
    """
    size_ms, slide_ms = duration_ms(size), duration_ms(slide)
    ks = _keys(keys)
    if size_ms % slide_ms != 0:
        raise ValueError("pane aggregation needs size to be a multiple of slide")
    if size_ms == slide_ms:
        return tumbling_agg(df, ks, ts_col, size_ms, aggs)
    if method == "auto":
        method = "steps" if all(k == "count" or k == "sum" and _exact_sum(df, c) for _, k, c in aggs) else "pane"
    if method == "steps":
        return _sliding_steps(df, ks, ts_col, size_ms, slide_ms, aggs, block_windows)
    if method == "direct":
        w = F.window(F.col(ts_col).cast("timestamp") if dict(df.dtypes)[ts_col] != "bigint"
                     else F.timestamp_millis(F.col(ts_col)), f"{size_ms} milliseconds", f"{slide_ms} milliseconds")
        out = df.groupBy(*ks, w.alias("w")).agg(*[_PARTIAL[k](c).alias(n) for n, k, c in aggs])
        return out.select(*ks, F.unix_millis(F.col("w.start")).alias("window_start"),
                          F.unix_millis(F.col("w.end")).alias("window_end"), *[n for n, _, _ in aggs])

    t = _ts_ms(df, ts_col)
    pane_end = (t - F.pmod(t, F.lit(slide_ms)) + F.lit(slide_ms)).alias("_pane_end")
    specs = [(n, *_PANES[k](c)) for n, k, c in aggs]
    parts = [(f"_p{i}_{j}", part, merge) for i, (_, ps, ms, _) in enumerate(specs) for j, (part, merge) in enumerate(zip(ps, ms))]
    panes = df.groupBy(*ks, pane_end).agg(*[part.alias(name) for name, part, _ in parts])
    block = F.floor(F.col("_pane_end") / F.lit(size_ms * block_windows))
    panes = panes.repartition(_shuffle_partitions(df), *[F.col(k) for k in ks], block)
    ends = F.sequence(F.col("_pane_end"), F.col("_pane_end") + F.lit(size_ms - slide_ms), F.lit(slide_ms))
    exploded = panes.select(*ks, F.explode(ends).alias("window_end"), *[name for name, _, _ in parts])
    merged = exploded.groupBy(*ks, "window_end").agg(*[merge(F.col(name)).alias(name) for name, _, merge in parts])
    values = [value([F.col(f"_p{i}_{j}") for j in range(len(ps))]).alias(n) for i, (n, ps, _, value) in enumerate(specs)]
    return merged.select(*ks, (F.col("window_end") - F.lit(size_ms)).alias("window_start"), "window_end", *values)


def _sliding_steps(df: DataFrame, ks: list[str], ts_col: str, size_ms: int, slide_ms: int,
                   aggs: Sequence[AggSpec], block_windows: int) -> DataFrame:
    """Sliding count/sum as a step function of the window end.

    A pane ending at p with partial c adds c to every window ending in [p, p + size):
    +c at p and -c at p + size. Within (keys, time block) a running sum over these
    change points gives the value of each window end, and each constant stretch is
    expanded directly into its window ends with ``sequence`` - the exploded rows are
    the output rows, with no aggregation or shuffle after the explode.

    Each pane is routed to the (at most two) blocks its window ends fall in, so the
    running sum of a block starts from zero and blocks of one key run in parallel.
    """
    t = _ts_ms(df, ts_col)
    pane_end = (t - F.pmod(t, F.lit(slide_ms)) + F.lit(slide_ms)).alias("_p")
    names = [n for n, _, _ in aggs]
    # A sum's count of values tells a window of nulls (null) from one whose values add up to 0.
    held = [f"_held{i}" for i, (_, k, _) in enumerate(aggs) if k == "sum"]
    partial = [F.count(F.lit(1)).alias("_rows")] + [
        (F.coalesce(_PARTIAL[k](c), F.lit(0)) if k == "sum" else _PARTIAL[k](c)).alias(n) for n, k, c in aggs]
    partial += [F.count(F.col(c)).alias(f"_held{i}") for i, (_, k, c) in enumerate(aggs) if k == "sum"]
    panes = df.groupBy(*ks, pane_end).agg(*partial)

    block_ms = size_ms * block_windows
    first_b = F.floor(F.col("_p") / F.lit(block_ms))
    last_b = F.floor((F.col("_p") + F.lit(size_ms - slide_ms)) / F.lit(block_ms))
    routed = panes.withColumn("_b", F.explode(F.array_distinct(F.array(first_b, last_b))))
    # The stage after this exchange emits size/slide rows per change point, far more
    # than it reads: pin the partition count so AQE does not coalesce it to one task.
    routed = routed.repartition(_shuffle_partitions(df), *[F.col(k) for k in ks], F.col("_b"))
    vals = ["_rows", *names, *held]
    # +c at the pane end, -c one window size later
    sign = F.explode(F.array(F.struct(F.col("_p").alias("x"), F.lit(1).alias("s")),
                             F.struct((F.col("_p") + F.lit(size_ms)).alias("x"), F.lit(-1).alias("s"))))
    deltas = routed.select(*ks, "_b", *vals, sign.alias("_d")).select(
        *ks, "_b", F.col("_d.x").alias("_x"), *[(F.col(v) * F.col("_d.s")).alias(v) for v in vals])
    # One exchange on (keys, block); change points that coincide are peers of a RANGE
    # frame, so the running value at a point already includes all of them, and only
    # the last peer (whose next point is larger) yields a non-empty stretch.
    w = Window.partitionBy(*ks, "_b").orderBy("_x")
    running = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    steps = deltas.select(*ks, "_b", "_x", F.lead("_x").over(w).alias("_nx"),
                          *[F.sum(v).over(running).alias(v) for v in vals])
    lo = F.greatest(F.col("_x"), F.col("_b") * F.lit(block_ms))
    hi = F.least(F.col("_nx"), (F.col("_b") + 1) * F.lit(block_ms)) - F.lit(slide_ms)
    live = steps.filter((F.col("_rows") > 0) & F.col("_nx").isNotNull() & (hi >= lo))
    out = live.select(*ks, F.explode(F.sequence(lo, hi, F.lit(slide_ms))).alias("window_end"),
                      *[(F.col(n).cast("long") if k == "count" else F.when(F.col(f"_held{i}") > 0, F.col(n))).alias(n)
                        for i, (n, k, _) in enumerate(aggs)])
    return out.select(*ks, (F.col("window_end") - F.lit(size_ms)).alias("window_start"), "window_end", *names)


def windowed_count(df: DataFrame, keys, ts_col: str, size, slide=None, count_col: str = "count",
                   method: str = "auto") -> DataFrame:
    """Count per key per window (AG1/AG2/AG4/AG10/AG11): tumbling when ``slide`` is None."""
    aggs = ((count_col, "count", None),)
    if slide is None:
        return tumbling_agg(df, keys, ts_col, size, aggs)
    return sliding_agg(df, keys, ts_col, size, slide, aggs, method=method)

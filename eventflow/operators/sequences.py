"""Per-key ordered scans that stay parallel when one key holds a large share of rows.

A keyed window ``partitionBy(key)`` puts every row of a key in one task. The
helpers here split a key's history by event time instead:

* ``previous_within`` / ``next_within``: the neighbour of a row in key order,
  when it lies within a bounded horizon ``H``. Rows are bucketed by ``ts // H`` and
  each row is also copied into the adjacent bucket, so the window
  ``partitionBy(key, bucket)`` sees every row of ``[ts - H, ts]`` (or ``[ts, ts + H]``).
  Cost: 2x rows, no collected groups, no per-key task.
* ``bucketed_row_number``: ``row_number`` over (key, order) computed as the local
  row number inside (key, time bucket) plus the running count of earlier buckets,
  taken from a small per-bucket count table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B, _OWN = "_bkt", "_own"


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _micros(ts_col: str) -> Column:
    return F.unix_micros(F.col(ts_col).cast("timestamp"))


def left_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Left equi-join in which null keys meet null keys; the right side's keys are dropped."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(other, cond, "left").drop(*[f"_r_{c}" for c in cols])


def previous_within(df: DataFrame, keys: Sequence[str], ts_col: str, order: Sequence, horizon_ms: int,
                    cols: Sequence[str], prefix: str = "prev_", inclusive: bool = False) -> DataFrame:
    """Add ``prefix + c`` for each ``c`` in ``cols`` (and ``ts_col``) from the row just before
    in (keys, order), or nulls when that row is ``horizon_ms`` or more older (or absent);
    with ``inclusive`` a row exactly ``horizon_ms`` older still counts. A row without a time has
    no neighbour and stays; null keys form one key."""
    h_us = horizon_ms * 1000
    t = _micros(ts_col)
    b = F.floor(t / F.lit(h_us))
    d = df.select("*", b.alias("_home"), F.explode(F.when(b.isNull(), F.array(b)).otherwise(F.array(b, b + 1))).alias(_B))
    w = Window.partitionBy(*keys, _B).orderBy(*_cols(order))
    wanted = list(dict.fromkeys([*cols, ts_col]))
    d = d.withColumns({prefix + c: F.lag(c).over(w) for c in wanted})
    d = d.filter(F.col(_B).eqNullSafe(F.col("_home")))
    gap = t - _micros(prefix + ts_col)
    near = (gap <= F.lit(h_us)) if inclusive else (gap < F.lit(h_us))
    d = d.withColumns({prefix + c: F.when(near, F.col(prefix + c)) for c in wanted})
    return d.drop(_B, "_home")


def next_within(df: DataFrame, keys: Sequence[str], ts_col: str, order: Sequence, horizon_ms: int,
                is_target: Column, cols: Sequence[str], prefix: str = "next_") -> DataFrame:
    """Add ``prefix + c`` from the first later row (in key order) with ``is_target`` true, when
    it lies less than ``horizon_ms`` after the row; nulls otherwise.

    Targets are copied into the previous bucket, so the window over (key, bucket)
    holds every target in ``[ts, ts + H)``; scanning it in descending order, the
    nearest later target is a running ``last(.., ignorenulls)`` (linear, no quadratic frame).
    """
    h_us = horizon_ms * 1000
    t = _micros(ts_col)
    b = F.floor(t / F.lit(h_us))
    wanted = list(dict.fromkeys([*cols, ts_col]))
    tgt = F.when(is_target, F.struct(*[F.col(c).alias(c) for c in wanted]))
    d = df.select("*", b.alias("_home"), tgt.alias("_tgt"),
                  F.explode(F.when(is_target & b.isNotNull(), F.array(b, b - 1)).otherwise(F.array(b))).alias(_B))
    desc_order = [c.desc() for c in _cols(order)]
    w = (Window.partitionBy(*keys, _B).orderBy(*desc_order)
               .rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("_nx", F.last("_tgt", ignorenulls=True).over(w))
    d = d.filter(F.col(_B).eqNullSafe(F.col("_home")))
    near = _micros("_nx." + ts_col) < t + F.lit(h_us)
    d = d.withColumns({prefix + c: F.when(near, F.col("_nx." + c)) for c in wanted})
    return d.drop(_B, "_home", "_tgt", "_nx")


def bucketed_row_number(df: DataFrame, keys: Sequence, order: Sequence, bucket: Column,
                        out: str = "rn") -> DataFrame:
    """``row_number() over (partition by keys order by order)`` without a per-key task.

    ``bucket`` must be non-decreasing along ``order`` within a key (a time bucket of the
    first order column). One shuffle of the rows by (keys, bucket); the per-bucket
    counts are partial-aggregated before their (small) shuffle and turned into offsets.
    Null keys are numbered like any other key, rows with a null bucket come first.
    """
    ks = _cols(keys)
    src = df.withColumn(_B, bucket)
    d = src.repartition(*ks, F.col(_B))
    key_names = [f"_k{i}" for i in range(len(ks))]
    local = (d.withColumn("_lrn", F.row_number().over(Window.partitionBy(*ks, _B).orderBy(*_cols(order))))
              .select("*", *[k.alias(n) for k, n in zip(ks, key_names)]))
    # counted from the source side: a map-side partial count, so only one small row per
    # (key, bucket, map task) is shuffled for the offsets
    counts = src.groupBy(*[k.alias(n) for k, n in zip(ks, key_names)], F.col(_B)).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key_names).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*key_names, _B, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    j = left_null_safe(local, offsets, [*key_names, _B])
    return j.withColumn(out, (F.col("_lrn") + F.col("_off")).cast("long")).drop("_lrn", "_off", _B, *key_names)

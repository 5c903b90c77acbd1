"""Distinct users per window (AG7 exact, AG8 bitmap offsets, HLL variants)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.functions.hashing import DEFAULT_BITS, DEFAULT_SEED, poly_hash
from eventflow.functions.time import duration_ms, epoch_ms


def _window_start(df: DataFrame, ts: str, size_ms: int):
    t = epoch_ms(ts)
    return (t - F.pmod(t, F.lit(size_ms))).alias("window_start")


def unique_visitors(df: DataFrame, ts: str = "ts", size="1 hour", user: str = "user_id") -> DataFrame:
    """Exact distinct users per tumbling window -> window_end, uv_count.

    ``countDistinct`` plans a two-phase aggregate: (window, user) dedup shuffled on both
    columns, then a partial/final count per window, so a busy window is not one task.
    """
    size_ms = duration_ms(size)
    g = df.groupBy(_window_start(df, ts, size_ms)).agg(F.countDistinct(user).alias("uv_count"))
    return g.select((F.col("window_start") + F.lit(size_ms)).alias("window_end"), "uv_count")


def unique_visitors_bitmap(df: DataFrame, ts: str = "ts", size="1 hour", user: str = "user_id",
                           bits: int = DEFAULT_BITS, seed: int = DEFAULT_SEED) -> DataFrame:
    """Bitmap count: distinct hash offsets of the user id text per window (collisions merge users)."""
    size_ms = duration_ms(size)
    off = poly_hash(F.col(user).cast("string"), seed, bits)
    g = df.groupBy(_window_start(df, ts, size_ms)).agg(F.countDistinct(off).alias("uv_count"))
    return g.select((F.col("window_start") + F.lit(size_ms)).alias("window_end"), "uv_count")


def unique_visitors_approx(df: DataFrame, ts: str = "ts", size="1 hour", user: str = "user_id",
                           rsd: float = 0.02) -> DataFrame:
    """HyperLogLog estimate per window; mergeable, allowed in streaming aggregations."""
    size_ms = duration_ms(size)
    g = df.groupBy(_window_start(df, ts, size_ms)).agg(F.approx_count_distinct(user, rsd).alias("uv_count"))
    return g.select((F.col("window_start") + F.lit(size_ms)).alias("window_end"), "uv_count")

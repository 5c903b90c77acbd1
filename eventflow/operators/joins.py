"""Joins: lookup, interval join (JN1) and two-stream reconciliation (JN2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventflow.functions.time import duration_ms, interval_lit


def lookup_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join a fact stream to a dimension. No hint: Spark broadcasts the dimension by its size in
    bytes (``spark.sql.autoBroadcastJoinThreshold``, and AQE from what a stage really wrote)."""
    return fact.join(dim, on, how)


def _range_cond(left_ts, right_ts, lower_ms: int, upper_ms: int):
    lo = left_ts + interval_lit(lower_ms) if lower_ms else left_ts
    hi = left_ts + interval_lit(upper_ms) if upper_ms else left_ts
    return (right_ts >= lo) & (right_ts <= hi)


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
                  lower, upper, how: str = "inner", left_prefix: str = "l_", right_prefix: str = "r_") -> DataFrame:
    """Rows pairs with equal ``key`` and ``right.ts`` in ``[left.ts + lower, left.ts + upper]`` (both ends inclusive).

    Batch: an equi-join on (key, time bucket). A bucket is as wide as the interval; a right row is
    in its own bucket and a left row in the one or two that its interval touches, so each pair
    meets once and a hot key's rows meet only those near them in time. The rows of an outer or anti
    join that have no partner come from a scan over (key, bucket) for the nearest partner, so they
    are decided after all buckets. Streams (inner and outer): an equi-join on (key, time bucket) too,
    see ``_interval_outer``; give both sides a watermark and Spark evicts state by the range.
    Columns are prefixed per side; rows with a null key or time have no partner.
    """
    lo, hi = _signed_ms(lower), _signed_ms(upper)
    l = left.select([F.col(c).alias(left_prefix + c) for c in left.columns])
    r = right.select([F.col(c).alias(right_prefix + c) for c in right.columns])
    lk, rk, lt, rt = left_prefix + key, right_prefix + key, left_prefix + left_ts, right_prefix + right_ts
    if hi < lo:
        raise ValueError("upper is below lower")
    if left.isStreaming or right.isStreaming:
        return _interval_outer(l, r, lk, lt, rk, rt, lo, hi, how).select("_l.*", "_r.*")
    if how not in ("inner", "left_outer", "right_outer", "full_outer", "left_anti"):
        raise ValueError(f"how must be inner, left_outer, right_outer, full_outer or left_anti, not {how}")
    if how == "left_anti":
        return _without_partner(l, lk, lt, r, rk, rt, lo, hi)
    width = (hi - lo) * 1000 + 1
    near = l.select("*", F.explode(F.array_distinct(F.array(_bucket(lt, lo, width), _bucket(lt, hi, width)))).alias("_lb"))
    far = r.select("*", _bucket(rt, 0, width).alias("_rb"))
    cond = (F.col(lk) == F.col(rk)) & (F.col("_lb") == F.col("_rb")) & _range_cond(F.col(lt), F.col(rt), lo, hi)
    out = near.join(far, cond, "inner").drop("_lb", "_rb")
    if how in ("left_outer", "full_outer"):
        out = out.unionByName(_without_partner(l, lk, lt, r, rk, rt, lo, hi), allowMissingColumns=True)
    if how in ("right_outer", "full_outer"):
        out = out.unionByName(_without_partner(r, rk, rt, l, lk, lt, -hi, -lo), allowMissingColumns=True)
    return out


def _bucket(ts: str, shift_ms: int, width_us: int):
    at = F.unix_micros(F.col(ts).cast("timestamp")) + F.lit(shift_ms * 1000)
    return ((at - F.pmod(at, F.lit(width_us))) / F.lit(width_us)).cast("long")


def _without_partner(l: DataFrame, lk: str, lt: str, r: DataFrame, rk: str, rt: str, lo: int, hi: int) -> DataFrame:
    """Rows of ``l`` with no row of ``r`` of the same key at ``lt + lo`` to ``lt + hi``.

    Both sides go to (key, bucket) with buckets as wide as the interval: a left row to the bucket of
    its interval's start, a right row to its own and the one before; there the first right time at
    or after the start is a running value of a descending scan."""
    width = (hi - lo) * 1000 + 1
    start = F.unix_micros(F.col(lt).cast("timestamp")) + F.lit(lo * 1000)
    mine = l.select(F.col(lk).alias("_k"), start.alias("_t"), _bucket(lt, lo, width).alias("_b"), F.lit(1).alias("_side"), F.struct(*l.columns).alias("_row"))
    b = _bucket(rt, 0, width)
    theirs = (r.where(F.col(rk).isNotNull() & F.col(rt).isNotNull())
              .select(F.col(rk).alias("_k"), F.unix_micros(F.col(rt).cast("timestamp")).alias("_t"), F.explode(F.array(b, b - 1)).alias("_b"),
                      F.lit(0).alias("_side"), F.lit(None).cast(mine.schema["_row"].dataType).alias("_row")).distinct())
    w = Window.partitionBy("_k", "_b").orderBy(F.desc("_t"), "_side").rowsBetween(Window.unboundedPreceding, -1)
    found = F.last(F.when(F.col("_side") == 0, F.col("_t")), ignorenulls=True).over(w)
    seen = mine.unionByName(theirs).withColumn("_next", found).where(F.col("_side") == 1)
    has = F.col("_k").isNotNull() & (F.col("_next") <= F.col("_t") + F.lit((hi - lo) * 1000))
    return seen.where(~F.coalesce(has, F.lit(False))).select("_row.*")


def _signed_ms(spec) -> int:
    if isinstance(spec, str) and spec.strip().startswith("-"):
        return -duration_ms(spec.strip()[1:])
    return duration_ms(spec)


def reconcile(pays: DataFrame, receipts: DataFrame, key: str = "tx_id", ts: str = "ts",
              pay_wait="51 seconds", receipt_wait="5 seconds") -> DataFrame:
    """Two-stream reconciliation (JN2).

    A pay waits ``pay_wait`` for its receipt and a receipt waits ``receipt_wait`` for its
    pay, so a pair matches when ``receipt.ts`` is in ``[pay.ts - receipt_wait, pay.ts + pay_wait]``.
    Output: ``tx_id``, ``verdict`` (matched / unmatched_pay / unmatched_receipt) and the
    prefixed columns of both sides (``pay_*``, ``receipt_*``), null on the missing side.
    Pays and receipts with an empty key never match (FLT3).

    One full outer join by (key, time bucket), see ``_interval_outer``; a row without a time has no
    partner. On streams Spark evicts state by watermark and emits the unmatched rows after their wait.
    """
    p, r = (d.filter(F.col(key) != "").select([F.col(c).alias(f"{side}_{c}") for c in d.columns]) for d, side in ((pays, "pay"), (receipts, "receipt")))
    j = _interval_outer(p, r, f"pay_{key}", f"pay_{ts}", f"receipt_{key}", f"receipt_{ts}", -_signed_ms(receipt_wait), _signed_ms(pay_wait), "full_outer")
    verdict = (F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), F.lit("matched"))
                .when(F.col("_l").isNotNull(), F.lit("unmatched_pay")).otherwise(F.lit("unmatched_receipt")))
    return j.select(F.coalesce(f"_l.pay_{key}", f"_r.receipt_{key}").alias(key), verdict.alias("verdict"), "_l.*", "_r.*")


def _interval_outer(l: DataFrame, r: DataFrame, lk: str, lt: str, rk: str, rt: str, lo: int, hi: int, how: str) -> DataFrame:
    """Pairs with ``rt`` in ``[lt + lo, lt + hi]`` (ms) and, as ``how`` says, rows without a partner: ``_l``, ``_r``
    (structs of the sides' rows, null where there is no partner). Tables or streams.

    One join on (key, bucket), buckets as wide as the interval; each side is read and exchanged once. On one
    time line (a left row stands where its interval starts) a left row is at home in its bucket and leaves its
    place, without its columns, in the next; a right row is at home in its bucket and once more in the one
    before. All partners of a left row are in its home, and so are the places of all partners of a right row:
    a home row that the join leaves alone has no partner anywhere, and a pair is taken where its left row is at
    home. Other rows of the join (places that met or missed) are dropped."""
    width = (hi - lo) * 1000 + 1

    def placed(d, side, key, ts, shift_ms, other, everywhere):
        b = _bucket(ts, shift_ms, width)
        places = F.explode(F.array(F.struct(b.alias("b"), F.lit(True).alias("home")), F.struct((b + other).alias("b"), F.lit(False).alias("home"))))
        d = d.select(F.col(key).alias(f"_k{side}"), F.col(ts).alias(f"_t{side}"), F.struct(*d.columns).alias("row"), places.alias("at"))
        row = F.col("row") if everywhere else F.when(F.col("at.home"), F.col("row"))
        return d.select(f"_k{side}", f"_t{side}", F.col("at.b").alias(f"_b{side}"), F.col("at.home").alias(f"_h{side}"), row.alias(f"_{side}"))

    if how not in ("inner", "left_outer", "right_outer", "full_outer"):
        raise ValueError(f"how must be inner, left_outer, right_outer or full_outer, not {how}")
    a, b = placed(l, "l", lk, lt, lo, 1, False), placed(r, "r", rk, rt, 0, -1, True)
    gap = F.unix_micros(F.col("_tr").cast("timestamp")) - F.unix_micros(F.col("_tl").cast("timestamp"))
    # Streams evict by a condition on the event times themselves; on tables plain integers are cheaper.
    near = _range_cond(F.col("_tl"), F.col("_tr"), lo, hi) if l.isStreaming or r.isStreaming else gap.between(lo * 1000, hi * 1000)
    j = a.join(b, (F.col("_kl") == F.col("_kr")) & (F.col("_bl") == F.col("_br")) & near, how)
    return j.where(F.coalesce("_hl", "_hr")).select("_l", "_r")

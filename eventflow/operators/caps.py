"""Daily click cap with a warning side stream (Q12a)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.functions.text import MSG_CLICK_CAP
from eventflow.functions.time import duration_ms
from eventflow.operators.sequences import bucketed_row_number


def click_cap(df: DataFrame, keys: Sequence[str] = ("user_id", "ad_id"), ts: str = "ts",
              tiebreak: str = "event_id", max_count: int = 100, policy: str = "as_written",
              bucket="10 minutes") -> DataFrame:
    """Number each key's clicks per UTC day and add ``verdict`` and ``msg``.

    ``as_written``: the click numbered ``max_count + 2`` raises the warning and is held
    back; every other click passes (the reference compares the previous count and warns
    once). ``drop_all``: clicks from ``max_count + 2`` on are held back, one warning.
    verdict: 'pass' | 'blacklist' (the warning row) | 'dropped'.
    The per-(key, day) numbering is split by ``bucket`` so one hot key-day is not one task.
    """
    if policy not in ("as_written", "drop_all"):
        raise ValueError("policy must be 'as_written' or 'drop_all'")
    b_us = duration_ms(bucket) * 1000
    t = F.col(ts).cast("timestamp")
    d = df.withColumn("day", F.to_date(t))
    d = bucketed_row_number(d, [*keys, "day"], [t, F.col(tiebreak)],
                            F.floor(F.unix_micros(t) / F.lit(b_us)), out="click_no")
    warn_at = max_count + 2
    verdict = F.when(F.col("click_no") == warn_at, F.lit("blacklist"))
    if policy == "drop_all":
        verdict = verdict.when(F.col("click_no") > warn_at, F.lit("dropped"))
    verdict = verdict.otherwise(F.lit("pass"))
    msg = F.when(F.col("click_no") == warn_at, F.lit(MSG_CLICK_CAP.format(max_count=max_count)))
    return d.withColumn("verdict", verdict).withColumn("msg", msg)


def split_outputs(df: DataFrame, tags: Sequence[str], col: str = "verdict", rest: str | None = None) -> dict[str, DataFrame]:
    """Side outputs (SNK4): one lazily filtered DataFrame per tag of ``tags``; with ``rest`` also one
    under that name for the rows of any other tag, null included. No data is collected."""
    out = {t: df.filter(F.col(col) == t) for t in tags}
    if rest is not None:
        out[rest] = df.filter(~F.coalesce(F.col(col).isin(*tags), F.lit(False)))
    return out

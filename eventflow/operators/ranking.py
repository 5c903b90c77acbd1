"""Top-N per window (WF1, TK1, TK2) and the ranking report text (TK3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventflow.functions.text import REPORT_COUNT_LABEL, REPORT_FOOTER, REPORT_TIME_PREFIX
from eventflow.functions.time import java_timestamp_text


def top_n(df: DataFrame, group_col: str, order_col: str, n: int,
          tiebreak: Sequence[str] = (), rank_col: str = "rank") -> DataFrame:
    """Keep the ``n`` largest ``order_col`` rows per ``group_col``; ties by ``tiebreak`` ascending.

    ``row_number() <= n`` lets Spark plan a WindowGroupLimit: each map task keeps
    only its local top n per group before the shuffle, so a window with many keys
    never ships all of them to one task.
    """
    w = Window.partitionBy(group_col).orderBy(F.col(order_col).desc(), *[F.col(c).asc() for c in tiebreak])
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) <= n)
              .withColumn(rank_col, F.col(rank_col).cast("long")))


def top_n_report(ranked: DataFrame, window_end_col: str, rank_col: str, key_col: str,
                 count_col: str, key_label: str, whole_seconds: bool = False) -> DataFrame:
    """One text block per window end, built from rows already limited to the top n.

    ``时间：<end>\\nNo1: <label>=<key> 浏览量=<count>\\n...======================``
    """
    line = F.concat(F.lit("No"), F.col(rank_col).cast("string"), F.lit(":"), F.lit(key_label),
                    F.col(key_col).cast("string"), F.lit(REPORT_COUNT_LABEL),
                    F.col(count_col).cast("string"), F.lit("\n"))
    g = ranked.groupBy(window_end_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), line.alias("l")))).alias("_lines"))
    body = F.array_join(F.transform("_lines", lambda x: x["l"]), "")
    text = F.concat(F.lit(REPORT_TIME_PREFIX), java_timestamp_text(F.col(window_end_col), whole_seconds), F.lit("\n"),
                    body, F.lit(REPORT_FOOTER))
    return g.select(window_end_col, text.alias("report"))

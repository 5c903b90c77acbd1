"""Windowed aggregates on streaming DataFrames (ST1-ST6, AG7 on streams, WF1 on streams).

* ``stream_windowed_count``: ``window()`` + watermark. Watermark = out-of-orderness
  delay + allowed lateness (ST2, ST3). ``append`` emits each window once, when the
  watermark passes its end; ``update`` emits running counts and late corrections.
* ``stream_sliding_count``: panes of one slide, then keyed state that turns panes
  into stretches of equal window values (``streaming.panes``); nothing is expanded before
  the output rows.
* ``stream_unique_visitors``: exact distinct per window as two chained aggregations
  (``countDistinct`` is not supported on streams).
* ``top_n_writer``: ranks each micro-batch of an append-mode count stream; all keys of
  a window close under the same watermark, so each window arrives whole in one batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.functions.time import duration_ms
from eventflow.operators.ranking import top_n
from eventflow.streaming.panes import sliding_count


def _ms_interval(ms: int) -> str:
    return f"{ms} milliseconds"


def with_event_time(df: DataFrame, ts: str = "ts", delay="0 seconds", lateness="0 seconds") -> DataFrame:
    """Bounded out-of-orderness watermark; ``0 seconds`` is the ascending-timestamps case (ST1)."""
    return df.withWatermark(ts, _ms_interval(duration_ms(delay) + duration_ms(lateness)))


def _bounds(cols: Sequence[str], count_col: str, win: str = "window") -> list:
    return [*cols, F.unix_millis(F.col(f"{win}.start")).alias("window_start"),
            F.unix_millis(F.col(f"{win}.end")).alias("window_end"), count_col]


def stream_windowed_count(df: DataFrame, keys: Sequence[str], ts: str, size, slide=None,
                          delay="0 seconds", lateness="0 seconds", count_col: str = "count") -> DataFrame:
    d = with_event_time(df, ts, delay, lateness)
    w = (F.window(ts, _ms_interval(duration_ms(size)), _ms_interval(duration_ms(slide))) if slide
         else F.window(ts, _ms_interval(duration_ms(size))))
    g = d.groupBy(*keys, w.alias("window")).agg(F.count(F.lit(1)).alias(count_col))
    return g.select(*_bounds(keys, count_col))


def stream_sliding_count(df: DataFrame, keys: Sequence[str], ts: str, size, slide,
                         delay="0 seconds", count_col: str = "count") -> DataFrame:
    return sliding_count(df, keys, ts, size, slide, delay, count_col)


def stream_unique_visitors(df: DataFrame, ts: str = "ts", size="1 hour", user: str = "user_id",
                           delay="0 seconds") -> DataFrame:
    d = with_event_time(df, ts, delay)
    per_user = d.groupBy(F.window(ts, _ms_interval(duration_ms(size))).alias("window"), user).count()
    g = per_user.groupBy("window").agg(F.count(F.lit(1)).alias("uv_count"))
    return g.select(F.unix_millis(F.col("window.end")).alias("window_end"), "uv_count")


def stream_running_visitors(df: DataFrame, ts: str = "ts", size="1 hour", user: str = "user_id", bits: int = 29,
                            delay="0 seconds") -> DataFrame:
    """Unique visitors of open windows as they arrive (ST6 with AG8), for update mode: window_end, piece, bits, n.

    The bitmap of a window is kept in pieces of 2**15 offsets, each a state row that Spark's bitmap aggregate
    sets bits in (map-side partials merge), so no window is one task, and a micro-batch touches the pieces that
    its users fall in. ``n`` only rises; ``running_visitors_writer`` adds the pieces of a window up. Pieces of
    several windows merge with ``merge_visitors``."""
    from eventflow.functions.hashing import poly_hash

    off = df.withColumn("_offset", poly_hash(F.col(user).cast("string"), bits=bits))
    d = with_event_time(off, ts, delay)
    g = d.groupBy(F.window(ts, _ms_interval(duration_ms(size))).alias("window"), F.bitmap_bucket_number("_offset").alias("piece"))
    g = g.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_offset")).alias("bits"))
    return g.select(F.unix_millis(F.col("window.end")).alias("window_end"), "piece", "bits", F.bitmap_count("bits").alias("n"))


def merge_visitors(pieces: DataFrame, size) -> DataFrame:
    """Unique visitors of longer windows (a whole number of the pieces' windows) from pieces with bits."""
    size_ms = duration_ms(size)
    end = F.floor((F.col("window_end") + (size_ms - 1)) / size_ms) * size_ms
    whole = pieces.groupBy(end.alias("window_end"), "piece").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return whole.groupBy("window_end").agg(F.sum("n").alias("uv_count"))


def running_visitors_writer(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` for ``stream_running_visitors``: writes each touched window's count so far to
    ``path/updates`` (window_end, uv_count, _batch).

    The counts of pieces are kept in ``path/pieces``, a folder per day of windows, of which a batch reads the
    days it touches; older days are not read again. A batch that is run again overwrites what it wrote."""
    day = F.floor(F.col("window_end") / 86_400_000).alias("_day")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pieces, updates = f"{path}/pieces", f"{path}/updates"
        (batch.select("window_end", "piece", "n", day, F.lit(batch_id).cast("long").alias("_batch")).repartition("_day").write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy("_day", "_batch").parquet(pieces))
        known = spark.read.schema("window_end long, piece long, n long, _day long, _batch long").parquet(pieces).where(F.col("_batch") <= batch_id)
        now = known.groupBy("_day", "window_end", "piece").agg(F.max("n").alias("n"), F.max("_batch").alias("_last"))
        now = now.groupBy("_day", "window_end").agg(F.sum("n").alias("uv_count"), F.max("_last").alias("_batch")).where(F.col("_batch") == batch_id)
        days = [r["_day"] for r in known.where(F.col("_batch") == batch_id).select("_day").distinct().collect()]
        (now.where(F.col("_day").isin(days)).drop("_day").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(updates))
    return run


def last_updates(spark, path: str, key: str = "window_end") -> DataFrame:
    """The last row that ``path/updates`` has for each ``key``."""
    d = spark.read.parquet(f"{path}/updates")
    rest = [c for c in d.columns if c not in (key, "_batch")]
    return d.groupBy(key).agg(F.max_by(F.struct(*rest), "_batch").alias("r")).select(key, "r.*")


def top_n_writer(n: int, order_col: str, tiebreak: Sequence[str], sink: Callable[[DataFrame, int], None],
                 group_col: str = "window_end", rank_col: str = "rank") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: rank the batch's (closed) windows and hand the top rows to ``sink``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        sink(top_n(batch, group_col, order_col, n, tiebreak, rank_col), batch_id)
    return run


def corrected_top_n_writer(n: int, key: str, counts_path: str, out_path: str,
                           count_col: str = "count") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` for update-mode window counts with allowed lateness (ST3, TK2).

    Each micro-batch holds only the windows whose counts changed. They are appended to a
    counts log (partitioned by day of ``window_end``); the whole current count table of
    just those windows is then read back (latest batch per key and window, partitions
    limited to the batch's window range) and ranked again, so a late correction re-ranks
    the full window. Each batch's rankings go to their own partition (overwritten if the
    batch is replayed); the latest batch per window end is the current ranking
    (``read_latest_rankings``).
    """
    from pyspark.sql import Window

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changed = batch.select(key, "window_end", count_col).withColumn("_batch", F.lit(batch_id))
        changed = changed.withColumn("_day", F.floor(F.col("window_end") / F.lit(86_400_000)))
        changed.persist()
        try:
            bounds = changed.agg(F.min("_day"), F.max("_day")).first()
            if bounds[0] is None:
                return
            (changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                    .partitionBy("_day", "_batch").parquet(counts_path))
            log = spark.read.parquet(counts_path).where(F.col("_day").between(bounds[0], bounds[1]))
            ends = changed.select("window_end").distinct()
            cur = log.join(ends, "window_end", "left_semi")
            latest = Window.partitionBy(key, "window_end").orderBy(F.col("_batch").desc())
            cur = cur.withColumn("_v", F.row_number().over(latest)).filter("_v = 1").drop("_v", "_day")
            ranked = top_n(cur.drop("_batch"), "window_end", count_col, n, [key])
            (ranked.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite")
                   .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(out_path))
        finally:
            changed.unpersist()

    return run


def read_latest_rankings(spark, out_path: str) -> DataFrame:
    """Current top-N per window end: the rows of the latest batch that ranked that window."""
    d = spark.read.parquet(out_path)
    last = d.groupBy("window_end").agg(F.max("_batch").alias("_last"))
    return d.join(last, "window_end").filter(F.col("_batch") == F.col("_last")).drop("_batch", "_last")


def stream_unique_visitors_bitmap(df: DataFrame, ts: str = "ts", size="1 hour", user: str = "user_id",
                                  bits: int = 29, delay="0 seconds") -> DataFrame:
    """AG8 on streams: distinct bitmap offsets per window (chained aggregation, as AG7)."""
    from eventflow.functions.hashing import poly_hash

    off = df.withColumn("_offset", poly_hash(F.col(user).cast("string"), bits=bits))
    return stream_unique_visitors(off, ts, size, "_offset", delay)

"""Drive a streaming query to completion over the files available now (tests, backfills)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventflow.session import shared_dir


def checkpoint_for(spark: SparkSession, name: str) -> str:
    """The checkpoint folder of the query ``name`` under the cluster's shared ``spark.checkpoint.dir``:
    the same for every start, so a restarted query goes on with its state and offsets."""
    return f"{shared_dir(spark)}/streams/{name}"


def run_available(df: DataFrame, name: str, output_mode: str = "append",
                  foreach_batch: Callable[[DataFrame, int], None] | None = None, path: str | None = None) -> DataFrame | None:
    """Process every file present now, then stop. The result goes to ``foreach_batch``, or to
    Parquet files under ``path``, or (small results, tests) to a memory table, which is returned."""
    spark = df.sparkSession
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint_for(spark, name))
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).trigger(availableNow=True).start()
    elif path is not None:
        q = w.format("parquet").option("path", path).trigger(availableNow=True).start()
    else:
        q = w.format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    if foreach_batch is not None:
        return None
    return spark.read.parquet(path) if path is not None else spark.table(name)

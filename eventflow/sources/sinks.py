"""Sinks (SNK1, SNK2, SNK4).

* labelled print sink: console (or memory) stream named after the label;
* append and retract table sinks: append mode, and an upsert log written per micro-batch
  whose latest version per key is the current result (``read_upserts``);
* side outputs: one streaming query writes every verdict tag of a micro-batch to its own
  folder, persisting the batch once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def print_sink(df: DataFrame, label: str, checkpoint: str, output_mode: str = "append",
               fmt: str = "console") -> StreamingQuery:
    """SNK1: ``print(label)`` as a console (or ``memory``) stream whose query name is the label."""
    return (df.writeStream.format(fmt).queryName(label).outputMode(output_mode)
              .option("checkpointLocation", checkpoint).option("truncate", "false").start())


def append_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """SNK2 append: finalized rows only (windows closed by the watermark)."""
    return (df.writeStream.format(fmt).outputMode("append").option("path", path)
              .option("checkpointLocation", checkpoint).start())


def upsert_sink(df: DataFrame, path: str, checkpoint: str, output_mode: str = "update") -> StreamingQuery:
    """SNK2 retract: each micro-batch's changed rows are appended with their batch id;
    the newest row per key is the current one (``read_upserts``). Idempotent on replay:
    a batch id is written to its own folder with overwrite."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")

    return (df.writeStream.outputMode(output_mode).foreachBatch(write)
              .option("checkpointLocation", checkpoint).start())


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Current state of an upsert log: the row of the highest batch per key."""
    d = spark.read.parquet(path)
    w = Window.partitionBy(*keys).orderBy(F.col("_batch").desc())
    return d.withColumn("_v", F.row_number().over(w)).filter("_v = 1").drop("_v", "_batch")


def side_output_sink(df: DataFrame, tag_col: str, tags: Sequence[str], path: str, checkpoint: str,
                     output_mode: str = "append") -> StreamingQuery:
    """SNK4: route every tag of ``tag_col`` to ``path/<tag>`` from one streaming query."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for t in tags:
                (batch.filter(F.col(tag_col) == t).withColumn("_batch", F.lit(batch_id))
                      .write.mode("overwrite").parquet(f"{path}/{t}/_batch={batch_id}"))
        finally:
            batch.unpersist()

    return (df.writeStream.outputMode(output_mode).foreachBatch(write)
              .option("checkpointLocation", checkpoint).start())

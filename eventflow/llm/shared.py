"""Tables that operators write between jobs: in the folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session. Only in local mode, where every task runs on this machine
    and the setting is absent, a fresh folder of this machine is set."""
    have = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if have:
        return have.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventflow-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Tables:
    """Intermediate tables of one operator run, written once and read back (lineage ends there)."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def put(self, df: DataFrame, name: str = "t", *, partition: list[str] | None = None) -> DataFrame:
        path = f"{self.root}/{self.count}-{name}"
        self.count += 1
        writer = df.write
        if partition:
            writer = writer.partitionBy(*partition)
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *error) -> None:
        self.drop()

    def drop(self) -> None:
        """Delete all tables of the run; what reads them afterwards fails."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        root.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(root, True)

    def finish(self, df: DataFrame, name: str = "result") -> DataFrame:
        """``put`` the last table of a run and delete all that it was made from (under the same folder,
        also what others wrote there)."""
        done = self.put(df, name)
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = root.getFileSystem(conf)
        for status in fs.listStatus(root):
            if status.getPath().getName() != f"{self.count - 1}-{name}":
                fs.delete(status.getPath(), True)
        return done

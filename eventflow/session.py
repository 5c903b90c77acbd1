"""Session helpers.

The library never creates a global session: every operator takes DataFrames.
These helpers exist for tests, the bench and the entry points. On a cluster the
session comes from the launcher; only ``shared_dir`` is consulted there.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours needs for deterministic event-time results.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "eventflow", driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and the bench (one JVM, ``cores`` threads)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    conf["spark.sql.shuffle.partitions"] = str(parts)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, allow_local: bool = False) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Used for ``DataFrame.checkpoint()`` and streaming checkpoint locations. When the
    setting is missing we refuse on a cluster; in local mode, where all tasks run on this
    machine, a fresh scratch folder is set once per session.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if not allow_local and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a folder every executor can reach")
    d = tempfile.mkdtemp(prefix="eventflow-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir().rstrip("/")

"""Parquet tables and the event streams derived from them.

The driver's tables stand in for the reference's inputs (see README, "Data
mapping"). Every derived stream is a lazy projection of a table, so filters and
column pruning reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.functions.text import CHANNELS
from eventflow.functions.time import as_instant

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# URL suffixes of the derived access log, chosen by props.k % 5.
URL_SUFFIXES = ("", ".html", ".css", ".js", ".css?v=1")


# When set (see ``streaming_tables``), table reads become file streams with these options.
_STREAM_OPTS: dict | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if _STREAM_OPTS is not None and name in _STREAM_OPTS.get("tables", ("events",)):
        r = spark.readStream.schema(spark.read.parquet(path).schema)
        if _STREAM_OPTS.get("max_files_per_trigger"):
            r = r.option("maxFilesPerTrigger", _STREAM_OPTS["max_files_per_trigger"])
        src = _STREAM_OPTS.get("paths", {}).get(name, path)
        at = spark._jvm.org.apache.hadoop.fs.Path(src)
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():  # file streams read folders
            return r.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
        return r.parquet(src)
    return spark.read.parquet(path)


class streaming_tables:
    """Context manager: inside it, the derived views read the named tables as file streams.

    ``paths`` maps a table to the folder to stream (e.g. a folder that receives new files).
    """

    def __init__(self, tables=("events",), max_files_per_trigger: int | None = None, paths: dict | None = None):
        self.opts = {"tables": tuple(tables), "max_files_per_trigger": max_files_per_trigger, "paths": paths or {}}

    def __enter__(self):
        global _STREAM_OPTS
        self._old, _STREAM_OPTS = _STREAM_OPTS, self.opts
        return self

    def __exit__(self, *exc):
        global _STREAM_OPTS
        _STREAM_OPTS = self._old


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _item(col: str = "props"):
    return F.get_json_object(F.col(col), "$.k").cast("long")


def user_behavior(spark: SparkSession, sf_dir: str, behavior: str | None = None) -> DataFrame:
    """UserBehavior: user_id, item_id, behavior ('pv' for views), ts (timestamp), event_id.

    ``behavior`` keeps one behaviour, filtered on the raw column so the predicate
    reaches the parquet scan (a filter on the mapped column would not push down).
    """
    e = _events(spark, sf_dir)
    if behavior is not None:
        e = e.filter(F.col("event_type") == ("view" if behavior == "pv" else behavior))
    return e.select(
        "event_id", "user_id", _item().alias("item_id"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        as_instant("ts").alias("ts"),
    )


def marketing_events(spark: SparkSession, sf_dir: str, drop_uninstall: bool = False) -> DataFrame:
    """MarketingUserBehavior: user_id, behavior (error -> UNINSTALL), channel, ts.

    ``drop_uninstall`` filters on the raw column, so the predicate is pushed to parquet."""
    e = _events(spark, sf_dir)
    if drop_uninstall:
        e = e.filter(F.col("event_type") != "error")
    return e.select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "error", F.lit("UNINSTALL")).otherwise(F.upper("event_type")).alias("behavior"),
        F.when(F.pmod("user_id", F.lit(2)) == 0, F.lit(CHANNELS[0])).otherwise(F.lit(CHANNELS[1])).alias("channel"),
        as_instant("ts").alias("ts"),
    )


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AdClickEvent: clicks of ``events`` with a province from ``nation`` (user_id % 25)."""
    from eventflow.operators.joins import lookup_join

    e = _events(spark, sf_dir).filter(F.col("event_type") == "click").select(
        "event_id", "user_id", _item().alias("ad_id"),
        F.pmod("user_id", F.lit(25)).cast("int").alias("nation_key"),
        as_instant("ts").alias("ts"))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation_key"),
                                               F.col("n_name").alias("province"))
    return lookup_join(e, n, "nation_key").drop("nation_key")


def login_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LoginEvent: error -> 'fail', anything else -> 'success'."""
    e = _events(spark, sf_dir)
    return e.select(
        "event_id", "user_id",
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("event_type"),
        as_instant("ts").alias("ts"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OrderEvent: signup -> create, purchase -> pay; order key = user_id; tx_id = event_id on pays."""
    e = _events(spark, sf_dir).filter(F.col("event_type").isin("signup", "purchase"))
    return e.select(
        "event_id", F.col("user_id").alias("order_id"),
        F.when(F.col("event_type") == "signup", F.lit("create")).otherwise(F.lit("pay")).alias("event_type"),
        F.when(F.col("event_type") == "purchase", F.col("event_id").cast("string")).otherwise(F.lit("")).alias("tx_id"),
        as_instant("ts").alias("ts"),
    )


def pay_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pays for reconciliation: one per order, tx_id = o_orderkey, time = o_orderdate."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("tx_id"),
                    F.col("o_orderkey").alias("order_id"),
                    as_instant("o_orderdate").alias("ts"))


def receipt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts: first ship date per l_orderkey (partial + final aggregate, no skew on one task)."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("ship"))
    return g.select(
        F.col("l_orderkey").cast("string").alias("tx_id"),
        F.when(F.pmod("l_orderkey", F.lit(2)) == 0, F.lit("wechat")).otherwise(F.lit("alipay")).alias("pay_channel"),
        as_instant("ship").alias("ts"),
    )


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apache-style log lines (one ``value`` column) formatted from ``events``.

    ``ip user - dd/MM/yyyy:HH:mm:ss +0000 METHOD url``; the URL is
    ``/<event_type><suffix>`` with the suffix chosen by ``props.k % 5``.
    """
    e = _events(spark, sf_dir)
    k = _item()
    suffix = F.element_at(F.array(*[F.lit(s) for s in URL_SUFFIXES]), (F.pmod(k, F.lit(5)) + 1).cast("int"))
    ip = F.concat_ws(".", F.lit("10"), F.pmod("user_id", F.lit(256)).cast("string"),
                     F.pmod(F.floor(F.col("user_id") / 256), F.lit(256)).cast("string"), F.lit("1"))
    line = F.concat_ws(
        " ", ip, F.col("user_id").cast("string"), F.lit("-"),
        F.date_format(as_instant("ts"), "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"),
        F.when(F.col("event_type").isin("purchase", "signup"), F.lit("POST")).otherwise(F.lit("GET")),
        F.concat(F.lit("/"), F.col("event_type"), suffix),
    )
    return e.select(line.alias("value"))


def behavior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UserBehavior CSV lines ``user,item,category,behavior,epoch_seconds`` formatted from ``events``."""
    b = user_behavior(spark, sf_dir)
    line = F.concat_ws(",", F.col("user_id").cast("string"), F.col("item_id").cast("string"),
                       F.pmod("item_id", F.lit(10)).cast("string"), F.col("behavior"),
                       F.unix_seconds(F.col("ts")).cast("string"))
    return b.select(line.alias("value"))

"""Text-line sources and parsers (SRC1-SRC7).

Parsing stays in JVM expressions (``split``, ``trim``, ``cast``), so it fuses into the
scan's whole-stage code. ``failfast`` uses ANSI casts (a malformed number fails the
job, as the reference's ``toLong`` does); ``permissive`` uses ``try_cast`` and routes
malformed lines to a rejects DataFrame instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

USER_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()), T.StructField("behavior", T.StringType()),
    T.StructField("ts_sec", T.LongType())])
AD_CLICK = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("ad_id", T.LongType()),
    T.StructField("province", T.StringType()), T.StructField("city", T.StringType()),
    T.StructField("ts_sec", T.LongType())])
LOGIN = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("ip", T.StringType()),
    T.StructField("event_type", T.StringType()), T.StructField("ts_sec", T.LongType())])
ORDER = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("event_type", T.StringType()),
    T.StructField("tx_id", T.StringType()), T.StructField("ts_sec", T.LongType())])
RECEIPT = T.StructType([
    T.StructField("tx_id", T.StringType()), T.StructField("pay_channel", T.StringType()),
    T.StructField("ts_sec", T.LongType())])
LOG_EVENT = T.StructType([
    T.StructField("ip", T.StringType()), T.StructField("user_id", T.StringType()),
    T.StructField("event_time", T.LongType()), T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType())])


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC1: one ``value`` row per line; batch or streaming (file source)."""
    if not streaming:
        return spark.read.text(path)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _quote(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def parse_delimited(lines: DataFrame, schema: T.StructType, sep: str = ",", mode: str = "failfast",
                    value_col: str = "value", with_rejects: bool = False, keep: tuple[str, ...] = ()):
    """Split each line on ``sep``, trim every field and cast it to the schema (SRC2-SRC6).

    An empty field stays ``""`` for strings (not NULL as the CSV reader would make it).
    Seconds columns named ``ts_sec`` also get ``ts`` (timestamp) for event time.
    ``keep`` names columns of ``lines`` to carry along (e.g. a line number as tie-break).
    Returns the parsed DataFrame, or ``(parsed, rejects)`` when ``with_rejects``.
    """
    if mode not in ("failfast", "permissive"):
        raise ValueError("mode must be 'failfast' or 'permissive'")
    if mode == "failfast" and with_rejects:
        raise ValueError("failfast has no rejects: a malformed line ends the job")
    parts = F.split(F.col(value_col), _quote(sep), -1)
    n = len(schema.fields)
    cols = []
    for i, f in enumerate(schema.fields):
        raw = F.trim(F.get(parts, F.lit(i)))  # a short line's missing fields are null
        if isinstance(f.dataType, T.StringType):
            cols.append(raw.alias(f.name))
            continue
        if mode == "failfast":
            cols.append(raw.cast(f.dataType).alias(f.name))
        else:
            cols.append(raw.try_cast(f.dataType).alias(f.name))
    out = lines.select(*keep, *cols, F.size(parts).alias("_n"), F.col(value_col).alias("_line"))
    if "ts_sec" in schema.fieldNames():
        out = out.withColumn("ts", F.timestamp_seconds(F.col("ts_sec")))
    if mode == "failfast":
        return out.drop("_n", "_line")
    malformed = F.col("_n") < n
    for i, f in enumerate(schema.fields):
        if not isinstance(f.dataType, T.StringType):
            malformed = malformed | F.col(f.name).isNull()
    good = out.filter(~malformed).drop("_n", "_line")
    if not with_rejects:
        return good
    return good, out.filter(malformed).select(F.col("_line").alias(value_col))


def parse_access_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """SRC7: ``ip user - dd/MM/yyyy:HH:mm:ss zone method url`` -> LogEvent (event_time in epoch ms).

    The zone token is ignored and the time is read in the session time zone (UTC).
    """
    p = F.split(F.col(value_col), " ", -1)
    t = F.to_timestamp(F.trim(F.get(p, F.lit(3))), "dd/MM/yyyy:HH:mm:ss")
    return lines.select(F.trim(F.get(p, F.lit(0))).alias("ip"), F.trim(F.get(p, F.lit(1))).alias("user_id"),
                        F.unix_millis(t).alias("event_time"), F.trim(F.get(p, F.lit(5))).alias("method"),
                        F.trim(F.get(p, F.lit(6))).alias("url"), t.alias("ts"))


def format_delimited(df: DataFrame, cols: list[str | Column], sep: str = ",") -> DataFrame:
    """Inverse of ``parse_delimited``: one ``value`` line per row (for loaders and tests)."""
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                        for c in cols]).alias("value"))

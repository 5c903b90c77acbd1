"""Kafka source and loader (SRC8, SNK3).

The Kafka connector is a separate package that must be on the cluster's class path
(``spark-sql-kafka-0-10``). Options are built here; the transform after the read is
the same ``parse_delimited`` used for files, so it is tested without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the reference job: topic, consumer group and start position.
DEFAULT_TOPIC = "user-behaviors"
DEFAULT_GROUP = "consumer-group"
DEFAULT_STARTING_OFFSETS = "latest"


def source_options(servers: str, topic: str = DEFAULT_TOPIC, group: str = DEFAULT_GROUP,
                   starting_offsets: str = DEFAULT_STARTING_OFFSETS) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "kafka.group.id": group, "startingOffsets": starting_offsets}


def read_kafka_lines(spark: SparkSession, servers: str, topic: str = DEFAULT_TOPIC,
                     group: str = DEFAULT_GROUP, starting_offsets: str = DEFAULT_STARTING_OFFSETS) -> DataFrame:
    """Streaming DataFrame of the topic's values as text (``value`` column)."""
    r = spark.readStream.format("kafka")
    for k, v in source_options(servers, topic, group, starting_offsets).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"))


def write_kafka_lines(lines: DataFrame, servers: str, topic: str = DEFAULT_TOPIC) -> None:
    """Loader (SNK3): write each ``value`` line of a batch DataFrame as one record."""
    (lines.select(F.col("value").cast("string").alias("value"))
          .write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def connector_available(spark: SparkSession) -> bool:
    """True when the Kafka data source class can be loaded by the JVM."""
    try:
        jvm = spark.sparkContext._jvm
        jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False

"""The keyed topic: Kafka, a topic log in files, or plain files with the same columns where there is no broker.

The Kafka connector is a separate Spark package; only its options are built
here. A Kafka source and a file source give the same columns, so every
operator and stream takes either.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.params import required_name
from tidewatch.schemas import DEFAULT_TOPIC, TOPIC_COLUMNS, TOPIC_SCHEMA
from tidewatch.sources.topic_log import FORMAT, register


def broker_options(
    brokers: Sequence[str], username: str | None = None, password: str | None = None
) -> dict[str, str]:
    """Connection options shared by reading and writing; credentials turn on TLS and SASL."""
    servers = ",".join(name.strip() for name in brokers if name.strip())
    if not servers:
        raise ValueError("brokers are required")
    options = {"kafka.bootstrap.servers": servers}
    if username:
        quoted = [part.replace("\\", "\\\\").replace('"', '\\"') for part in (username, password or "")]
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                "org.apache.kafka.common.security.plain.PlainLoginModule required "
                f'username="{quoted[0]}" password="{quoted[1]}";'
            ),
        }
    return options


def read_options(
    brokers: Sequence[str],
    topic: str = DEFAULT_TOPIC,
    group: str | None = None,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    **credentials,
) -> dict[str, str]:
    """Options of a Kafka read from the earliest offset.

    `max_offsets` bounds a micro-batch. `min_partitions` splits the offset
    ranges of few or uneven topic partitions over that many tasks.
    """
    options = broker_options(brokers, **credentials) | {
        "subscribe": required_name("topic", topic),
        "startingOffsets": "earliest",
    }
    if group:
        options["groupIdPrefix"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def write_options(brokers: Sequence[str], topic: str = DEFAULT_TOPIC, **credentials) -> dict[str, str]:
    """Options of a Kafka write: partition by key hash, one broker acknowledges."""
    return broker_options(brokers, **credentials) | {
        "topic": required_name("topic", topic),
        "kafka.acks": "1",
    }


def _as_messages(kafka: DataFrame) -> DataFrame:
    return kafka.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        *TOPIC_COLUMNS[2:],
    )


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return _as_messages(spark.read.format("kafka").options(**options).load())


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return _as_messages(spark.readStream.format("kafka").options(**options).load())


def stream_topic_log(spark: SparkSession, path: str, topic: str = DEFAULT_TOPIC, max_offsets: int | None = None) -> DataFrame:
    """A stream of the topic log in a folder; `max_offsets` bounds a micro-batch, also inside files.

    A query that should stop when all is read uses short intervals and
    `processAllAvailable`: the available-now trigger takes one batch only.
    """
    reader = register(spark).readStream.format(FORMAT).option("path", path).option("topic", required_name("topic", topic))
    if max_offsets:
        reader = reader.option("maxOffsets", max_offsets)
    return reader.load()


def read_topic_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC_SCHEMA).parquet(path)


def stream_topic_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)

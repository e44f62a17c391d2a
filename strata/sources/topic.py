"""Topic sources and producer.

A topic is either a Kafka topic (when ``bootstrap_servers`` is given and the
Kafka connector is on the classpath) or a parquet "topic directory" with the
Kafka frame columns that the jobs use: ``key BINARY, value BINARY,
offset BIGINT``.  Both read as a frame with a binary ``value`` column, so the
parsing code is the same for both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import TOPIC


@dataclass(frozen=True)
class Topic:
    name: str
    path: str | None = None
    bootstrap_servers: str | None = None
    starting_offsets: str = "earliest"

    @property
    def is_kafka(self) -> bool:
        return self.bootstrap_servers is not None


# Topic names of the two event streams.
PLAIN_TOPIC = "plain-topic"
PO_TOPIC = "purchase-order"


def message_frame(
    df: DataFrame,
    payload: list[str] | None = None,
    key: Column | str | None = None,
    offset: Column | str | None = None,
) -> DataFrame:
    """One JSON message per row: ``value = to_json(struct(payload))`` (X11).

    ``payload`` defaults to all columns; ``key`` and ``offset`` may name
    columns outside the payload (e.g. a sequence number).
    """
    def as_col(c: Column | str) -> Column:
        return F.col(c) if isinstance(c, str) else c

    fields = payload if payload is not None else df.columns
    value = F.to_json(F.struct(*[F.col(c) for c in fields])).cast("binary")
    key_col = (
        F.lit(None).cast("binary")
        if key is None
        else as_col(key).cast("string").cast("binary")
    )
    offset_col = F.lit(None).cast("long") if offset is None else as_col(offset).cast("long")
    return df.select(key_col.alias("key"), value.alias("value"), offset_col.alias("offset"))


def produce(messages: DataFrame, topic: Topic) -> None:
    """Append a message frame to the topic (K7).

    Kafka: the standard Kafka sink.  Directory: a parquet append, written by
    the executors, one file set per task.
    """
    if topic.is_kafka:
        (
            messages.select("key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", topic.bootstrap_servers)
            .option("topic", topic.name)
            .save()
        )
    else:
        # text of one shape over and over: a third of its size under zstd
        messages.write.mode("append").option("compression", "zstd").parquet(topic.path)


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """Batch read of everything in the topic."""
    if topic.is_kafka:
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", topic.bootstrap_servers)
            .option("subscribe", topic.name)
            .option("startingOffsets", topic.starting_offsets)
            .load()
            .select("key", "value", "offset")
        )
    return spark.read.schema(TOPIC).parquet(topic.path)


def read_topic_stream(
    spark: SparkSession, topic: Topic, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming read from the earliest offset."""
    if topic.is_kafka:
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", topic.bootstrap_servers)
            .option("subscribe", topic.name)
            .option("startingOffsets", topic.starting_offsets)
            .load()
            .select("key", "value", "offset")
        )
    reader = spark.readStream.schema(TOPIC).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(topic.path)

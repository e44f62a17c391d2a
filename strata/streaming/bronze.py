"""Streaming bronze jobs (C1, C4): topic -> parse -> bronze folder.

Both are stateless projections of the stream (T7): no shuffle, no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.functions.parse import parse_checked
from strata.plans import plain as plain_plan
from strata.plans import purchase_order as po_plan
from strata.sinks.audit import STREAMS
from strata.sources.topic import Topic, read_topic_stream
from strata.streaming.sinks import (
    DEFAULT_INTERVAL,
    batch_folder_writer,
    file_sink,
    foreach_batch_sink,
    quarantine_writer,
)


def plain_bronze_stream(
    spark: SparkSession,
    topic: Topic,
    bronze_path: str,
    checkpoint: str,
    trigger: str | None = DEFAULT_INTERVAL,
    keep_offset: bool = True,
) -> StreamingQuery:
    """Plain events to a parquet folder through the file sink.

    The original job declares both a batch callback and the file sink; the
    file sink is the one that takes effect, so this is the file sink.
    """
    return file_sink(plain_rows(spark, topic, keep_offset), bronze_path, checkpoint, trigger, query_name=None)


def plain_rows(spark: SparkSession, topic: Topic, keep_offset: bool = True) -> DataFrame:
    """The parsed stream of plain events."""
    return plain_plan.bronze(read_topic_stream(spark, topic), keep_offset=keep_offset)


def po_bronze_stream(
    spark: SparkSession,
    topic: Topic,
    bronze_path: str,
    checkpoint: str,
    trigger: str | None = DEFAULT_INTERVAL,
    audit_path: str | None = None,
    steps: str | None = None,
) -> StreamingQuery:
    """Purchase orders through the micro-batch callback (C4, K1, K3, K8)."""
    parsed = po_plan.bronze(read_topic_stream(spark, topic))
    handler = batch_folder_writer(bronze_path, audit_path, STREAMS["purchase_order"][0], steps)
    return foreach_batch_sink(parsed, handler, checkpoint, trigger)


def checked_bronze_stream(
    spark: SparkSession,
    topic: Topic,
    schema: T.StructType,
    bronze_path: str,
    checkpoint: str,
    trigger: str | None = DEFAULT_INTERVAL,
    required: list[str] | None = None,
) -> StreamingQuery:
    """Topic to bronze with a quarantine: faulty messages go to a folder of their own,
    as text with the reason; each message is parsed once."""
    parsed = parse_checked(read_topic_stream(spark, topic), schema, ["offset"], required)
    return foreach_batch_sink(parsed, quarantine_writer(bronze_path), checkpoint, trigger)

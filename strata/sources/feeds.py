"""Topics filled from the input tables, written once per session.

A topic is a materialized boundary between producer and consumer, as a
Kafka topic is; writing it keeps the producer's ``to_json`` out of the
consumer's plan.  The folder sits under the shared checkpoint root.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from strata.session import fine_splits, work_dir
from strata.sources.topic import PLAIN_TOPIC, PO_TOPIC, Topic, produce

_TOPICS: dict[tuple[str, str, str], Topic] = {}


def _memo(spark: SparkSession, data_dir: str, kind: str, build) -> Topic:
    key = (spark.sparkContext.applicationId, data_dir.rstrip("/"), kind)
    topic = _TOPICS.get(key)
    if topic is None:
        with fine_splits(spark):
            topic = build()
        _TOPICS[key] = topic
    return topic


def plain_topic(spark: SparkSession, data_dir: str, mixed: bool = False) -> Topic:
    """Plain events topic; ``mixed`` gives the mixed-quality feed."""
    from strata.plans import plain

    def build() -> Topic:
        topic = Topic(PLAIN_TOPIC, path=work_dir(spark, "topic-plain"))
        to_messages = plain.mixed_messages if mixed else plain.messages
        produce(to_messages(plain.events(spark, data_dir)), topic)
        return topic

    return _memo(spark, data_dir, "plain-mixed" if mixed else "plain", build)


def po_topic(spark: SparkSession, data_dir: str, mixed: bool = False) -> Topic:
    """Purchase-order topic; ``mixed`` gives the mixed-quality feed."""
    from strata.plans import purchase_order

    def build() -> Topic:
        topic = Topic(PO_TOPIC, path=work_dir(spark, "topic-po"))
        to_messages = purchase_order.mixed_messages if mixed else purchase_order.messages
        produce(to_messages(purchase_order.documents(spark, data_dir)), topic)
        return topic

    return _memo(spark, data_dir, "purchase_order-mixed" if mixed else "purchase_order", build)

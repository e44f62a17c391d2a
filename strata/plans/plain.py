"""Plain-event flow: topic -> bronze -> silver -> gold.

* bronze: cast, parse, star-expand (P1-P3); the topic offset is kept as
  ``seq``, the order in which a keyed store would have received the rows.
* silver: ``amount < 100`` (F1), pushed to the parquet scan when read from
  a folder or table.
* gold: latest row per ``id`` by ``seq`` (A7), typed-attribute items (P9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.encode import encode_item, flatten_item
from strata.functions.parse import parse_topic
from strata.operators.keyed import latest_per_key
from strata.operators.transform import clean_plain
from strata.schemas import PLAIN
from strata.sources.documents import plain_events
from strata.sources.tables import read_source_table
from strata.sources.topic import message_frame

PAYLOAD = ["id", "name", "amount"]
GOLD_ITEM = {"id": "N", "name": "S", "amount": "N"}

# The mixed-quality feed.  Events of these types
# reach the topic in a faulty shape; every other event is well formed.
ID_AS_TEXT_TYPE = "signup"  # {"id": "7", ...}: a string for the INT field
NOT_JSON_TYPE = "error"  # "error 7": not JSON at all


def events(spark: SparkSession, data_dir: str) -> DataFrame:
    """Plain events ``(id, name, amount, seq)`` from the input tables."""
    return plain_events(read_source_table(spark, data_dir, "events"))


def messages(events_df: DataFrame) -> DataFrame:
    """Topic frame: JSON ``{id, name, amount}`` with ``offset = seq`` (K7)."""
    return message_frame(events_df, payload=PAYLOAD, offset="seq")


def mixed_messages(events_df: DataFrame) -> DataFrame:
    """Topic frame of a producer that sometimes gets the shape wrong.

    Same events, same offsets, one message each; only the wire text differs
    by event type.  Parsing keeps every row: a string id gives a NULL id
    with name and amount kept, a non-JSON message gives a row of NULLs.
    """
    good = F.to_json(F.struct(*[F.col(c) for c in PAYLOAD]))
    id_as_text = F.to_json(F.struct(F.col("id").cast("string").alias("id"), "name", "amount"))
    not_json = F.concat(F.lit(NOT_JSON_TYPE + " "), F.col("id").cast("string"))
    value = (
        F.when(F.col("name") == ID_AS_TEXT_TYPE, id_as_text)
        .when(F.col("name") == NOT_JSON_TYPE, not_json)
        .otherwise(good)
    )
    return events_df.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.col("seq").cast("long").alias("offset"),
    )


def bronze(topic_frame: DataFrame, keep_offset: bool = True) -> DataFrame:
    """``CAST(value AS STRING)`` -> ``from_json`` -> ``data.*``."""
    keep = ["offset"] if keep_offset else []
    out = parse_topic(topic_frame, PLAIN, keep)
    return out.withColumnRenamed("offset", "seq") if keep_offset else out


def silver(bronze_df: DataFrame) -> DataFrame:
    """``amount < 100`` (F1)."""
    return clean_plain(bronze_df)


def gold(silver_df: DataFrame) -> DataFrame:
    """One row per ``id``: the row with the highest ``seq``."""
    return latest_per_key(silver_df, "id", "seq")


def gold_items(gold_df: DataFrame) -> DataFrame:
    """Key-store items ``id {N}, name {S}, amount {N}``."""
    return encode_item(gold_df, GOLD_ITEM)


def gold_items_flat(gold_df: DataFrame) -> DataFrame:
    return flatten_item(gold_items(gold_df), GOLD_ITEM)


def silver_table_columns(with_seq: bool = True) -> list[tuple[str, str]]:
    cols = [("id", "INT"), ("name", "STRING"), ("amount", "INT")]
    return cols + [("seq", "BIGINT")] if with_seq else cols


def bronze_schema(with_seq: bool = True):
    from pyspark.sql import types as T

    fields = list(PLAIN.fields)
    if with_seq:
        fields.append(T.StructField("seq", T.LongType(), True))
    return T.StructType(fields)

"""Purchase-order flow: topic -> bronze -> silver -> gold.

The pure transformations take and return DataFrames; the ``run_*`` jobs add
the reads and writes.  Per layer:

* bronze: cast the binary value, parse by schema, lift contact fields.
  Narrow, streaming-capable.
* silver: explode items, keep ``weight_quantity > 5000``.  Narrow.
* gold: per-email totals.  One shuffle on ``email`` after a partial
  aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.encode import encode_item, flatten_item
from strata.functions.money import mean_text, sum_text
from strata.functions.parse import parse_json, value_as_string
from strata.operators.aggregates import customer_totals, customer_totals_from_documents
from strata.operators.transform import flatten_po, silver_lines, silver_lines_prefiltered
from strata.schemas import CONTACT_INFO, PO_BRONZE_COLUMNS, PURCHASE_ORDER
from strata.sources.documents import purchase_order_documents
from strata.sources.tables import read_source_table
from strata.sources.topic import message_frame

GOLD_ITEM = {"email": "S", "total_purchase_amount": "N", "average_purchase_amount": "N"}
WIRE_FIELDS = ["contact_info", "po_number", "items", "subtotal", "taxes", "total", "payment_due_date"]
# Fixed value: in the mixed-quality feed, orders in this status are sent
# before the customer is known, without ``contact_info``.
NO_CONTACT_STATUS = "P"


def documents(spark: SparkSession, data_dir: str, max_items: int | None = None) -> DataFrame:
    """Purchase-order documents assembled from the input tables."""
    t = lambda name: read_source_table(spark, data_dir, name)
    kwargs = {} if max_items is None else {"max_items": max_items}
    return purchase_order_documents(t("orders"), t("customer"), t("lineitem"), t("part"), **kwargs)


def messages(docs: DataFrame) -> DataFrame:
    """Topic frame: one JSON message per document, keyed by po number (K7)."""
    return message_frame(docs, payload=WIRE_FIELDS, key="po_number")


def mixed_messages(docs: DataFrame) -> DataFrame:
    """Topic frame where orders in ``NO_CONTACT_STATUS`` lack the contact
    block: after parsing, their name, email and phone are NULL, and the
    per-email totals carry a NULL group (as ``groupBy`` keeps NULL keys)."""
    full = F.to_json(F.struct(*[F.col(c) for c in WIRE_FIELDS]))
    no_contact = F.to_json(F.struct(*[F.col(c) for c in WIRE_FIELDS if c != "contact_info"]))
    value = F.when(F.col("order_status") == NO_CONTACT_STATUS, no_contact).otherwise(full)
    return docs.select(
        F.col("po_number").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(None).cast("long").alias("offset"),
    )


def bronze(topic_frame: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Cast, parse and flatten (P1, P2, P4): nine bronze columns."""
    keep = keep or []
    parsed = parse_json(value_as_string(topic_frame, keep), PURCHASE_ORDER, keep)
    return flatten_po(parsed, keep)


def bronze_schema() -> T.StructType:
    """The nine bronze columns with the types of the wire."""
    wire = {f.name: f for f in [*CONTACT_INFO.fields, *PURCHASE_ORDER.fields]}
    return T.StructType([wire[c] for c in PO_BRONZE_COLUMNS])


def silver(bronze_df: DataFrame, prefilter: bool = False) -> DataFrame:
    """Order lines with ``weight_quantity > 5000``."""
    return silver_lines_prefiltered(bronze_df) if prefilter else silver_lines(bronze_df)


def gold(silver_df: DataFrame, level: str = "line", keep_parts: bool = False) -> DataFrame:
    """Per-email totals (A1-A3)."""
    return customer_totals(silver_df, level, keep_parts)


def gold_from_bronze(bronze_df: DataFrame, level: str = "line", keep_parts: bool = False) -> DataFrame:
    """Per-email totals straight from bronze documents: the same rows as
    ``gold(silver(bronze_df))`` without generating the silver lines."""
    return customer_totals_from_documents(bronze_df, level, keep_parts)


def gold_items(totals: DataFrame) -> DataFrame:
    """Key-store items ``email {S}, total {N}, average {N}``.

    ``totals`` must carry ``_sum``, ``_rest`` and ``_n`` (``gold(..., keep_parts=True)``):
    number text is exact decimal, never a binary expansion.  A total that is
    no exact decimal is written as its DOUBLE, and one that is not finite is left out.
    """
    def text_of(name: str, exact: Column) -> Column:
        finite = F.abs(F.col(name)) < F.lit(float("inf"))
        return F.when(F.col("_rest").isNull(), exact).when(finite, F.col(name).cast("string"))

    text = {
        "total_purchase_amount": text_of("total_purchase_amount", sum_text(F.col("_sum"))),
        "average_purchase_amount": text_of("average_purchase_amount", mean_text("_sum", "_n")),
    }
    return encode_item(totals, GOLD_ITEM, text)


def gold_items_flat(totals: DataFrame) -> DataFrame:
    return flatten_item(gold_items(totals), GOLD_ITEM)

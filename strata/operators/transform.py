"""Row-level cleaning: filters, explode, flatten.

All narrow: no shuffle.  Filters on top-level columns reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.schemas import PO_BRONZE_COLUMNS, PO_SILVER_COLUMNS

# The cleaning thresholds of the two silver jobs.
PLAIN_MAX_AMOUNT = 100  # keep amount < 100 (strict)
PO_MIN_WEIGHT = 5000  # keep weight_quantity > 5000 (strict)


def clean_plain(bronze: DataFrame, max_amount: int = PLAIN_MAX_AMOUNT) -> DataFrame:
    """``amount < max_amount`` (F1).  NULL amounts drop, negatives stay."""
    return bronze.filter(F.col("amount") < F.lit(max_amount))


def flatten_po(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Bronze shape of a parsed document: contact fields lifted."""
    keep = keep or []
    cols = [
        F.col("data.contact_info.name").alias("name"),
        F.col("data.contact_info.email").alias("email"),
        F.col("data.contact_info.phone").alias("phone"),
    ] + [F.col(f"data.{c}").alias(c) for c in PO_BRONZE_COLUMNS[3:]]
    return parsed.select(*cols, *keep)


def explode_lines(bronze: DataFrame) -> DataFrame:
    """One row per item, order fields repeated, twelve flat columns.

    ``inline`` drops NULL and empty arrays and keeps a NULL element (whose
    item fields are NULL).
    """
    order_fields = [c for c in PO_BRONZE_COLUMNS if c != "items"]
    return bronze.select(*order_fields, F.inline("items")).select(*PO_SILVER_COLUMNS)


def heavy_lines(lines: DataFrame, min_weight: int = PO_MIN_WEIGHT) -> DataFrame:
    """``weight_quantity > min_weight`` (F2); NULL weights drop."""
    return lines.filter(F.col("weight_quantity") > F.lit(min_weight))


def silver_lines(bronze: DataFrame, min_weight: int = PO_MIN_WEIGHT) -> DataFrame:
    """Explode then filter: the silver rows, as the original job states it."""
    return heavy_lines(explode_lines(bronze), min_weight)


def silver_lines_prefiltered(bronze: DataFrame, min_weight: int = PO_MIN_WEIGHT) -> DataFrame:
    """Same rows as ``silver_lines``, with the item filter applied inside the
    array before the explode: rows that would be dropped are never generated
    (a predicate on an exploded element cannot be pushed below ``Generate``).
    """
    kept = F.filter("items", lambda x: x["weight_quantity"] > F.lit(min_weight))
    return explode_lines(bronze.withColumn("items", kept)).select(*PO_SILVER_COLUMNS)

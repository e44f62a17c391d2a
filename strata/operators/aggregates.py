"""Customer totals and counts (A1-A4, Q1).

Money is summed as DECIMAL at nine decimals, with a DOUBLE sum beside it for
amounts that are not exact there (``strata.functions.money.sum_parts``): the
result does not depend on task layout, a hot email (a third of all rows) is
combined map-side before the shuffle, and a NaN stays with its own email.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.money import sum_parts, total_of
from strata.operators.transform import PO_MIN_WEIGHT

LEVELS = ("line", "order")


def _totals(df: DataFrame, key: str, amount: str, keep_parts: bool = False) -> DataFrame:
    agg = df.groupBy(key).agg(
        *sum_parts(F.col(amount)),
        F.count(F.col(amount)).alias("_n"),
    )
    return finish_totals(agg, key, keep_parts)


def finish_totals(agg: DataFrame, key: str, keep_parts: bool = False) -> DataFrame:
    """Output columns from the parts ``_sum``, ``_rest`` and ``_n`` (count)."""
    total = total_of(F.col("_sum"), F.col("_rest"))
    return agg.select(
        F.col(key),
        total.alias("total_purchase_amount"),
        F.when(F.col("_n") > 0, total / F.col("_n")).alias("average_purchase_amount"),
        *([F.col("_sum"), F.col("_rest"), F.col("_n")] if keep_parts else []),
    )


def customer_totals(silver: DataFrame, level: str = "line", keep_parts: bool = False) -> DataFrame:
    """Per-email ``total_purchase_amount`` and ``average_purchase_amount``.

    ``level="line"`` (default, as the original gold job): every silver line
    counts its order's ``total`` once, so an order with k qualifying lines
    counts k times and the average is line-weighted.

    ``level="order"``: each order ``(email, po_number)`` counts once; orders
    with no qualifying line stay out.  Two aggregates: the first collapses
    lines to orders (partial aggregation removes repeats map-side), the
    second is the per-email total.

    ``keep_parts`` adds the sums ``_sum`` and ``_rest`` and the count ``_n``.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}")
    if level == "order":
        silver = silver.groupBy("email", "po_number").agg(F.max("total").alias("total"))
    return _totals(silver, "email", "total", keep_parts)


def qualifying_lines(items: str = "items", min_weight: int = PO_MIN_WEIGHT) -> Column:
    """Number of a document's items with ``weight_quantity > min_weight``:
    the number of silver lines the document gives (0 for NULL or empty)."""
    weights = F.col(f"{items}.weight_quantity")
    return F.coalesce(F.size(F.filter(weights, lambda w: w > F.lit(min_weight))), F.lit(0))


def customer_totals_from_documents(
    bronze: DataFrame, level: str = "line", keep_parts: bool = False, min_weight: int = PO_MIN_WEIGHT
) -> DataFrame:
    """The same totals as ``customer_totals(silver_lines(bronze))``, without
    generating the lines.

    Every silver line of a document repeats the document's ``total``, so a
    document with k qualifying lines adds ``k * total`` to the sum and
    ``k`` to the count.  The plan is a narrow projection plus one aggregate;
    the scan reads ``email``, ``total`` and ``items.weight_quantity`` only.
    Order level: documents with k > 0, one value per ``(email, po_number)``
    (an order split into several documents counts once).
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}")
    k = qualifying_lines(min_weight=min_weight)
    docs = bronze.select("email", "po_number", "total", k.alias("_k"))
    if level == "order":
        orders = docs.where(F.col("_k") > 0).groupBy("email", "po_number").agg(F.max("total").alias("total"))
        return _totals(orders, "email", "total", keep_parts)
    # A document without qualifying lines adds nothing to either sum, so the
    # email filter can follow the aggregate (HAVING): ``_k`` is then evaluated
    # once per document instead of once in a filter and again in the
    # projection.
    parts = line_total_parts(docs, with_lines=True).where(F.col("_lines") > 0).drop("_lines")
    return finish_totals(parts, "email", keep_parts)


def line_total_parts(docs: DataFrame, with_lines: bool = False) -> DataFrame:
    """``email, _sum, _rest, _n`` from documents with their line count ``_k``.
    Also the state of the streaming form.
    ``with_lines`` adds ``_lines = Σ k``."""
    total = F.col("total")
    k = F.col("_k")
    aggs = [
        # a document without qualifying lines adds nothing, not 0: the sum
        # stays NULL when every qualifying line has a NULL total
        *sum_parts(total, k),
        F.sum(F.when(total.isNotNull(), k).otherwise(F.lit(0))).alias("_n"),
    ]
    if with_lines:
        aggs.append(F.sum(k).alias("_lines"))
    return docs.groupBy("email").agg(*aggs)


def count_rows(df: DataFrame) -> int:
    """Row count (A4)."""
    return df.count()


def observed_count(df: DataFrame, name: str) -> tuple[DataFrame, object]:
    """Attach a row-count metric computed by the next action on the frame
    (A4 without a second job).  Returns the frame and its ``Observation``."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs

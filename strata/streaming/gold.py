"""Streaming gold: per-email totals kept up to date from the bronze folder.

The batch gold job recomputes the totals from the whole silver table on
every run.  This is the incremental form: a stateful streaming aggregate
(state per email in the checkpoint's state store, partitioned by the
shuffle on ``email``) in ``update`` mode, so each micro-batch emits only the
emails whose totals changed.  Those rows land as one change folder per
micro-batch (merge-on-read, ``sinks.keyed.write_changes``), with the batch
id as the sequence, so a replayed batch writes the same values again.  A
compaction every ``compact_every`` batches folds the changes into a
snapshot; read the table with ``read_merged``.  A micro-batch costs
O(changed emails), not O(all emails).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.aggregates import finish_totals, line_total_parts, qualifying_lines
from strata.schemas import ORDER_ITEM
from strata.sinks.keyed import compact, write_changes
from strata.sources.batches import read_batches_stream
from strata.streaming.sinks import foreach_batch_sink, run_to_end

# The columns of bronze that the totals need.
TOTALS_INPUT = T.StructType(
    [T.StructField("email", T.StringType()), T.StructField("total", T.DoubleType()), T.StructField("items", T.ArrayType(ORDER_ITEM))]
)


def stream_customer_totals(
    spark: SparkSession,
    bronze_path: str,
    gold_path: str,
    checkpoint: str,
    trigger: str | None = "availableNow",
    compact_every: int = 20,
) -> None:
    """Bronze folder -> silver lines -> per-email totals -> current table."""
    docs = read_batches_stream(spark, bronze_path, TOTALS_INPUT)
    # line-level totals without generating the lines (see
    # customer_totals_from_documents): two sums and a count of state per email
    k = qualifying_lines()
    state = line_total_parts(docs.select("email", "total", k.alias("_k")).where(F.col("_k") > 0))

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = finish_totals(batch, "email", keep_parts=True).withColumn("seq", F.lit(batch_id).cast("long"))
        write_changes(spark, gold_path, rows, batch_id)
        if (batch_id + 1) % compact_every == 0:
            compact(spark, gold_path, "email", "seq", batch_id)

    run_to_end(foreach_batch_sink(state, merge, checkpoint, trigger, output_mode="update"))

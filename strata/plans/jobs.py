"""The six layer jobs with their reads and writes.

Each job takes its locations as arguments; nothing is hard-wired to one
machine.  Bronze jobs are streams (``trigger`` = interval, or
``"availableNow"`` to drain and stop); silver and gold jobs are batch.  Their
scans are cut finer than Spark's default (``session.fine_splits``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.plans import plain as plain_plan
from strata.plans import purchase_order as po_plan
from strata.schemas import po_silver_columns
from strata.session import with_fine_splits
from strata.operators.keyed import latest_per_key, split_null_keys
from strata.sinks.audit import STREAMS, record_step, run_audited
from strata.sinks.buckets import read_buckets, rows_written, table_version, upsert_buckets
from strata.sinks.keyed import PLAIN_GOLD_KEY, PO_GOLD_KEY
from strata.sinks.store import REJECTS, put
from strata.sinks.tables import append, create_database, create_table, register_table
from strata.sources.batches import read_batches
from strata.sources.topic import Topic
from strata.streaming.bronze import plain_rows, po_bronze_stream
from strata.streaming.silver import incremental_append
from strata.streaming.sinks import file_sink, run_to_end

MODES = ("full", "incremental")


def _database_of(table: str) -> str:
    return table.rsplit(".", 1)[0]


# --- bronze (streams) -------------------------------------------------------
@with_fine_splits
def plain_bronze(
    spark: SparkSession, topic: Topic, bronze_path: str, checkpoint: str, trigger: str | None = None, steps: str | None = None
) -> None:
    """Topic -> parse -> parquet file sink.  Blocks until the stream ends
    (``availableNow``) or fails.  ``steps``, here and in all jobs: a folder to which one
    record per batch is appended (K8)."""
    start = lambda df: file_sink(df, bronze_path, checkpoint, trigger)
    run_audited(spark, plain_rows(spark, topic), start, steps, STREAMS["plain"][0])


@with_fine_splits
def po_bronze(
    spark: SparkSession,
    topic: Topic,
    bronze_path: str,
    checkpoint: str,
    trigger: str | None = None,
    audit_path: str | None = None,
    steps: str | None = None,
) -> None:
    """C4: topic -> parse -> flatten -> batch folders (+ audit records)."""
    run_to_end(po_bronze_stream(spark, topic, bronze_path, checkpoint, trigger, audit_path, steps))


# --- silver (batch, full or incremental) ------------------------------------
@with_fine_splits
def plain_silver(
    spark: SparkSession,
    bronze_path: str,
    table: str,
    mode: str = "incremental",
    checkpoint: str | None = None,
    using: str = "parquet",
    location: str | None = None,
    steps: str | None = None,
) -> None:
    """Create database and table, append ``amount < 100`` rows.

    ``mode="full"`` re-reads all of bronze and appends (a rerun duplicates,
    as the original job); ``"incremental"`` appends only new bronze files.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    create_database(spark, _database_of(table))
    create_table(spark, table, plain_plan.silver_table_columns(), using, location)
    if mode == "full":
        bronze = spark.read.schema(plain_plan.bronze_schema()).parquet(bronze_path)
        append(plain_plan.silver(bronze), table, using)
    else:
        incremental_append(
            spark, bronze_path, plain_plan.bronze_schema(), plain_plan.silver, table, checkpoint, using,
            steps=steps and (steps, STREAMS["plain"][1]),
        )


@with_fine_splits
def po_silver(
    spark: SparkSession,
    bronze_path: str,
    table: str,
    mode: str = "incremental",
    checkpoint: str | None = None,
    money: str = "double",
    using: str = "parquet",
    location: str | None = None,
    overflow: str | None = None,
    steps: str | None = None,
) -> None:
    """Create database and table, append exploded lines with
    ``weight_quantity > 5000``.  ``money="float"`` stores money as FLOAT,
    as the original table does; lines with a number that the type cannot hold go to the
    folder ``overflow`` if one is given (incremental mode)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    create_database(spark, _database_of(table))
    create_table(spark, table, po_silver_columns(money), using, location)
    transform = lambda df: po_plan.silver(df, prefilter=True)
    if mode == "full":
        append(transform(read_batches(spark, bronze_path, po_plan.bronze_schema())), table, using)
    else:
        schema = po_plan.bronze_schema()
        incremental_append(spark, bronze_path, schema, transform, table, checkpoint, using, overflow, steps and (steps, STREAMS["purchase_order"][1]))


# --- gold (batch) -----------------------------------------------------------
@with_fine_splits
def plain_gold(
    spark: SparkSession,
    silver_table: str,
    gold_path: str,
    store_path: str | None = None,
    location: str | None = None,
    steps: str | None = None,
) -> int:
    """Latest row per ``id`` merged into the bucketed current table, and put
    as items into the key-value store at ``store_path``; returns the version of the table.

    ``location`` finds a silver table that another session wrote.
    """
    if location:
        register_table(spark, silver_table, location)
    # the upsert keeps the latest row per id over current and silver in one aggregate
    good, bad = split_null_keys(spark.table(silver_table), PLAIN_GOLD_KEY)
    version = upsert_buckets(spark, gold_path, good, PLAIN_GOLD_KEY, "seq")
    latest_per_key(bad, PLAIN_GOLD_KEY, "seq", keep_seq=True).write.mode("overwrite").parquet(f"{gold_path}/{REJECTS}/version={version}")
    if store_path:
        put(plain_plan.gold_items(read_buckets(spark, gold_path, version)), f"{PLAIN_GOLD_KEY}.N", store_path)
    if steps:
        record_step(spark, steps, STREAMS["plain"][2], "upsert", version, rows_written(spark, gold_path, version))
    return version


@with_fine_splits
def po_gold(
    spark: SparkSession,
    silver_table: str,
    gold_path: str,
    level: str = "line",
    store_path: str | None = None,
    location: str | None = None,
    steps: str | None = None,
) -> int:
    """Per-email totals of the whole silver table replace the previous
    values per email, in the bucketed current table and in the store.  The
    sequence is the version of the table that the run writes; returns it."""
    if location:
        register_table(spark, silver_table, location)
    totals = po_plan.gold(spark.table(silver_table), level, keep_parts=True)
    version = table_version(spark, gold_path) + 1
    good, bad = split_null_keys(totals.withColumn("seq", F.lit(version).cast("long")), PO_GOLD_KEY)
    upsert_buckets(spark, gold_path, good, PO_GOLD_KEY, "seq")
    bad.write.mode("overwrite").parquet(f"{gold_path}/{REJECTS}/version={version}")
    if store_path:
        put(po_plan.gold_items(read_buckets(spark, gold_path, version)), f"{PO_GOLD_KEY}.S", store_path)
    if steps:
        record_step(spark, steps, STREAMS["purchase_order"][2], "upsert", version, rows_written(spark, gold_path, version))
    return version


def read_rejected_rows(spark: SparkSession, gold_path: str, version: int) -> DataFrame:
    """Rows that a gold run left out of the current table because they have no key (Q9)."""
    return spark.read.parquet(f"{gold_path}/{REJECTS}/version={version}")


def read_gold_items(current: DataFrame, kind: str) -> DataFrame:
    """Encoded items of a current gold table (P9), flattened to text columns."""
    if kind == "plain":
        return plain_plan.gold_items_flat(current)
    return po_plan.gold_items_flat(current)

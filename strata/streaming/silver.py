"""Incremental silver (Q6): bronze folder -> clean -> table, each row once.

The original silver job re-reads all of bronze and appends on every run, so
a second run duplicates every row (``mode="full"`` in the plans).  Here the
bronze folder is read as a stream with its own checkpoint and the
``availableNow`` trigger: each run takes only what was not seen before, then
stops.  Bronze of the file sink is a file stream, bronze of the callback sink the
stream of its commit list (``sources.batches``), so a replayed bronze batch
adds nothing.

The rows go through the parquet file sink straight into the table's
location.  The sink commits each micro-batch to the ``_spark_metadata`` log
in that folder, and table scans read through that log, so a batch replayed
after a driver failure (written, but not yet committed) is never seen twice.
Executor loss is handled below that by task retry and the output committer.
Values are cast to the table's column types on the way (DOUBLE to FLOAT,
DATE to STRING where the table says so), as a table insert would.

A table written this way must not also take batch inserts: files written
outside the log are invisible to readers.  ``append`` refuses such tables, and
this module refuses a table that holds rows of batch inserts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.parse import narrowed
from strata.sources.batches import read_batches_stream
from strata.sinks.audit import run_audited
from strata.sinks.tables import table_location, written_by_stream
from strata.streaming.sinks import file_sink, run_to_end


def cast_to_table(df: DataFrame, table_schema: T.StructType) -> DataFrame:
    """Select the table's columns by name, cast to the table's types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema.fields])


def incremental_append(
    spark: SparkSession,
    bronze_path: str,
    bronze_schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    using: str = "parquet",
    overflow: str | None = None,
    steps: tuple[str, str] | None = None,
) -> None:
    """New bronze rows into the table.  With ``overflow``, rows with a value that the table's
    type cannot hold go to that folder instead, by a stream of its own over the same bronze.
    ``steps`` (folder, audit stream) appends one step record per micro-batch."""
    stream = transform(read_batches_stream(spark, bronze_path, bronze_schema))
    if using == "iceberg":
        # Iceberg commits each micro-batch atomically with the batch id.
        query = (
            stream.writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .toTable(table)
        )
        run_to_end(query)
        return
    target = spark.table(table)
    if not written_by_stream(spark, table) and not target.isEmpty():
        raise ValueError(f"table {table} holds rows of batch inserts; the stream's log would hide them from its readers")
    if overflow is None:
        out = cast_to_table(stream, target.schema)
    else:
        out, fits = narrowed(stream, target.schema)
        run_to_end(file_sink(stream.where(~fits), overflow, f"{checkpoint}-overflow", trigger="availableNow"))
    path, name = steps or (None, "")
    run_audited(spark, out, lambda df: file_sink(df, table_location(spark, table), checkpoint, trigger="availableNow"), path, name)
    # the session caches the table's file listing; new files need a refresh
    spark.catalog.refreshTable(table)

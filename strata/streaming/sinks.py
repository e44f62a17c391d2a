"""Streaming sinks and triggers.

* ``file_sink``: the parquet file sink (K2).  Output files are committed
  through the sink's ``_spark_metadata`` log, so a batch read of the folder
  sees each micro-batch exactly once, also after a restart.
* ``foreach_batch_sink`` with ``batch_folder_writer``: a micro-batch callback
  (K1) that writes each batch to ``<base>/batch_id=N`` (K3) and then lists its
  files in ``<base>/_commits/N.json``.  A batch that is committed is left alone
  when it is replayed; one that failed before its commit is written again, and
  readers, who go by the commit list (``sources.batches``), never see the first
  attempt.  The checkpoint and the base folder belong together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: the micro-batch interval of the original jobs.
DEFAULT_INTERVAL = "500 milliseconds"


def _with_trigger(writer, trigger: str | None):
    """``trigger=None`` or ``"availableNow"`` processes what is there and
    stops; any other text is a processing-time interval (T1)."""
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def file_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = DEFAULT_INTERVAL,
    query_name: str | None = None,
) -> StreamingQuery:
    """Append-mode parquet file sink with a checkpoint."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _with_trigger(writer, trigger).start()


def foreach_batch_sink(
    stream: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = DEFAULT_INTERVAL,
    query_name: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Micro-batch callback sink (K1, T5)."""
    writer = (
        stream.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
    )
    if query_name:
        writer = writer.queryName(query_name)
    return _with_trigger(writer, trigger).start()


def batch_folder_writer(
    base: str,
    audit_base: str | None = None,
    audit_stream: str | None = None,
    steps: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Handler writing each non-empty batch to ``<base>/batch_id=N`` (K3, F3),
    committed by the list of its files once all of it is written.

    With ``audit_base`` each written row also gets an audit record (K8),
    built from the folder just written (no second parse of the source) and
    stored in ``<audit_base>/batch_id=N``, idempotent the same way.  ``steps``
    is a folder to which one record per committed batch is appended.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        from strata.operators.aggregates import observed_count
        from strata.sources.batches import COMMITS
        from strata.storage import CommitLog, data_files

        spark = batch.sparkSession
        log = CommitLog(spark, f"{base}/{COMMITS}")
        if log.exists(batch_id):  # a replay
            return
        if batch.isEmpty():  # LIMIT 1 job, not a full count
            return
        folder = f"batch_id={batch_id}"
        target = f"{base}/{folder}"
        # the row count comes with the write (observe), not from a second job
        counted, obs = observed_count(batch, f"bronze_batch_{batch_id}")
        counted.write.mode("overwrite").parquet(target)
        if audit_base is not None:
            from strata.sinks.audit import audit_message, audit_records

            stream = audit_stream or "audit"
            written = spark.read.parquet(target)
            audit_records(written, stream).write.mode("overwrite").option("compression", "zstd").parquet(f"{audit_base}/batch_id={batch_id}")
            # one step record per batch; "_steps" is hidden from readers of the record folder
            step = f"batch {batch_id}: wrote {obs.get['rows']} rows to {target}"
            audit_message(spark, stream, step).write.mode("overwrite").parquet(
                f"{audit_base}/_steps/batch_id={batch_id}"
            )
        log.write(batch_id, {"batch": batch_id, "rows": obs.get["rows"], "folder": folder, "files": data_files(spark, target)})
        if steps is not None:
            from strata.sinks.audit import record_step

            record_step(spark, steps, audit_stream or "audit", "batch", batch_id, obs.get["rows"])

    return handle


def quarantine_writer(base: str) -> Callable[[DataFrame, int], None]:
    """Handler writing a checked batch (``functions.parse.parse_checked``) in one job:
    good rows and faulty ones to folders of their own, listed in one commit record.

    Read the good rows with ``sources.batches.read_batches(spark, base)`` and the faulty
    ones with ``read_quarantine``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        from strata.sources.batches import COMMITS
        from strata.storage import CommitLog, data_files, exists

        spark = batch.sparkSession
        log = CommitLog(spark, f"{base}/{COMMITS}")
        if log.exists(batch_id) or batch.isEmpty():
            return
        folder = f"batch_id={batch_id}"
        # One parse, one write: the rows part by the flag.
        flagged = batch.withColumn("faulty", batch["fault"].isNotNull())
        flagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("faulty").parquet(f"{base}/{folder}")
        record = {"batch": batch_id, "folder": folder, "files": [], "faulty": []}
        for name, flag in (("files", "false"), ("faulty", "true")):
            part = f"faulty={flag}"
            if exists(spark, f"{base}/{folder}/{part}"):
                record[name] = [{**f, "name": f"{part}/{f['name']}"} for f in data_files(spark, f"{base}/{folder}/{part}")]
        log.write(batch_id, record)

    return handle


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query to finish; re-raise its error."""
    if timeout_s is None:
        query.awaitTermination()
    else:
        finished = query.awaitTermination(timeout_s)
        if not finished:
            query.stop()
            raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))

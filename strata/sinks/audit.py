"""Audit records and previews (K8, K9).

The original jobs send one log call per row from the driver.  Here an audit
record is a row ``(timestamp ms, stream, message)`` built by Spark on the
executors, with ``to_json`` (which handles dates and nested rows), and
appended to an audit table like any other data.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

# Audit stream names of the six jobs.
STREAMS = {
    "plain": ("bronze-job-stream", "silver-job-stream", "gold-job-stream"),
    "purchase_order": ("bronze-job-po-stream", "silver-job-po-stream", "gold-job-po-stream"),
}


def audit_records(df: DataFrame, stream: str) -> DataFrame:
    """One audit record per row: the row as JSON text (K8)."""
    return df.select(
        F.unix_millis(F.current_timestamp()).alias("timestamp"),
        F.lit(stream).alias("stream"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("message"),
    )


def audit_message(spark, stream: str, message: str) -> DataFrame:
    """A single step message (session started, table created, ...)."""
    return spark.range(1).select(
        F.unix_millis(F.current_timestamp()).alias("timestamp"),
        F.lit(stream).alias("stream"),
        F.lit(message).alias("message"),
    )


STEP_SCHEMA = "timestamp long, stream string, step string, batch long, rows long"


def record_step(spark, path: str, stream: str, step: str, batch: int, rows: int) -> None:
    """Append one step record: a job's batch and the rows it wrote."""
    import time

    row = [(int(time.time() * 1000), stream, step, batch, rows)]
    spark.createDataFrame(row, STEP_SCHEMA).coalesce(1).write.mode("append").json(path)


class StepListener(StreamingQueryListener):
    """Appends a step record for every micro-batch that observed rows under ``metric``.

    The row counts are metrics of the running query (``DataFrame.observe``), so
    counting costs no job of its own.
    """

    def __init__(self, spark, path: str, stream: str, metric: str):
        super().__init__()
        self.spark, self.path, self.stream, self.metric = spark, path, stream, metric
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.metric)
        if seen is not None and event.progress.numInputRows:
            record_step(self.spark, self.path, self.stream, "batch", event.progress.batchId, seen["rows"])

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def run_audited(spark, frame: DataFrame, start, path: str | None, stream: str) -> None:
    """Run ``start(frame)``, a streaming query, to its end; with ``path``, one step record per micro-batch."""
    from strata.streaming.sinks import run_to_end

    if path is None:
        run_to_end(start(frame))
        return
    metric = f"step_{uuid.uuid4().hex[:8]}"
    listener = StepListener(spark, path, stream, metric)
    spark.streams.addListener(listener)
    try:
        run_to_end(start(frame.observe(metric, F.count(F.lit(1)).alias("rows"))))
        listener.ended.wait(30)  # progress events come before the end of the query
    finally:
        spark.streams.removeListener(listener)


def describe(df: DataFrame) -> str:
    """Schema text for logs (what ``printSchema`` prints but returned)."""
    return df.schema.simpleString()


def sample_json(df: DataFrame, n: int = 20) -> DataFrame:
    """Bounded preview as JSON lines (K9)."""
    return df.limit(n).select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("row"))

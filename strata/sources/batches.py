"""Committed micro-batches: the commit list of the callback sink as a source (K3 read side).

``streaming.sinks.batch_folder_writer`` lists the files of each batch in a commit
record when the batch is complete.  Readers go by these lists and not by what the
folder holds, so files of an attempt that failed, or that a replay replaced, are
never seen, and a batch is seen once however often it is replayed.

* ``read_batches``: Spark's parquet scan over the listed files.
* ``read_batches_stream``: a streaming source whose offset is the batch number.  It
  is a Python data source: one input partition per file, read in Arrow batches
  and pruned to the columns of the declared schema.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from strata.storage import CommitLog, opened, read_record, record_numbers

COMMITS = "_commits"
FORMAT = "strata_batches"
# Rows of one Arrow batch handed to Spark.
ROWS = 8192


class BatchFile(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)


class BatchStream(DataSourceStreamReader):
    """Offset ``{"batch": N}``: every batch up to N has been read."""

    def __init__(self, path: str, schema: T.StructType):
        self.path = path
        self.schema = schema

    def _log(self):
        store, base = opened(self.path)
        return store, base, f"{base}/{COMMITS}"

    def initialOffset(self) -> dict:
        return {"batch": -1}

    def latestOffset(self) -> dict:
        store, _, log = self._log()
        return {"batch": max(record_numbers(store, log), default=-1)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        store, _, log = self._log()
        new = [n for n in record_numbers(store, log) if start["batch"] < n <= end["batch"]]
        return [BatchFile(f"{record['folder']}/{f['name']}") for record in (read_record(store, log, n) for n in new) for f in record["files"]]

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(self.schema)
        store, base = opened(self.path)
        with store.open_input_file(f"{base}/{partition.value}") as source:
            for batch in pq.ParquetFile(source).iter_batches(ROWS, columns=self.schema.names):
                yield from pa.Table.from_batches([batch]).select(self.schema.names).cast(wanted).to_batches()


class BatchSource(DataSource):
    """``spark.readStream.format("strata_batches").schema(...).load(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        raise ValueError("declare the schema of the batches")

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return BatchStream(self.options["path"], schema)


def has_commits(spark: SparkSession, path: str) -> bool:
    """Whether the folder is written by the callback sink."""
    return bool(CommitLog(spark, f"{path}/{COMMITS}").numbers())


def committed_files(spark: SparkSession, path: str, kind: str = "files") -> list[str]:
    """Files of all committed batches, in the order of the batches (metadata only)."""
    log = CommitLog(spark, f"{path}/{COMMITS}")
    records = [log.read(n) for n in log.numbers()]
    return [f"{path}/{r['folder']}/{f['name']}" for r in records for f in r[kind]]


def read_quarantine(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The faulty messages of all committed batches (``streaming.sinks.quarantine_writer``)."""
    files = committed_files(spark, path, "faulty")
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch scan of the committed files, or of the folder if no callback sink wrote it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    files = committed_files(spark, path)
    return reader.parquet(*files) if files else reader.parquet(path)


def read_batches_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stream of the committed batches, or of the folder's files if no callback sink wrote it."""
    if not has_commits(spark, path):
        return spark.readStream.schema(schema).parquet(path)
    spark.dataSource.register(BatchSource)
    return spark.readStream.format(FORMAT).schema(schema).load(path)

"""Keyed item store: the key-value put of the gold layer (K5, K6).

The original jobs put one item at a time from the driver.  Here the executors
write: a Python data source whose tasks each stage one file of items, and whose
driver side publishes all of them in one commit record (``storage.CommitLog``'s
layout, version by version).  A put is conditional: it names the version that it
was computed from, and a store that has moved on refuses it.  Staged files that
no commit lists are not part of the store, so a task that dies halfway, or a
job that is aborted, changes nothing.

An item carries the version of its put, so the latest put of a key wins by
version and not by a clock.  ``read_items`` gives one item per key; ``put``
splits off rows without a key, which no store can take, and keeps them beside the
store.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from strata.operators.keyed import latest_per_key, split_null_keys
from strata.storage import CommitLog, opened, record_numbers

FORMAT = "strata_items"
COMMITS = "_commits"
REJECTS = "rejects"
# One line of a staged file.
LINE = "key string, version long, item string"


class StoreMoved(RuntimeError):
    """The store is not at the version that the put was computed from."""


@dataclass
class Staged(WriterCommitMessage):
    name: str
    items: int


class ItemWriter(DataSourceArrowWriter):
    """Stages ``key, version, item`` rows and publishes them as version ``expected + 1``."""

    def __init__(self, path: str, expected: int, run: str):
        self.path = path
        self.expected = expected
        self.run = run

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"items/{self.run}/part-{task.partitionId():05d}-{task.taskAttemptId()}.json"
        store, base = opened(self.path)
        store.create_dir(f"{base}/items/{self.run}", recursive=True)
        items = 0
        with store.open_output_stream(f"{base}/{name}") as out:
            for batch in iterator:
                for row in batch.to_pylist():
                    out.write((json.dumps(row, ensure_ascii=False) + "\n").encode("utf-8"))
                    items += 1
        return Staged(name, items)

    def commit(self, messages: list) -> None:
        store, base = opened(self.path)
        log = f"{base}/{COMMITS}"
        store.create_dir(log, recursive=True)
        if max(record_numbers(store, log), default=-1) != self.expected:
            raise StoreMoved(f"the store is no longer at version {self.expected}")
        staged = [m for m in messages if m is not None and m.items]
        record = {"run": self.run, "files": [{"name": m.name, "items": m.items} for m in staged]}
        publish(store, f"{log}/.{self.run}", f"{log}/{self.expected + 1}.json", record)

    def abort(self, messages: list) -> None:
        """Staged files of the run are in no commit; remove what can be removed."""
        store, base = opened(self.path)
        for m in messages:
            if m is not None:
                try:
                    store.delete_file(f"{base}/{m.name}")
                except OSError:
                    pass


def publish(store, draft: str, target: str, record: dict) -> None:
    """Write a commit record whole and only if its number is free."""
    import os

    from pyarrow import fs

    with store.open_output_stream(draft) as out:
        out.write(json.dumps(record).encode("utf-8"))
    if isinstance(store, fs.LocalFileSystem):
        try:
            os.link(draft, target)  # fails if the target is there
        except FileExistsError as taken:
            raise StoreMoved(f"{target} is committed already") from taken
        finally:
            store.delete_file(draft)
        return
    if store.get_file_info(target).type != fs.FileType.NotFound:
        raise StoreMoved(f"{target} is committed already")
    store.move(draft, target)  # HDFS refuses a rename onto a file


class ItemStore(DataSource):
    """``df.write.format("strata_items").option("expected", N).mode("append").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return LINE

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a store takes puts (mode append) only")
        return ItemWriter(self.options["path"], int(self.options["expected"]), self.options["run"])


def store_version(spark: SparkSession, path: str) -> int:
    """Version of the store, -1 before its first put."""
    return CommitLog(spark, f"{path}/{COMMITS}").latest()


def put(items: DataFrame, key: str, path: str, expected: int | None = None) -> int:
    """Put encoded items (``functions.encode.encode_item``); returns the new version.

    ``key`` is the text of the key attribute, e.g. ``"id.N"``.  ``expected`` is the
    version that the items were computed from (now, if left out).  Items
    without a key go to ``<path>/rejects/version=N`` instead.
    """
    spark = items.sparkSession
    spark.dataSource.register(ItemStore)
    if expected is None:
        expected = store_version(spark, path)
    version = expected + 1
    keyed = items.select(F.col(key).alias("key"), F.lit(version).cast("long").alias("version"), F.to_json(F.struct("*")).alias("item"))
    good, bad = split_null_keys(keyed, "key")
    bad.select("item").write.mode("overwrite").parquet(f"{path}/{REJECTS}/version={version}")
    good.write.format(FORMAT).option("expected", expected).option("run", uuid.uuid4().hex).mode("append").save(path)
    return version


def read_items(spark: SparkSession, path: str, item_schema: str, upto: int | None = None) -> DataFrame:
    """``key, version, item``: one item per key, that of its latest put (up to version ``upto``)."""
    log = CommitLog(spark, f"{path}/{COMMITS}")
    records = [log.read(n) for n in log.numbers() if upto is None or n <= upto]
    files = [f"{path}/{f['name']}" for r in records for f in r["files"]]
    if not files:
        lines = spark.createDataFrame([], LINE)
    else:
        lines = spark.read.schema(LINE).json(files)
    return latest_per_key(lines, "key", "version", keep_seq=True).select("key", "version", F.from_json("item", item_schema).alias("item"))


def read_rejects(spark: SparkSession, path: str, item_schema: str, version: int) -> DataFrame:
    """Items that a put left out because they have no key."""
    rows = spark.read.schema("item string").parquet(f"{path}/{REJECTS}/version={version}")
    return rows.select(F.from_json("item", item_schema).alias("item"))


def item_schema(spec: dict[str, str]) -> str:
    """Schema of an item's JSON for a ``{attribute: "N" | "S"}`` spec."""
    return ", ".join(f"`{name}` struct<{kind}: string>" for name, kind in spec.items())

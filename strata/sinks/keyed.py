"""Keyed "current" tables and the per-partition keyed writer.

The gold layer holds one item per key, where a later put replaces an earlier
one.  Two ways to land it:

* ``upsert_current``: a table of versions under one folder.  Each upsert
  reads the newest version, unions the new rows, keeps the latest row per
  key (by a sequence column) and writes the result as the next version.
  A failed write leaves the previous version current (no ``_SUCCESS``), so a
  retried job is safe.  With Iceberg, ``MERGE INTO`` does the same in place.
* ``write_changes`` / ``read_merged`` / ``compact``: merge-on-read for
  frequent small upserts (streaming gold).  Each micro-batch writes only its
  changed rows; readers take the latest row per key over the last snapshot
  and the later changes; a compaction every few batches writes a new
  snapshot.  Per-batch cost is O(changed keys) instead of O(table).
* ``put_items``: hand the items to an external key-value store from the
  executors, one client per partition and batched puts.  Rows are reduced
  to one per key first, so puts commute and a retried task is harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.keyed import latest_per_key

# The key attribute of each gold store.
PLAIN_GOLD_KEY = "id"
PO_GOLD_KEY = "email"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Version numbers under ``path`` that finished writing (metadata only)."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v="):
            marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if fs.exists(marker):
                out.append(int(name[2:]))
    return sorted(out)


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The current table at ``path``, bucketed (``sinks.buckets``) or in whole versions."""
    from strata.sinks.buckets import read_buckets

    bucketed = read_buckets(spark, path)
    if bucketed is not None:
        return bucketed
    versions = committed_versions(spark, path)
    if not versions:
        return None
    return spark.read.parquet(f"{path}/v={versions[-1]}")


def upsert_current(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str | list[str],
    seq: str,
) -> str:
    """Merge ``updates`` into the current table at ``path``; returns the new
    version's folder.  One aggregate (partial + final) over current ∪ new."""
    versions = committed_versions(spark, path)
    merged = updates
    if versions:
        current = spark.read.parquet(f"{path}/v={versions[-1]}")
        merged = current.unionByName(updates.select(*current.columns))
    result = latest_per_key(merged, key, seq, keep_seq=True)
    target = f"{path}/v={(versions[-1] + 1) if versions else 1}"
    result.write.mode("overwrite").parquet(target)
    return target


def write_changes(spark: SparkSession, path: str, changes: DataFrame, batch_id: int) -> None:
    """Merge-on-read upsert, write side: land only the changed rows of one
    micro-batch under ``<path>/changes/batch_id=N`` (overwrite, so a replayed
    batch replaces its own folder).  Cost is O(changed keys), not O(table)."""
    changes.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")


def read_merged(
    spark: SparkSession, path: str, key: str | list[str], seq: str, upto: int | None = None
) -> DataFrame | None:
    """Merge-on-read upsert, read side: the newest committed snapshot
    ``v=N`` plus the change folders after batch ``N`` (up to ``upto``),
    reduced to the latest row per key.  The ``batch_id`` filters prune the
    other change folders."""
    versions = committed_versions(spark, path)
    if upto is not None:
        versions = [v for v in versions if v <= upto]
    fs, _ = _fs(spark, f"{path}/changes")
    parts = []
    if versions:
        parts.append(spark.read.parquet(f"{path}/v={versions[-1]}"))
    if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/changes")):
        changes = spark.read.parquet(f"{path}/changes")
        if versions:
            changes = changes.where(F.col("batch_id") > versions[-1])
        if upto is not None:
            changes = changes.where(F.col("batch_id") <= upto)
        parts.append(changes.drop("batch_id"))
    if not parts:
        return None
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part.select(*merged.columns))
    return latest_per_key(merged, key, seq, keep_seq=True)


def compact(spark: SparkSession, path: str, key: str | list[str], seq: str, batch_id: int) -> str | None:
    """Fold snapshot + changes up to ``batch_id`` into snapshot ``v=batch_id``.

    A snapshot that is already committed is left alone (a replayed batch
    does not rewrite what readers may be reading)."""
    target = f"{path}/v={batch_id}"
    if batch_id in committed_versions(spark, path):
        return target
    # changes of later batches stay out of this snapshot
    current = read_merged(spark, path, key, seq, upto=batch_id)
    if current is None:
        return None
    current.write.mode("overwrite").parquet(target)
    return target


def merge_into_sql(target: str, source_view: str, key: str, seq: str, columns: list[str]) -> str:
    """``MERGE INTO`` for table formats that support it (Iceberg)."""
    sets = ", ".join(f"t.{c} = s.{c}" for c in columns if c != key)
    cols = ", ".join(columns)
    vals = ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {target} t USING {source_view} s ON t.{key} = s.{key} "
        f"WHEN MATCHED AND s.{seq} >= t.{seq} THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})"
    )


def put_items(
    items: DataFrame,
    client_factory: Callable[[], object],
    table_name: str,
    batch_size: int = 25,
    key: str | None = None,
) -> None:
    """Write encoded items (``strata.functions.encode.encode_item``) with
    ``client.batch_put(table_name, [item, ...])`` from each partition.

    ``client_factory`` is called once per partition on the executor.  NULL
    attributes are left out of the item.  With ``key`` (the key attribute),
    an item without a key is not put: a store cannot take it.  Route such
    rows to a side output with ``split_null_keys`` before encoding.
    """
    cols = items.columns
    if key is not None:
        items = items.filter(F.col(key).isNotNull())
    payload = items.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias("item"))

    def write_partition(rows: Iterable) -> None:
        import json

        client = client_factory()
        batch = []
        for row in rows:
            batch.append(json.loads(row["item"]))
            if len(batch) >= batch_size:
                client.batch_put(table_name, batch)
                batch = []
        if batch:
            client.batch_put(table_name, batch)

    payload.foreachPartition(write_partition)

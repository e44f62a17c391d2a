"""Bucketed current table: an upsert rewrites only the buckets it touches (K5, K6).

Rows of a keyed current table lie in ``buckets`` hash buckets of their key.
A version of the table is a commit record that names, per bucket, the files
that hold it.  An upsert reads the buckets that its changed keys fall in, keeps the latest row
per key, writes these buckets as new files and commits a record in which every
other bucket keeps the files that it had.  Cost follows the
buckets touched, not the table; what it writes is invisible until the commit.

``retained`` versions stay readable; files that only older versions name are
removed after the commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.keyed import latest_per_key
from strata.storage import CommitLog, data_files, remove

COMMITS = "_commits"
BUCKETS = 64


def _bucket(key: list[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def table_version(spark: SparkSession, path: str) -> int:
    """Version of the table, -1 before its first upsert."""
    return CommitLog(spark, f"{path}/{COMMITS}").latest()


def rows_written(spark: SparkSession, path: str, version: int) -> int:
    """Rows that the upsert of this version wrote (all rows of the buckets it touched)."""
    return CommitLog(spark, f"{path}/{COMMITS}").read(version)["rows"]


def upsert_buckets(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str | list[str],
    seq: str,
    buckets: int = BUCKETS,
    retained: int = 2,
) -> int:
    """Merge ``updates`` into the table at ``path``; returns the new version.

    The bucket count is that of the table's first version.  Of two upserts from
    the same version the second one fails in its commit (``FileExistsError``)
    and may be run again.
    """
    keys = [key] if isinstance(key, str) else list(key)
    log = CommitLog(spark, f"{path}/{COMMITS}")
    version = log.latest()
    current = log.read(version) if version >= 0 else {"buckets": buckets, "files": {}}
    buckets = current["buckets"]
    dealt = updates.withColumn("_bucket", _bucket(keys, buckets))
    touched = sorted(r._bucket for r in dealt.select("_bucket").distinct().collect())  # at most ``buckets`` numbers
    old = [f"{path}/{f}" for b in touched for f in current["files"].get(str(b), [])]
    merged = dealt
    if old:
        merged = spark.read.schema(updates.schema).parquet(*old).withColumn("_bucket", _bucket(keys, buckets)).unionByName(dealt)
    result = latest_per_key(merged, [*keys, "_bucket"], seq, keep_seq=True).select(*updates.columns, "_bucket")
    folder = f"data/{uuid.uuid4().hex}"
    # Rebalanced by bucket: few files for a small bucket, several tasks for a large one.
    written = Observation(f"upsert_{uuid.uuid4().hex[:8]}")
    result.observe(written, F.count(F.lit(1)).alias("rows")).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{path}/{folder}")
    files = dict(current["files"])
    for b in touched:
        part = f"{folder}/_bucket={b}"
        files[str(b)] = [f"{part}/{f['name']}" for f in data_files(spark, f"{path}/{part}")]
    log.write(version + 1, {"buckets": buckets, "schema": updates.schema.json(), "files": files, "rows": written.get["rows"]})
    _expire(spark, path, log, version + 1, retained)
    return version + 1


def _expire(spark: SparkSession, path: str, log: CommitLog, version: int, retained: int) -> None:
    """Remove files that no retained version names."""
    if version < retained:
        return
    keep = {f for n in range(version - retained + 1, version + 1) for names in log.read(n)["files"].values() for f in names}
    for names in log.read(version - retained)["files"].values():
        for f in names:
            if f not in keep:
                remove(spark, f"{path}/{f}")


def read_buckets(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The table at its latest (or a retained) version; None before its first upsert."""
    from pyspark.sql import types as T

    log = CommitLog(spark, f"{path}/{COMMITS}")
    version = log.latest() if version is None else version
    if version < 0:
        return None
    record = log.read(version)
    schema = T.StructType.fromJson(json.loads(record["schema"]))
    files = [f"{path}/{f}" for names in record["files"].values() for f in names]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)

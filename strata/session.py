"""Spark session construction and the shared work folder.

All jobs take a ``SparkSession`` from the caller.  ``build_session`` is only a
convenience for scripts and tests; on a cluster the session comes from the
launcher and its configuration wins.

Work folders (stream checkpoints, bronze directories, table versions) live
under the shared folder named by ``spark.checkpoint.dir``.  It is read from
the session and only filled in with a local folder when unset, which is the
test / laptop case.
"""

from __future__ import annotations

import functools
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins and aggregates from
# runtime sizes: it coalesces small shuffle partitions, splits skewed join
# partitions, and turns a sort-merge join into a broadcast join only when the
# measured shuffle output of one side is under the broadcast threshold (a
# size-checked broadcast).  Nothing in this library forces a broadcast of a
# table that grows with the data.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Bytes of one scan task in the layer jobs.  Their files hold JSON text, or rows that become
# such text, at a tenth of its size: 128 MB of them are ten seconds of parsing, so a scan of
# 1 GB would leave cores idle behind its last few tasks.
SPLIT_KEY = "spark.sql.files.maxPartitionBytes"
SPLIT_BYTES = 32 * 1024 * 1024
_SPLITS: dict[str, int] = {}
_SPLITS_LOCK = threading.Lock()


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the scale settings applied.

    The master and every setting that the launcher gave stay as they are; the
    scale settings fill in what it left out.  ``master`` and ``extra_conf``
    are for scripts and tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    active = SparkSession.getActiveSession()
    given = dict(active.conf.getAll) if active else dict(SparkConf().getAll())
    conf = {k: v for k, v in {**SCALE_CONF, "spark.ui.enabled": "false"}.items() if k not in given}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_scale_conf(spark: SparkSession) -> None:
    """Fill in the scale settings that an existing session was not given."""
    given = spark.conf.getAll
    for key, value in SCALE_CONF.items():
        if key not in given:
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written work tables.

    Read from ``spark.checkpoint.dir`` (session conf, then SparkContext
    conf).  If unset, a local folder is created and registered on a local
    master; on any other master this raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    context_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not root and context_dir.isDefined():
        root = context_dir.get()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not context_dir.isDefined():
        # DataFrame.checkpoint() writes below this folder.
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_root(spark)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def fine_splits(spark: SparkSession) -> Iterator[None]:
    """Scans planned and streams started inside read ``SPLIT_BYTES`` per task, unless the
    session was given a size.  May be nested and entered by several threads: the first one in
    sets the size, the last one out takes it back."""
    app = spark.sparkContext.applicationId
    with _SPLITS_LOCK:
        if not _SPLITS.get(app) and SPLIT_KEY in spark.conf.getAll:
            given = True
        else:
            given = False
            _SPLITS[app] = _SPLITS.get(app, 0) + 1
            spark.conf.set(SPLIT_KEY, str(SPLIT_BYTES))
    try:
        yield
    finally:
        if not given:
            with _SPLITS_LOCK:
                _SPLITS[app] -= 1
                if not _SPLITS[app]:
                    spark.conf.unset(SPLIT_KEY)


def with_fine_splits(job: Callable) -> Callable:
    """``job(spark, ...)`` run inside ``fine_splits``."""

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **kwargs):
        with fine_splits(spark):
            return job(spark, *args, **kwargs)

    return run

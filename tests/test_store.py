"""Commit lists, the key-value store, the bucketed table, replays."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from strata.functions.encode import flatten_item
from strata.plans import jobs
from strata.plans import plain
from strata.sinks import store
from strata.sinks.buckets import read_buckets, table_version, upsert_buckets
from strata.sources.batches import COMMITS, committed_files, read_batches, read_batches_stream
from strata.sources.topic import Topic, message_frame, produce
from strata.storage import CommitLog
from strata.streaming.sinks import batch_folder_writer, run_to_end

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PAIRS = "id int, name string"


def _streamed(spark, base, out, ckpt):
    """Everything that a stream over the committed batches has brought so far."""
    stream = read_batches_stream(spark, base, spark.createDataFrame([], PAIRS).schema)
    run_to_end(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    return sorted(tuple(r) for r in spark.read.schema(PAIRS).parquet(out).select("id", "name").collect())


def test_commit_log_takes_each_number_once(spark, tmp_dir):
    log = CommitLog(spark, f"{tmp_dir}/log")
    assert log.numbers() == [] and log.latest() == -1
    log.write(3, {"a": 1})
    with pytest.raises(FileExistsError):
        log.write(3, {"a": 2})
    log.write(11, {"b": "é"})
    assert log.numbers() == [3, 11] and log.read(3) == {"a": 1} and log.read(11) == {"b": "é"}


def test_replayed_batch_reaches_stream_readers_once(spark, tmp_dir):
    base = f"{tmp_dir}/bronze"
    handle = batch_folder_writer(base)
    rows = spark.createDataFrame([(1, "a"), (2, "b")], PAIRS)
    handle(rows, 0)
    assert _streamed(spark, base, f"{tmp_dir}/out", f"{tmp_dir}/ck") == [(1, "a"), (2, "b")]
    files = committed_files(spark, base)
    handle(rows, 0)  # replayed between two runs of the reader
    assert committed_files(spark, base) == files
    assert _streamed(spark, base, f"{tmp_dir}/out", f"{tmp_dir}/ck") == [(1, "a"), (2, "b")]
    handle(spark.createDataFrame([(3, None)], PAIRS), 1)
    assert _streamed(spark, base, f"{tmp_dir}/out", f"{tmp_dir}/ck") == [(1, "a"), (2, "b"), (3, None)]
    assert read_batches(spark, base).count() == 3


def test_a_failed_attempt_is_never_read(spark, tmp_dir):
    base = f"{tmp_dir}/bronze"
    handle = batch_folder_writer(base)
    handle(spark.createDataFrame([(1, "a")], PAIRS), 0)
    # written, but the job died before the commit; files of other attempts lie around
    spark.createDataFrame([(9, "half")], PAIRS).write.parquet(f"{base}/batch_id=1")
    spark.createDataFrame([(8, "stray")], PAIRS).write.mode("append").parquet(f"{base}/batch_id=0")
    assert _streamed(spark, base, f"{tmp_dir}/out", f"{tmp_dir}/ck") == [(1, "a")]
    handle(spark.createDataFrame([(2, "b"), (3, "c")], PAIRS), 1)
    assert _streamed(spark, base, f"{tmp_dir}/out", f"{tmp_dir}/ck") == [(1, "a"), (2, "b"), (3, "c")]
    assert sorted(r.id for r in read_batches(spark, base).collect()) == [1, 2, 3]
    assert CommitLog(spark, f"{base}/{COMMITS}").read(1)["rows"] == 2


def test_nested_bronze_columns_through_the_stream(spark, tmp_dir):
    from strata.plans.purchase_order import bronze_schema

    base = f"{tmp_dir}/bronze"
    rows = [("n", "e@x", None, "7", [("s", "d", 6000, 1.5), None], 1.0, 0.1, 1.1, None), (None, None, None, None, None, None, None, None, None)]
    batch_folder_writer(base)(spark.createDataFrame(rows, bronze_schema()), 0)
    stream = read_batches_stream(spark, base, bronze_schema())
    out = f"{tmp_dir}/out"
    run_to_end(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    got = spark.read.schema(bronze_schema()).parquet(out)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, read_batches(spark, base, bronze_schema()).collect()))


ITEMS = plain.GOLD_ITEM


def _items(spark, rows):
    return plain.gold_items(spark.createDataFrame(rows, "id int, name string, amount int"))


def _back(spark, path, upto=None):
    got = store.read_items(spark, path, store.item_schema(ITEMS), upto)
    return {r.id_N: (r.name_S, r.amount_N) for r in flatten_item(got.select("item.*"), ITEMS).collect()}


def test_put_and_read_back(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    assert _back(spark, path) == {}
    assert store.put(_items(spark, [(1, "a", 5), (2, "é\n\"", None), (None, "lost", 3)]).repartition(3), "id.N", path) == 0
    assert _back(spark, path) == {"1": ("a", "5"), "2": ("é\n\"", None)}
    rejected = store.read_rejects(spark, path, store.item_schema(ITEMS), 0).collect()
    assert [r.item.name.S for r in rejected] == ["lost"]
    assert store.put(_items(spark, [(1, "later", 6)]), "id.N", path) == 1
    assert _back(spark, path) == {"1": ("later", "6"), "2": ("é\n\"", None)}
    assert _back(spark, path, upto=0)["1"] == ("a", "5")
    assert store.put(_items(spark, []), "id.N", path) == 2 and len(_back(spark, path)) == 2


def test_put_is_conditional_on_the_version(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    store.put(_items(spark, [(1, "a", 5)]), "id.N", path)
    store.put(_items(spark, [(1, "b", 6)]), "id.N", path, expected=0)
    with pytest.raises(Exception, match="no longer at version"):
        store.put(_items(spark, [(1, "stale", 7)]), "id.N", path, expected=0)
    assert _back(spark, path) == {"1": ("b", "6")} and store.store_version(spark, path) == 1


def test_a_task_that_dies_halfway_changes_nothing(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    store.put(_items(spark, [(1, "a", 5)]), "id.N", path)
    rows = spark.range(4000).select(F.col("id").cast("int").alias("id"), F.lit("x").alias("name"), F.lit(1).alias("amount"))
    # one row of the last task cannot be made, the other tasks and the rows before it are staged
    broken = rows.withColumn("amount", F.when(F.col("id") == 3999, F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="killed"):
        store.put(plain.gold_items(broken.repartition(4)), "id.N", path)
    assert _back(spark, path) == {"1": ("a", "5")} and store.store_version(spark, path) == 0
    store.put(plain.gold_items(rows), "id.N", path)
    assert len(_back(spark, path)) == 4000


def test_one_key_rewrites_one_bucket(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    schema = "id int, name string, seq long"
    rows = [(i, f"n{i}", 1) for i in range(500)]
    assert read_buckets(spark, path) is None
    upsert_buckets(spark, path, spark.createDataFrame(rows, schema), "id", "seq", buckets=16)
    before = CommitLog(spark, f"{path}/{COMMITS}").read(0)["files"]
    upsert_buckets(spark, path, spark.createDataFrame([(7, "new", 2), (8, "old", 0)], schema).where("id = 7"), "id", "seq")
    after = CommitLog(spark, f"{path}/{COMMITS}").read(1)["files"]
    changed = [b for b in after if after[b] != before.get(b)]
    assert len(before) == 16 and len(changed) == 1 and len(after[changed[0]]) == 1
    got = {r.id: (r.name, r.seq) for r in read_buckets(spark, path).collect()}
    assert len(got) == 500 and got[7] == ("new", 2) and got[8] == ("n8", 1)
    upsert_buckets(spark, path, spark.createDataFrame([(7, "stale", 1), (900, "x", 1)], schema), "id", "seq")
    got = {r.id: (r.name, r.seq) for r in read_buckets(spark, path).collect()}
    assert len(got) == 501 and got[7] == ("new", 2) and table_version(spark, path) == 2
    # the version before stays readable, older files are removed with the versions that named them
    assert {r.id for r in read_buckets(spark, path, 1).collect()} == set(range(500))
    with pytest.raises(Exception):
        read_buckets(spark, path, 0).count()
    assert upsert_buckets(spark, path, spark.createDataFrame([], schema), "id", "seq") == 3 and read_buckets(spark, path).count() == 501


def test_concurrent_upsert_fails_in_its_commit(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    schema = "id int, name string, seq long"
    upsert_buckets(spark, path, spark.createDataFrame([(1, "a", 1)], schema), "id", "seq")
    log = CommitLog(spark, f"{path}/{COMMITS}")
    log.write(1, log.read(0))  # another writer was faster
    with pytest.raises(FileExistsError):
        log.write(1, log.read(0))
    assert [r.name for r in read_buckets(spark, path).collect()] == ["a"]


def test_gold_jobs_put_and_reject(spark, tmp_dir):
    db = "t_" + tmp_dir.rsplit("-", 1)[-1]
    rows = [(1, "a", 5, 1), (1, "b", 6, 2), (None, "lost", 7, 3), (None, "later", 8, 4), (2, "c", 9, 5)]
    spark.sql(f"CREATE DATABASE {db}")
    spark.createDataFrame(rows, "id int, name string, amount int, seq long").write.option("path", f"{tmp_dir}/s").saveAsTable(f"{db}.s")
    for _ in range(2):
        version = jobs.plain_gold(spark, f"{db}.s", f"{tmp_dir}/gold", f"{tmp_dir}/store")
    assert version == 1 and _back(spark, f"{tmp_dir}/store") == {"1": ("b", "6"), "2": ("c", "9")}
    assert [(r.name, r.amount) for r in jobs.read_rejected_rows(spark, f"{tmp_dir}/gold", version).collect()] == [("later", 8)]


def test_three_processes_share_folders_and_no_catalog(spark, tmp_dir):
    local = tmp_dir.removeprefix("file:")
    topic = Topic("plain-topic", path=f"{tmp_dir}/topic")
    df = spark.createDataFrame([(1, "Ines", 41, 0), (2, "Kofi", 99, 1), (3, "Wen", 240, 2), (1, "Ines", 7, 3)], "id int, name string, amount int, seq long")
    produce(message_frame(df, payload=["id", "name", "amount"], offset="seq"), topic)

    def run(*args):
        conf = " ".join(f"--conf {k}={v}" for k, v in {"spark.checkpoint.dir": f"{local}/ck", "spark.sql.warehouse.dir": f"{local}/wh-{args[0]}", "spark.master": "local[2]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}.items())
        env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": f"{conf} pyspark-shell"}
        subprocess.run([sys.executable, "-m", "strata", *args], env=env, cwd=local if os.path.isdir(local) else ROOT, check=True, timeout=180)

    run("plain_bronze", "--topic-path", topic.path, "--bronze", f"{local}/b", "--checkpoint", f"{local}/c1", "--trigger", "availableNow")
    run("plain_silver", "--bronze", f"{local}/b", "--table", "lake.plain_silver", "--checkpoint", f"{local}/c2", "--location", f"{local}/s")
    run("plain_gold", "--table", "lake.plain_silver", "--gold", f"{local}/g", "--location", f"{local}/s", "--store", f"{local}/k")
    got = {r.id: (r.name, r.amount) for r in read_buckets(spark, f"{local}/g").collect()}
    assert got == {1: ("Ines", 7), 2: ("Kofi", 99)}
    assert _back(spark, f"{local}/k") == {"1": ("Ines", "7"), "2": ("Kofi", "99")}


def test_store_lines_are_json(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    store.put(_items(spark, [(1, "a", 5)]), "id.N", path)
    log = CommitLog(spark, f"{path}/{store.COMMITS}")
    name = log.read(0)["files"][0]["name"]
    line = json.loads(spark.read.text(f"{path}/{name}").first()[0])
    assert line == {"key": "1", "version": 0, "item": '{"id":{"N":"1"},"name":{"S":"a"},"amount":{"N":"5"}}'}

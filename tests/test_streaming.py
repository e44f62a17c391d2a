"""Streams, triggers, replays and incremental tables."""

import time

import pytest
from pyspark.sql import functions as F

from strata.plans import jobs
from strata.plans import plain
from strata.plans import purchase_order as po
from strata.sinks.tables import append
from strata.sources.topic import Topic, message_frame, produce
from strata.streaming.bronze import plain_bronze_stream
from strata.streaming.sinks import batch_folder_writer, run_to_end

PLAIN_ROWS = [(1, "Ines", 41), (2, "Kofi", 99), (3, "Wen", 240), (1, "Ines", 7)]


def plain_topic(spark, base, rows, start=0):
    topic = Topic("plain-topic", path=f"{base}/topic")
    df = spark.createDataFrame(
        [(i, n, a, start + k) for k, (i, n, a) in enumerate(rows)], "id int, name string, amount int, seq long"
    )
    produce(message_frame(df, payload=["id", "name", "amount"], offset="seq"), topic)
    return topic


def test_file_sink_restart_reads_only_new_messages(spark, tmp_dir):
    topic = plain_topic(spark, tmp_dir, PLAIN_ROWS)
    data, ckpt = f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    jobs.plain_bronze(spark, topic, data, ckpt, "availableNow")
    jobs.plain_bronze(spark, topic, data, ckpt, "availableNow")  # nothing new: no rows added
    assert spark.read.parquet(data).count() == 4
    plain_topic(spark, tmp_dir, [(5, "Eve", 1)], start=4)
    jobs.plain_bronze(spark, topic, data, ckpt, "availableNow")
    got = spark.read.parquet(data)
    assert got.count() == 5
    assert sorted(got.columns) == ["amount", "id", "name", "seq"]


def test_processing_time_trigger(spark, tmp_dir):
    topic = plain_topic(spark, tmp_dir, PLAIN_ROWS)
    q = plain_bronze_stream(spark, topic, f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", "200 milliseconds")
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == 4


def test_batch_folder_replay_is_idempotent(spark, tmp_dir):
    handler = batch_folder_writer(f"{tmp_dir}/bronze", f"{tmp_dir}/audit", "bronze-job-po-stream")
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    handler(batch, 0)
    handler(batch, 0)  # the same micro-batch replayed after a failure
    handler(batch.limit(0), 1)  # an empty batch writes nothing
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == 2
    audit = spark.read.parquet(f"{tmp_dir}/audit")
    assert audit.count() == 2
    assert {r.stream for r in audit.collect()} == {"bronze-job-po-stream"}
    steps = [r.message for r in spark.read.parquet(f"{tmp_dir}/audit/_steps").collect()]
    assert len(steps) == 1 and steps[0].startswith("batch 0: wrote 2 rows")


def test_po_bronze_stream_with_audit(spark, tmp_dir):
    import json

    from tests_data import PO_DOCS

    topic = Topic("purchase-order", path=f"{tmp_dir}/topic")
    rows = [(bytearray(json.dumps(d).encode()), None, i) for i, d in enumerate(PO_DOCS)]
    produce(spark.createDataFrame(rows, "value binary, key binary, offset long").select("key", "value", "offset"), topic)
    jobs.po_bronze(spark, topic, f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", "availableNow", f"{tmp_dir}/audit")
    bronze = spark.read.parquet(f"{tmp_dir}/bronze")
    assert bronze.count() == 2
    audit = spark.read.parquet(f"{tmp_dir}/audit")
    msgs = [r.message for r in audit.collect()]
    # the audit message holds the date that made the original callback fail
    assert any('"payment_due_date":"2027-03-08"' in m for m in msgs)


def _silver_run(spark, tmp_dir, mode, table):
    jobs.plain_silver(
        spark, f"{tmp_dir}/bronze", table, mode, f"{tmp_dir}/silver_ckpt", location=f"{tmp_dir}/silver"
    )


def _db(tmp_dir):
    return "t_" + tmp_dir.rsplit("-", 1)[-1]


def test_incremental_silver_twice_appends_once(spark, tmp_dir):
    topic = plain_topic(spark, tmp_dir, PLAIN_ROWS)
    jobs.plain_bronze(spark, topic, f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", "availableNow")
    table = f"{_db(tmp_dir)}.plain_silver"
    _silver_run(spark, tmp_dir, "incremental", table)
    _silver_run(spark, tmp_dir, "incremental", table)
    assert spark.table(table).count() == 3
    # new bronze rows are picked up by the next run, old ones are not repeated
    plain_topic(spark, tmp_dir, [(7, "Gus", 2)], start=4)
    jobs.plain_bronze(spark, topic, f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", "availableNow")
    _silver_run(spark, tmp_dir, "incremental", table)
    assert spark.table(table).count() == 4
    # a stream-written table refuses batch inserts (they would be invisible)
    with pytest.raises(ValueError):
        append(spark.table(table), table)
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {_db(tmp_dir)}").collect()] == ["plain_silver"]


def test_full_silver_twice_duplicates_as_the_original(spark, tmp_dir):
    topic = plain_topic(spark, tmp_dir, PLAIN_ROWS)
    jobs.plain_bronze(spark, topic, f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", "availableNow")
    table = f"{_db(tmp_dir)}.plain_silver"
    _silver_run(spark, tmp_dir, "full", table)
    _silver_run(spark, tmp_dir, "full", table)
    assert spark.table(table).count() == 6
    # the log of a stream would hide these rows
    with pytest.raises(ValueError):
        _silver_run(spark, tmp_dir, "incremental", table)
    assert spark.table(table).count() == 6


def test_po_silver_float_money_and_string_date(spark, tmp_dir):
    import json

    from tests_data import PO_DOCS

    topic = Topic("purchase-order", path=f"{tmp_dir}/topic")
    big = dict(PO_DOCS[0], total=16499999.37, po_number="PO-BIG")
    rows = [(bytearray(json.dumps(d).encode()), None, i) for i, d in enumerate(PO_DOCS + [big])]
    produce(spark.createDataFrame(rows, "value binary, key binary, offset long").select("key", "value", "offset"), topic)
    jobs.po_bronze(spark, topic, f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", "availableNow")
    table = f"{_db(tmp_dir)}.po_silver"
    jobs.po_silver(spark, f"{tmp_dir}/bronze", table, "incremental", f"{tmp_dir}/sck", money="float",
                   location=f"{tmp_dir}/silver")
    t = spark.table(table)
    types = dict(t.dtypes)
    assert types["total"] == "float" and types["payment_due_date"] == "string"
    assert t.count() == 5
    big_total = t.filter(F.col("po_number") == "PO-BIG").select("total").first()[0]
    assert big_total == 16499999.0  # FLOAT keeps no cents at this size
    assert t.filter(F.col("po_number") == "A-71").select("payment_due_date").first()[0] == "2027-03-08"


def test_streaming_totals_update_mode(spark, tmp_dir):
    from strata.streaming.gold import stream_customer_totals

    import json

    from tests_data import PO_DOCS

    topic = Topic("purchase-order", path=f"{tmp_dir}/topic")
    rows = [(bytearray(json.dumps(d).encode()), None, i) for i, d in enumerate(PO_DOCS)]
    produce(spark.createDataFrame(rows, "value binary, key binary, offset long").select("key", "value", "offset"), topic)
    jobs.po_bronze(spark, topic, f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", "availableNow")
    out = f"{tmp_dir}/gold"
    stream_customer_totals(spark, f"{tmp_dir}/bronze", out, f"{tmp_dir}/gck")
    from strata.sinks.keyed import read_merged

    got = {r.email: (r.total_purchase_amount, r.average_purchase_amount)
           for r in read_merged(spark, out, "email", "seq").collect()}
    assert got == {"mira@okafor.test": (34.44, 17.22), "tomas@lind.test": (233.64, 233.64)}


def test_job_launcher_end_to_end(spark, tmp_dir):
    from strata.__main__ import main
    from strata.sinks.keyed import read_current

    topic = plain_topic(spark, tmp_dir, PLAIN_ROWS)
    table = f"{_db(tmp_dir)}.plain_silver"
    main(["plain_bronze", "--topic-path", topic.path, "--bronze", f"{tmp_dir}/b", "--checkpoint", f"{tmp_dir}/c1",
          "--trigger", "availableNow"])
    main(["plain_silver", "--bronze", f"{tmp_dir}/b", "--table", table, "--checkpoint", f"{tmp_dir}/c2",
          "--location", f"{tmp_dir}/s"])
    main(["plain_gold", "--table", table, "--gold", f"{tmp_dir}/g"])
    got = {r.id: (r.name, r.amount) for r in read_current(spark, f"{tmp_dir}/g").collect()}
    # id 1 twice: the later message (amount 7) wins; Wen (240) is cleaned out
    assert got == {1: ("Ines", 7), 2: ("Kofi", 99)}


def test_streaming_totals_across_runs_with_compaction(spark, tmp_dir):
    import json

    from strata.sinks.keyed import committed_versions, read_merged
    from strata.streaming.gold import stream_customer_totals
    from tests_data import PO_DOCS

    topic = Topic("purchase-order", path=f"{tmp_dir}/topic")

    def send(docs, first):
        rows = [(bytearray(json.dumps(d).encode()), None, first + i) for i, d in enumerate(docs)]
        produce(spark.createDataFrame(rows, "value binary, key binary, offset long").select("key", "value", "offset"),
                topic)
        jobs.po_bronze(spark, topic, f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt", "availableNow")
        stream_customer_totals(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/gold", f"{tmp_dir}/gck", compact_every=1)

    def current():
        return {r.email: (r.total_purchase_amount, r.average_purchase_amount)
                for r in read_merged(spark, f"{tmp_dir}/gold", "email", "seq").collect()}

    send(PO_DOCS[:1], 0)
    assert current() == {"mira@okafor.test": (34.44, 17.22)}
    send(PO_DOCS[1:] + PO_DOCS[:1], 10)  # Tomas' order, and Mira orders again
    assert current() == {"mira@okafor.test": (68.88, 17.22), "tomas@lind.test": (233.64, 233.64)}
    assert committed_versions(spark, f"{tmp_dir}/gold") == [0, 1]

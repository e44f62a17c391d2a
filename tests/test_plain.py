"""Plain events: parse, clean, latest per key, item encoding."""

import json

from pyspark.sql import functions as F

from strata.plans import plain
from strata.schemas import PLAIN
from strata.sources.topic import message_frame


def topic_of(spark, texts):
    rows = [(None if t is None else bytearray(t.encode()), i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "value binary, offset long")


def events_of(spark, rows):
    return spark.createDataFrame(rows, PLAIN)


SAMPLE = [(11, "Ines", 41), (12, "Kofi", 99), (13, "Wen", 240), (14, "Ada", 0)]


def test_sample_filter_keeps_three(spark):
    out = plain.silver(events_of(spark, SAMPLE))
    assert sorted(r.name for r in out.collect()) == ["Ada", "Ines", "Kofi"]
    assert out.columns == ["id", "name", "amount"]


def test_all_filtered_out_keeps_schema(spark):
    out = plain.silver(events_of(spark, [(1, "p", 101), (2, "q", 1000)]))
    assert out.count() == 0
    assert out.schema == PLAIN


def test_boundary_strict(spark):
    out = plain.silver(events_of(spark, [(1, "a", 99), (2, "b", 100), (3, "c", 101)]))
    assert [r.amount for r in out.collect()] == [99]


def test_negative_kept_null_dropped(spark):
    out = plain.silver(events_of(spark, [(1, "a", -5), (2, "b", None)]))
    assert [r.amount for r in out.collect()] == [-5]


def test_empty_input(spark):
    out = plain.silver(events_of(spark, []))
    assert out.count() == 0


def test_round_trip_through_topic(spark):
    df = spark.createDataFrame(
        [(1, "Ines", 41, 10), (2, "O'Brien-Smith", 2147483647, 11)], "id int, name string, amount int, seq long"
    )
    back = plain.bronze(plain.messages(df))
    assert sorted(back.collect()) == sorted(df.collect())


def test_malformed_wire_values(spark):
    texts = [
        "not json",
        '[{"id": 1}, {"id": 2}]',
        None,
        "",
        '{"name": "x"}',
        '{"id": 1, "name": "x", "amount": 2, "extra": true}',
        '{"id": "7", "name": "y", "amount": 3}',
        '{"id": 99999999999, "name": "z", "amount": 4}',
        '{"id": 5, "name": "w", "amount": 1.5}',
        '{"ID": 6, "name": "v", "amount": 5}',
        '{"id": 8, "name": 123, "amount": 6}',
    ]
    rows = plain.bronze(topic_of(spark, texts)).orderBy("seq").collect()
    got = [(r.id, r.name, r.amount) for r in rows]
    assert got == [
        (None, None, None),
        (None, None, None),
        (None, None, None),
        (None, None, None),
        (None, "x", None),
        (1, "x", 2),
        (None, "y", 3),
        (None, "z", 4),
        (5, "w", None),
        (None, "v", 5),
        (8, "123", 6),
    ]


def test_latest_per_key_by_sequence(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, 1), (1, "b", 6, 3), (1, "c", 7, 2), (2, "d", 8, 1)], "id int, name string, amount int, seq long"
    )
    out = {r.id: (r.name, r.amount) for r in plain.gold(df).collect()}
    assert out == {1: ("b", 6), 2: ("d", 8)}


def test_item_encoding(spark):
    df = spark.createDataFrame(
        [(1, "O'Brien-Smith", 0), (2, "Jo", 999999999), (3, "Max", 2147483647), (4, None, None)],
        "id int, name string, amount int",
    )
    items = plain.gold_items(df)
    encoded = {r.id.N: r for r in items.collect()}
    assert encoded["1"].name.S == "O'Brien-Smith"
    assert encoded["1"].amount.N == "0"
    assert encoded["2"].amount.N == "999999999"
    assert encoded["3"].amount.N == "2147483647"
    assert encoded["4"].name is None and encoded["4"].amount is None
    as_json = [json.loads(r.item) for r in items.select(F.to_json(F.struct("*")).alias("item")).collect()]
    assert {"id": {"N": "4"}} in as_json  # NULL attributes are left out, never "None"


def test_message_frame_payload_only(spark):
    df = spark.createDataFrame([(1, "a", 2, 99)], "id int, name string, amount int, seq long")
    msg = message_frame(df, payload=["id", "name", "amount"], offset="seq").collect()[0]
    assert json.loads(bytes(msg.value)) == {"id": 1, "name": "a", "amount": 2}
    assert msg.offset == 99


def test_mixed_feed_keeps_every_message(spark):
    df = spark.createDataFrame(
        [(1, "view", 50, 10), (2, "signup", 60, 11), (3, "error", 70, 12)], "id int, name string, amount int, seq long"
    )
    rows = plain.bronze(plain.mixed_messages(df)).orderBy("seq").collect()
    assert [(r.id, r.name, r.amount, r.seq) for r in rows] == [
        (1, "view", 50, 10),  # well formed
        (None, "signup", 60, 11),  # id sent as text: only id is NULL
        (None, None, None, 12),  # not JSON: a row of NULLs, kept
    ]
    # downstream: F1 drops the NULL amount, A7 keeps the NULL id as a group
    got = {r.id: (r.name, r.amount) for r in plain.gold(plain.silver(plain.bronze(plain.mixed_messages(df)))).collect()}
    assert got == {1: ("view", 50), None: ("signup", 60)}

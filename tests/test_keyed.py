"""Keyed current tables and the executor-side keyed writer."""

import glob
import json
import os
import uuid

from strata.operators.keyed import latest_per_key, split_null_keys
from strata.plans import plain
from strata.sinks.keyed import committed_versions, put_items, read_current, upsert_current


def test_latest_per_key_by_sequence(spark):
    df = spark.createDataFrame(
        [(1, "a", 10, 5), (1, "b", 20, 7), (2, "c", 30, 1), (1, "z", 99, 6)], "id int, name string, amount int, seq long"
    )
    got = {r.id: (r.name, r.amount) for r in latest_per_key(df, "id", "seq").collect()}
    assert got == {1: ("b", 20), 2: ("c", 30)}


def test_upsert_keeps_newest_and_versions(spark, tmp_dir):
    path = f"{tmp_dir}/gold"
    first = spark.createDataFrame([(1, "a", 10, 1), (2, "b", 20, 2)], "id int, name string, amount int, seq long")
    upsert_current(spark, path, first, "id", "seq")
    second = spark.createDataFrame([(2, "B", 21, 3), (3, "c", 30, 4), (1, "old", 0, 0)], "id int, name string, amount int, seq long")
    upsert_current(spark, path, second, "id", "seq")
    assert committed_versions(spark, path) == [1, 2]
    got = {r.id: (r.name, r.amount) for r in read_current(spark, path).collect()}
    assert got == {1: ("a", 10), 2: ("B", 21), 3: ("c", 30)}


def test_uncommitted_version_is_ignored(spark, tmp_dir):
    path = f"{tmp_dir}/gold"
    upsert_current(spark, path, spark.createDataFrame([(1, 1)], "id int, seq long"), "id", "seq")
    # a version folder without _SUCCESS (a write that died) is not current
    spark.createDataFrame([(9, 9)], "id int, seq long").write.parquet(f"{path}/v=2")
    os.remove(f"{path[len('file:'):] if path.startswith('file:') else path}/v=2/_SUCCESS")
    assert committed_versions(spark, path) == [1]
    assert [r.id for r in read_current(spark, path).collect()] == [1]


def test_item_encoding_edge_values(spark):
    df = spark.createDataFrame(
        [(1, "O'Brien-Smith", 0), (2, "x", 999999999), (3, "y", 2147483647), (4, None, None)],
        "id int, name string, amount int",
    )
    items = {r.id.N: r for r in plain.gold_items(df).collect()}
    assert items["1"].name.S == "O'Brien-Smith" and items["1"].amount.N == "0"
    assert items["2"].amount.N == "999999999"
    assert items["3"].amount.N == "2147483647"
    assert items["4"].name is None and items["4"].amount is None  # omitted, never "None"


def test_put_items_from_executors(spark, tmp_dir):
    folder = tmp_dir[len("file:"):] if tmp_dir.startswith("file:") else tmp_dir
    os.makedirs(folder, exist_ok=True)
    df = spark.createDataFrame([(i, f"n{i}", i * 10) for i in range(60)], "id int, name string, amount int")
    store_dir = folder

    # defined here so that it is pickled by value for the executors
    class FileStore:
        """Stand-in key-value store: each batch put appends JSON lines to a file."""

        def __init__(self, folder):
            self.folder = folder

        def batch_put(self, table, items):
            path = os.path.join(self.folder, f"{table}-{uuid.uuid4().hex}.jsonl")
            with open(path, "w") as fh:
                for item in items:
                    fh.write(json.dumps(item) + "\n")

    put_items(plain.gold_items(df.repartition(4)), lambda: FileStore(store_dir), "plain-gold", batch_size=25)
    items = []
    for f in glob.glob(os.path.join(folder, "plain-gold-*.jsonl")):
        items += [json.loads(line) for line in open(f)]
    assert len(items) == 60
    assert {"id": {"N": "7"}, "name": {"S": "n7"}, "amount": {"N": "70"}} in items


def test_null_keys_go_to_side_output(spark):
    df = spark.createDataFrame([("a@x", 1.0), (None, 2.0)], "email string, total double")
    ok, rejected = split_null_keys(df, "email")
    assert ok.count() == 1 and rejected.count() == 1


def test_put_items_skips_items_without_key(spark, tmp_dir):
    folder = tmp_dir[len("file:"):] if tmp_dir.startswith("file:") else tmp_dir
    os.makedirs(folder, exist_ok=True)
    df = spark.createDataFrame([(1, "a", 5), (None, "b", 6)], "id int, name string, amount int")

    class FileStore:
        def __init__(self, folder):
            self.folder = folder

        def batch_put(self, table, items):
            with open(os.path.join(self.folder, f"{table}-{uuid.uuid4().hex}.jsonl"), "w") as fh:
                for item in items:
                    fh.write(json.dumps(item) + "\n")

    put_items(plain.gold_items(df), lambda: FileStore(folder), "g", key="id")
    items = [json.loads(line) for f in glob.glob(os.path.join(folder, "g-*.jsonl")) for line in open(f)]
    assert items == [{"id": {"N": "1"}, "name": {"S": "a"}, "amount": {"N": "5"}}]


def test_merge_on_read_changes_and_compaction(spark, tmp_dir):
    from strata.sinks.keyed import compact, read_merged, write_changes

    path = f"{tmp_dir}/gold"
    schema = "email string, total double, seq long"

    def batch(rows, batch_id):
        write_changes(spark, path, spark.createDataFrame(rows, schema), batch_id)

    def current(upto=None):
        return {r.email: (r.total, r.seq) for r in read_merged(spark, path, "email", "seq", upto).collect()}

    batch([("a", 1.0, 0), ("b", 2.0, 0)], 0)
    batch([("a", 3.0, 1)], 1)
    assert current() == {"a": (3.0, 1), "b": (2.0, 0)}
    compact(spark, path, "email", "seq", 1)
    assert committed_versions(spark, path) == [1]
    batch([("b", 5.0, 2), ("c", 7.0, 2)], 2)
    assert current() == {"a": (3.0, 1), "b": (5.0, 2), "c": (7.0, 2)}
    # a replayed batch overwrites its own folder; the snapshot is not rewritten
    batch([("a", 3.0, 1)], 1)
    compact(spark, path, "email", "seq", 1)
    assert current() == {"a": (3.0, 1), "b": (5.0, 2), "c": (7.0, 2)}
    # a snapshot holds nothing after its batch
    assert current(upto=1) == {"a": (3.0, 1), "b": (2.0, 0)}


def _text(d):
    """Plain decimal text without trailing zeros, as a key-value store number."""
    t = format(d.normalize() if d != 0 else d, "f")
    t = t.rstrip("0").rstrip(".") if "." in t else t
    return "0" if t == "-0" else t  # a negative mean that rounds to zero is "0"


def test_number_text_exact_against_decimal(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal, localcontext

    from pyspark.sql import functions as F

    from strata.functions.money import mean_text, sum_text

    rnd = random.Random(7)
    rows = [(0, 1), (1, 3), (-1, 3), (5, 2), (-5, 2), (7455, 2), (10, 3), (2, 3), (-2, 3), (1, 2_000_000)]
    for _ in range(300):
        big = 10 ** rnd.randint(0, 24)
        rows.append((rnd.randint(-big, big), rnd.randint(1, 10 ** rnd.randint(0, 9))))
    rows.append((10 ** 24, 0))
    df = spark.createDataFrame([(str(c), n) for c, n in rows], "c string, n long").select(
        (F.col("c").cast("decimal(28,0)") * F.lit("0.000000001").cast("decimal(9,9)")).cast("decimal(38,9)").alias("a"), "n", "c"
    )
    for r in df.select("c", "n", sum_text(F.col("a")).alias("t"), mean_text("a", "n").alias("m")).collect():
        c, n = int(r.c), r.n
        with localcontext() as ctx:
            ctx.prec = 80  # exact quotient, then half up (away from zero) to 18 places
            assert r.t == _text(Decimal(c).scaleb(-9)), (c, r.t)
            if n == 0:
                assert r.m is None
                continue
            exp = (Decimal(c).scaleb(-9) / Decimal(n)).quantize(Decimal(1).scaleb(-18), rounding=ROUND_HALF_UP)
            assert r.m == _text(exp), (c, n, r.m, _text(exp))

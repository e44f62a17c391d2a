"""Document assembly from the order tables (S12, A6): chunked and whole."""

from pyspark.sql import functions as F

from strata.plans import purchase_order as po
from strata.sources.documents import items_amount, items_weight

SMALL = "/root/testdata/sf0.001"


def _lines(docs):
    from strata.operators.transform import explode_lines

    flat = docs.select(
        F.col("contact_info.name").alias("name"),
        F.col("contact_info.email").alias("email"),
        F.col("contact_info.phone").alias("phone"),
        F.col("po_number").cast("string").alias("po_number"),
        "items", "subtotal", "taxes", "total", "payment_due_date",
    )
    return explode_lines(flat)


def test_chunked_documents_give_the_same_lines(spark):
    whole = po.documents(spark, SMALL)
    chunked = po.documents(spark, SMALL, max_items=2)
    # chunking splits big orders into several documents ...
    assert chunked.count() > whole.count()
    # chunks are hash buckets of about max_items lines: smaller than whole orders
    biggest = lambda d: d.agg(F.max(F.size("items"))).first()[0]
    assert biggest(chunked) < biggest(whole)
    # ... and every line, with its order header, is the same after the explode
    assert sorted(_lines(whole).collect()) == sorted(_lines(chunked).collect())


def test_header_totals_are_exact_and_consistent(spark):
    docs = po.documents(spark, SMALL)
    checked = docs.select(
        items_amount(F.col("items")).alias("amount"), "subtotal", "taxes", "total",
        items_weight(F.col("items")).alias("w"),
    ).collect()
    for r in checked:
        assert abs(round(float(r.amount), 2) - r.subtotal) < 1e-9
        assert abs(round(r.subtotal + r.taxes, 2) - r.total) < 1e-6
        assert r.w > 0


def test_items_sorted_by_line(spark):
    docs = po.documents(spark, SMALL).select("order_key", "items").limit(50).collect()
    assert all(len(d["items"]) >= 1 for d in docs)


def test_single_aggregate_and_join_in_plan(spark):
    plan = po.documents(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    # one assembly aggregate (partial + final), no Python in the plan
    assert plan.count("ObjectHashAggregate") == 2
    assert "Python" not in plan


def test_capitalize_first_letters(spark):
    from strata.functions.text import capitalize

    df = spark.createDataFrame([("alice",), ("o'brien smith",), (None,)], "w string")
    assert [r.c for r in df.select(capitalize(F.col("w")).alias("c")).collect()] == ["Alice", "O'brien Smith", None]

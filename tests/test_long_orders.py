"""Orders of more lines than one document holds, against the same SQL as all orders."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from oracle import compare
from strata.plans import catalogue
from strata.plans import purchase_order as po
from strata.sources.documents import MAX_ITEMS

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long_orders(spark):
    """sf0.001 where one order gets 3000 more lines, and one 2100 equal ones."""
    from strata.session import work_dir

    path = work_dir(spark, "long-orders")
    os.makedirs(path)
    con = duckdb.connect()
    for t in ("customer", "orders", "part", "events"):
        con.execute(f"COPY (SELECT * FROM '{SMALL}/{t}.parquet') TO '{path}/{t}.parquet'")
    con.execute(f"CREATE VIEW l AS SELECT * FROM '{SMALL}/lineitem.parquet'")
    con.execute("CREATE TABLE ks AS SELECT DISTINCT l_orderkey AS k FROM l ORDER BY k LIMIT 2")
    con.execute(
        "COPY (SELECT * FROM l UNION ALL "
        "SELECT * REPLACE ((SELECT min(k) FROM ks) AS l_orderkey) FROM (FROM l ORDER BY ALL LIMIT 3000) UNION ALL "
        "SELECT x.* REPLACE ((SELECT max(k) FROM ks) AS l_orderkey) FROM (FROM l ORDER BY ALL LIMIT 1) x, range(2100)) "
        f"TO '{path}/lineitem.parquet'"
    )
    for t in ("customer", "orders", "part", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    return path, con


@pytest.mark.parametrize(
    "name",
    ["po_documents", "po_bronze", "po_bronze_stream", "po_bronze_mixed", "audit_counts", "po_lines", "po_customer_totals_order"],
)
def test_long_orders_match_oracle(spark, long_orders, name):
    path, con = long_orders
    ok, msg = compare(entry.queries()[name](spark, path), con, entry.oracle_sql()[name])
    assert ok, msg


def test_parts_are_bounded_also_for_equal_lines(spark, long_orders):
    docs = po.documents(spark, long_orders[0]).selectExpr("order_key", "part", "size(items) AS n").collect()
    assert max(d.n for d in docs) < 1.3 * MAX_ITEMS
    assert len({(d.order_key, d.part) for d in docs}) == len(docs) > len({d.order_key for d in docs})


def test_result_does_not_depend_on_part_size(spark):
    whole, parts = (catalogue._documents_summary(po.documents(spark, SMALL, max_items=n)) for n in (None, 2))
    assert sorted(whole.collect()) == sorted(parts.collect())


def test_every_sku_is_listed_in_line_order(spark, long_orders):
    path, con = long_orders
    got = {r.po_number: r.item_skus for r in entry.queries()["po_documents"](spark, path).collect()}
    skus = con.execute(
        "SELECT l_orderkey::VARCHAR, 'SKU' || l_partkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"
    ).fetchall()
    want = {}
    for key, sku in skus:
        want.setdefault(key, []).append(sku)
    assert got == {key: " ".join(want[key]) for key in got} and len(got) == len(want)
    assert max(len(x.split(" ")) for x in got.values()) > 3000

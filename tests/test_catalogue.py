"""Every registered query against its DuckDB oracle, and plan properties."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck
from strata.plans import catalogue

SMALL = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_an_oracle():
    # queries of the corpus operators that SQL cannot express are tested in tests/llm
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE)
    assert set(catalogue.QUERIES) <= set(QUERIES) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, msg
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no row-at-a-time or Arrow Python evaluation in any query plan
    assert "EvalPython" not in plan, plan


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["email", "total_purchase_amount", "average_purchase_amount"]
    assert df.count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plain_filter_reaches_parquet_scan(spark, tmp_dir):
    from strata.plans import plain

    spark.createDataFrame([(1, "a", 5, 1)], "id int, name string, amount int, seq long").write.parquet(tmp_dir)
    plan = _plan(plain.silver(spark.read.parquet(tmp_dir)))
    assert "PushedFilters: [IsNotNull(amount), LessThan(amount,100)]" in plan


def test_gold_has_one_shuffle_on_email(spark):
    from strata.plans import purchase_order as po
    from strata.plans.catalogue import _bronze_folder

    bronze = _bronze_folder(spark, SMALL, "po")
    plan = _plan(po.gold(po.silver(bronze, prefilter=True)))
    assert plan.count("Exchange hashpartitioning(email") == 1
    # the same totals without generating lines read only what they need
    plan = _plan(po.gold_from_bronze(bronze))
    assert plan.count("Exchange hashpartitioning(email") == 1
    assert "Generate" not in plan
    assert "ReadSchema: struct<email:string,items:array<struct<weight_quantity:int>>,total:double>" in plan


def test_bronze_parses_once(spark):
    from strata.plans.catalogue import po_bronze

    plan = po_bronze(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_gold_scan_reads_two_columns(spark, tmp_dir):
    from strata.plans import purchase_order as po

    rows = [("n", "e@x", "p", "1", "s", "d", 6000, 1.0, 1.0, 0.1, 1.1, "2025-01-01")]
    cols = "name string, email string, phone string, po_number string, sku string, description string, " \
           "weight_quantity int, price double, subtotal double, taxes double, total double, payment_due_date string"
    spark.createDataFrame(rows, cols).write.parquet(tmp_dir)
    plan = _plan(po.gold(spark.read.parquet(tmp_dir)))
    assert "ReadSchema: struct<email:string,total:double>" in plan

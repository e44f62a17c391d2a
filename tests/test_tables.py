"""Catalog DDL, table appends, audit helpers, session work folders."""

import pytest

from strata.plans import plain
from strata.schemas import PO_SILVER_COLUMNS, po_silver_columns
from strata.session import checkpoint_root, work_dir
from strata.sinks.audit import audit_message, audit_records, describe, sample_json
from strata.sinks.keyed import merge_into_sql
from strata.sinks.tables import append, create_database, create_table, iceberg_catalog_conf, show_tables


def _db(tmp_dir):
    return "d_" + tmp_dir.rsplit("-", 1)[-1]


@pytest.mark.parametrize("money,sql_type", [("float", "float"), ("double", "double"), ("decimal", "decimal(18,2)")])
def test_po_silver_ddl(spark, tmp_dir, money, sql_type):
    db = _db(tmp_dir)
    create_database(spark, db)
    create_database(spark, db)  # IF NOT EXISTS: a second call is a no-op
    name = f"{db}.po_silver_{money}"
    create_table(spark, name, po_silver_columns(money), location=f"{tmp_dir}/{money}")
    types = spark.table(name).dtypes
    assert [c for c, _ in types] == PO_SILVER_COLUMNS
    d = dict(types)
    assert d["total"] == d["price"] == sql_type
    assert d["weight_quantity"] == "int" and d["payment_due_date"] == "string"


def test_plain_table_append_by_name_and_listing(spark, tmp_dir):
    db = _db(tmp_dir)
    create_database(spark, db)
    name = f"{db}.plain_silver"
    create_table(spark, name, plain.silver_table_columns(), location=f"{tmp_dir}/plain")
    # columns in another order are matched by name
    df = spark.createDataFrame([(5, "a", 1, 9)], "seq long, name string, id int, amount int")
    append(df, name)
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "a", 9, 5)]
    assert [r.tableName for r in show_tables(spark, db).collect()] == ["plain_silver"]


def test_append_double_to_float_and_date_to_string(spark, tmp_dir):
    db = _db(tmp_dir)
    create_database(spark, db)
    name = f"{db}.t"
    create_table(spark, name, [("total", "FLOAT"), ("due", "STRING")], location=f"{tmp_dir}/t")
    append(spark.sql("SELECT 16499999.37D AS total, DATE'2025-12-31' AS due"), name)
    r = spark.table(name).first()
    assert r.total == 16499999.0 and r.due == "2025-12-31"


def test_audit_records_and_previews(spark):
    df = spark.sql("SELECT 1 AS id, DATE'2025-12-31' AS d, named_struct('a', 1) AS s")
    rec = audit_records(df, "silver-job-stream").first()
    assert rec.stream == "silver-job-stream" and rec.timestamp > 0
    assert rec.message == '{"id":1,"d":"2025-12-31","s":{"a":1}}'
    assert describe(df) == "struct<id:int,d:date,s:struct<a:int>>"
    assert sample_json(spark.range(100), 20).count() == 20
    assert audit_message(spark, "gold-job-stream", "started").first().message == "started"


def test_merge_and_catalog_text():
    sql = merge_into_sql("cat.db.gold", "updates", "id", "seq", ["id", "name", "amount", "seq"])
    assert sql.startswith("MERGE INTO cat.db.gold t USING updates s ON t.id = s.id")
    assert "WHEN MATCHED AND s.seq >= t.seq THEN UPDATE SET t.name = s.name" in sql
    conf = iceberg_catalog_conf("lake", "s3://bucket/warehouse")
    assert conf["spark.sql.catalog.lake"] == "org.apache.iceberg.spark.SparkCatalog"
    assert conf["spark.sql.catalog.lake.type"] == "hadoop"


def test_work_folders_under_the_session_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(root + "/strata/x-")


def test_ad_hoc_scan_count_and_preview(spark, tmp_dir):
    # A table read by name, counted, previewed with a bound
    from strata.operators.aggregates import count_rows
    from strata.sources.tables import preview, read_table

    db = _db(tmp_dir)
    create_database(spark, db)
    create_table(spark, f"{db}.t", [("id", "INT")], location=f"{tmp_dir}/t")
    spark.sql(f"INSERT INTO {db}.t SELECT CAST(id AS INT) FROM range(30)")
    df = read_table(spark, f"{db}.t")
    assert count_rows(df) == 30
    assert preview(df).count() == 20

"""Batch scans: parquet directories, catalog tables, catalog listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_source_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One of the given input tables, ``<data_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, full_name: str) -> DataFrame:
    """Table scan by qualified name (``catalog.db.table`` or ``db.table``)."""
    return spark.table(full_name)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """``SHOW TABLES IN <database>`` as a DataFrame."""
    return spark.sql(f"SHOW TABLES IN {database}")


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Bounded console preview (what ``show()`` prints), as a frame."""
    return df.limit(n)

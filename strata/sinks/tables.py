"""Catalog DDL and table appends.

Tables are qualified ``[catalog.]db.table`` names.  The format is a config
switch: ``parquet`` (built in, tested here) or ``iceberg`` (needs the
Iceberg runtime jar and a catalog bound in the session config, D6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.schemas import ddl


def create_database(spark: SparkSession, database: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (D1), always qualified by the caller."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def create_table(
    spark: SparkSession,
    name: str,
    columns: list[tuple[str, str]],
    using: str = "parquet",
    location: str | None = None,
) -> None:
    """``CREATE TABLE IF NOT EXISTS ... USING ... [LOCATION ...]``."""
    loc = f"\nLOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (\n    {ddl(columns)}\n)\nUSING {using}{loc}"
    )


def register_table(spark: SparkSession, name: str, location: str, using: str = "parquet") -> None:
    """Bind a name to a table that another session wrote at ``location``.

    The catalog of a session may be empty (no metastore is shared); the folder
    is the table.  Columns come from its files.
    """
    create_database(spark, name.rsplit(".", 1)[0])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {using} LOCATION '{location}'")


def show_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database."""
    return spark.sql(f"SHOW TABLES IN {database}")


def table_location(spark: SparkSession, name: str) -> str:
    """Storage folder of a table (catalog metadata, read on the driver)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    for r in rows:
        if r.col_name == "Location":
            return r.data_type
    raise ValueError(f"table {name} has no location")


def written_by_stream(spark: SparkSession, name: str) -> bool:
    """True when the table's folder holds a streaming file-sink log."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table_location(spark, name) + "/_spark_metadata")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(path)


def append(df: DataFrame, name: str, using: str = "parquet") -> None:
    """Append rows by column name (K4).

    Values are converted to the table's column types with ANSI store
    assignment (P8): DOUBLE to FLOAT, DATE to STRING; an out-of-range value
    fails the write instead of being stored wrong.  Iceberg tables take the
    v2 ``writeTo(...).append()``; a parquet table the v1 insert.
    """
    if using == "iceberg":
        df.writeTo(name).append()
        return
    spark = df.sparkSession
    if written_by_stream(spark, name):
        raise ValueError(
            f"table {name} is written by a stream (incremental mode); a batch insert would not be "
            "visible to its readers"
        )
    table_cols = spark.table(name).columns
    df.select(*table_cols).write.insertInto(name)


def iceberg_catalog_conf(catalog: str, warehouse: str) -> dict[str, str]:
    """Session config binding an Iceberg hadoop catalog."""
    return {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        f"spark.sql.catalog.{catalog}": "org.apache.iceberg.spark.SparkCatalog",
        f"spark.sql.catalog.{catalog}.type": "hadoop",
        f"spark.sql.catalog.{catalog}.warehouse": warehouse,
    }

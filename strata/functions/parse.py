"""Wire parsing: binary value to typed columns.

Parsing is ``from_json`` with a declared schema in the default (permissive)
mode, all on the JVM: a malformed message gives a row of NULLs, a bad field
gives that field NULL, extra fields are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def value_as_string(topic_frame: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``CAST(value AS STRING)`` (P1), keeping the named frame columns."""
    keep = keep or []
    return topic_frame.selectExpr("CAST(value AS STRING) AS value", *keep)


def parse_json(df: DataFrame, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """``from_json(value, schema) AS data``."""
    keep = keep or []
    return df.select(F.from_json(F.col("value"), schema).alias("data"), *keep)


def expand(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``data.*`` star expansion."""
    keep = keep or []
    return df.select("data.*", *keep)


def project_paths(df: DataFrame, paths: list[str], keep: list[str] | None = None) -> DataFrame:
    """Nested path projection, e.g. ``data.contact_info.email``.

    Each output column is named after the last path element.
    """
    keep = keep or []
    return df.select(*[F.col(p).alias(p.rsplit(".", 1)[-1]) for p in paths], *keep)


def parse_topic(
    topic_frame: DataFrame, schema: T.StructType, keep: list[str] | None = None
) -> DataFrame:
    """P1 -> P2 -> P3 in one projection chain (Catalyst keeps one parse)."""
    return expand(parse_json(value_as_string(topic_frame, keep), schema, keep), keep)


# Why a message is not in bronze as it was meant.
NOT_JSON, BAD_FIELD = "not JSON", "bad field"


def parse_checked(
    topic_frame: DataFrame, schema: T.StructType, keep: list[str] | None = None, required: list[str] | None = None
) -> DataFrame:
    """``data, value, fault`` (and ``keep``): the message parsed once, with the reason if
    it is not whole.

    ``from_json`` fills a corrupt-record field for a message that is not JSON or has a
    field of another type; ``required`` fields that are missing are a fault too.
    ``fault`` is NULL for a good message.
    """
    keep = keep or []
    corrupt = "_corrupt_record"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = value_as_string(topic_frame, keep).select(
        F.from_json("value", wide, {"columnNameOfCorruptRecord": corrupt}).alias("data"), "value", *keep
    )
    fault = F.when(
        F.col("value").isNull() | F.col(f"data.{corrupt}").isNotNull(),
        F.when(F.get_json_object("value", "$").isNull(), F.lit(NOT_JSON)).otherwise(F.lit(BAD_FIELD)),
    )
    for name in required or []:
        fault = fault.when(F.col(f"data.{name}").isNull(), F.lit(f"no {name}"))
    return parsed.select("data", "value", fault.alias("fault"), *keep)


def narrowed(df: DataFrame, table_schema: T.StructType) -> tuple[DataFrame, Column]:
    """(rows cast to the table's types, whether all values fit).

    A value fits if its target type can hold it: no finite number becomes NULL or
    infinite.  The condition is over the columns of ``df``.
    """
    fits = F.lit(True)
    for f in table_schema.fields:
        source = df.schema[f.name].dataType
        if isinstance(source, T.NumericType) and isinstance(f.dataType, T.NumericType) and source != f.dataType:
            value, after = F.col(f.name).cast("double"), F.col(f.name).try_cast(f.dataType).cast("double")
            finite = value.isNotNull() & (F.abs(value) < F.lit(float("inf")))
            fits = fits & (~F.coalesce(finite, F.lit(False)) | F.coalesce(F.abs(after) < F.lit(float("inf")), F.lit(False)))
    cast = df.where(fits).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema.fields])
    return cast, fits

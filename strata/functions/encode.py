"""Typed attribute encoding of a row for a key-value store.

A store item maps each attribute name to ``{"N": text}`` (number) or
``{"S": text}`` (string).  Encoding happens in Spark on the executors; a NULL
attribute value gives a NULL attribute (omitted by the writer), never the
text ``"None"``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def number_attr(c: Column, text: Column | None = None) -> Column:
    """``{"N": text}``; ``text`` defaults to ``CAST(c AS STRING)``."""
    text = c.cast("string") if text is None else text
    return F.when(c.isNotNull() & text.isNotNull(), F.struct(text.alias("N")))


def string_attr(c: Column) -> Column:
    return F.when(c.isNotNull(), F.struct(c.cast("string").alias("S")))


def encode_item(
    df: DataFrame, spec: dict[str, str], number_text: dict[str, Column] | None = None
) -> DataFrame:
    """One struct column per attribute.

    ``spec`` maps column name to ``"N"`` (number) or ``"S"`` (string).
    ``number_text`` optionally gives the exact text of a number attribute
    (see ``strata.functions.money``).
    """
    number_text = number_text or {}
    cols = []
    for name, kind in spec.items():
        if kind == "S":
            cols.append(string_attr(F.col(name)).alias(name))
        elif kind == "N":
            cols.append(number_attr(F.col(name), number_text.get(name)).alias(name))
        else:
            raise ValueError(f"unknown attribute kind {kind!r}")
    return df.select(*cols)


def flatten_item(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Item structs flattened to ``<attr>_<N|S>`` text columns (tabular view)."""
    out = []
    for name, kind in spec.items():
        tag = "S" if kind == "S" else "N"
        out.append(F.col(f"{name}.{tag}").alias(f"{name}_{tag}"))
    return df.select(*out)

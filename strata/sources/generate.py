"""Random producers as counter-based draws.

The original producers draw from a random generator, one event after the other.
Here a drawn value is a function of (seed, row, field): the first eight hex
digits of an MD5 over them, read as a number and mapped to an integer range, an
amount or a choice.  Any row can be made on any executor, a repeated task makes the
same rows, and the same digits come out of SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 7

# Ranges and words of the generated fields.
IDS = (1, 100)
AMOUNTS = (0, 200)
NAMES = ("Amara", "Bela", "Chidi", "Dunya", "Emre", "Farida", "Goran", "Hana")
ITEMS = (1, 5)
SKUS = (1000, 9999)
WEIGHTS = (0, 40_000)
PRICE_CENTS = (0, 7_500)
MEATS = ("Beef", "Chicken", "Fish")
GRADES = ("Prime", "Choice", "Standard")
LOTS = (1, 100)


def draw(field: str, *row: Column | str, seed: int = SEED) -> Column:
    """A number below 2**32 for this field of this row."""
    parts = [F.lit(str(seed)), *(F.col(r) if isinstance(r, str) else r for r in row), F.lit(field)]
    text = F.concat_ws(":", *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def integer(field: str, bounds: tuple[int, int], *row: Column | str, seed: int = SEED) -> Column:
    """A whole number between both bounds."""
    low, high = bounds
    return (F.lit(low) + F.pmod(draw(field, *row, seed=seed), F.lit(high - low + 1))).cast("int")


def choice(field: str, words: tuple[str, ...], *row: Column | str, seed: int = SEED) -> Column:
    """One of the words."""
    return F.element_at(F.array(*(F.lit(w) for w in words)), integer(field, (1, len(words)), *row, seed=seed))


def description(meat: Column, grade: Column, lot: Column) -> Column:
    """Item text (X3, X4): capitalised words and the lot number."""
    return F.format_string("%s %s %d", F.initcap(meat), F.initcap(grade), lot)


def plain_events(rows: DataFrame, row: str) -> DataFrame:
    """``id, name, amount, seq`` for every row, numbered by its column ``row``."""
    return rows.select(
        integer("id", IDS, row).alias("id"),
        choice("name", NAMES, row).alias("name"),
        integer("amount", AMOUNTS, row).alias("amount"),
        F.col(row).cast("long").alias("seq"),
    )


def order_items(rows: DataFrame, row: str) -> DataFrame:
    """One to five items for every row: ``order_key, line, sku, description, weight_quantity, price``."""
    line = F.explode(F.sequence(F.lit(1), integer("items", ITEMS, row))).alias("line")
    lines = rows.select(F.col(row).cast("long").alias("order_key"), line)
    at = ("order_key", "line")
    return lines.select(
        *at,
        F.concat(F.lit("SKU"), integer("sku", SKUS, *at).cast("string")).alias("sku"),
        description(choice("meat", MEATS, *at), choice("grade", GRADES, *at), integer("lot", LOTS, *at)).alias("description"),
        integer("weight", WEIGHTS, *at).alias("weight_quantity"),
        (integer("price", PRICE_CENTS, *at).cast("decimal(12,0)") / F.lit(100)).cast("decimal(12,2)").alias("price"),
    )

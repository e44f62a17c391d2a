"""String functions used to build and clean documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The domain and the single phone number the order generator
# puts on every contact.
EMAIL_DOMAIN = "@example.com"
CONTACT_PHONE = "123-456-7890"


def email_from_name(name: Column, separators: str = " ", domain: str = EMAIL_DOMAIN) -> Column:
    """Name parts joined by ``.``, lower-cased, plus the domain.

    ``separators`` is a regex character class body: every separator
    character becomes a dot, so ``"John Doe"`` gives ``john.doe@example.com``.
    """
    return F.concat(F.lower(F.concat_ws(".", F.split(name, f"[{separators}]"))), F.lit(domain))


def capitalize(word: Column) -> Column:
    """Upper-case first letter of each word."""
    return F.initcap(word)


def sku(code: Column) -> Column:
    """Stock keeping unit text, ``SKU<code>``."""
    return F.concat(F.lit("SKU"), code.cast("string"))


def due_date(order_date: Column, days: Column) -> Column:
    """Order date plus ``days`` (X8); the date part only."""
    return F.date_add(F.to_date(order_date), days.cast("int"))

"""Declared schemas of the two event shapes and their layer tables.

Schemas are fixed and explicit; nothing is inferred from JSON.  All fields
are nullable, as on the wire.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of the wire, bronze and silver shapes below.
# --- plain events -----------------------------------------------------------
# Wire and bronze shape: {"id": int, "name": str, "amount": int}
PLAIN = T.StructType(
    [
        T.StructField("id", T.IntegerType(), True),
        T.StructField("name", T.StringType(), True),
        T.StructField("amount", T.IntegerType(), True),
    ]
)

# --- purchase orders --------------------------------------------------------
CONTACT_INFO = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
    ]
)

ORDER_ITEM = T.StructType(
    [
        T.StructField("sku", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("weight_quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
    ]
)

# Wire shape of one purchase-order document.
PURCHASE_ORDER = T.StructType(
    [
        T.StructField("contact_info", CONTACT_INFO),
        T.StructField("po_number", T.StringType()),
        T.StructField("items", T.ArrayType(ORDER_ITEM)),
        T.StructField("subtotal", T.DoubleType()),
        T.StructField("taxes", T.DoubleType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("payment_due_date", T.DateType()),
    ]
)

# Bronze: contact_info lifted to the top level, items kept nested.
PO_BRONZE_COLUMNS = [
    "name",
    "email",
    "phone",
    "po_number",
    "items",
    "subtotal",
    "taxes",
    "total",
    "payment_due_date",
]

# Silver: one row per order line, twelve flat columns in this order.
PO_SILVER_COLUMNS = [
    "name",
    "email",
    "phone",
    "po_number",
    "sku",
    "description",
    "weight_quantity",
    "price",
    "subtotal",
    "taxes",
    "total",
    "payment_due_date",
]

MONEY_COLUMNS = ("price", "subtotal", "taxes", "total")

# Storage type of money columns in the silver table.  "float" is the type the
# original silver DDL declares (loses cents above about 131,072); "double" is
# the default here; "decimal" keeps cents exactly.
MONEY_TYPES = {"float": "FLOAT", "double": "DOUBLE", "decimal": "DECIMAL(18,2)"}


def po_silver_columns(money: str = "double") -> list[tuple[str, str]]:
    """Column list of the purchase-order silver table for a money type."""
    money_sql = MONEY_TYPES[money]
    types = {
        "weight_quantity": "INT",
        "payment_due_date": "STRING",
    }
    return [
        (name, money_sql if name in MONEY_COLUMNS else types.get(name, "STRING"))
        for name in PO_SILVER_COLUMNS
    ]


def ddl(columns: list[tuple[str, str]]) -> str:
    return ",\n    ".join(f"{name} {sql_type}" for name, sql_type in columns)


# Topic frame: what a Kafka source returns, reduced to what the jobs use.
TOPIC = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("offset", T.LongType(), True),
    ]
)

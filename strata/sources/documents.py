"""Wire events built from the given tables.

The original producers invent random events one at a time on a single
machine.  Here the events are derived, deterministically and in parallel,
from the input tables, so every downstream result can be checked against SQL:

* plain events from ``events``: ``id = user_id``, ``name = event_type``,
  ``amount = CAST(value AS INT)`` (truncation), sequence ``event_id``;
* purchase-order documents from ``orders``, ``customer``, ``lineitem`` and
  ``part``: one document per order, one item per line.

Document assembly is the only place where rows are collected into a group.
Group size is bounded: an order of ``n`` lines is ``ceil(n / max_items)``
documents, numbered by ``part`` from 0 (one document, for nearly all orders).
A line's part is a hash of its place in the input files, so each part has
about ``max_items`` lines, also when lines are equal.  Every part carries the
same order header (po_number, totals).  After the silver explode the line rows
are the same for any part size, and per-order results roll the parts up
(``rolled_up``).  Orders of several documents are found first and written, with
their sums, so the planner knows how few they are; the sum of any other order is
that of its one document.  Lines meet ``part`` once and are exchanged once, by
``(order_key, part)``, to a number of tasks that grows with the lines, so that
what a task sorts and groups fits its memory at every size.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.functions.money import line_amount, round2, taxes_of
from strata.functions.text import CONTACT_PHONE, due_date, email_from_name, sku
from strata.session import work_dir

# About so many items in one document (a message size bound, not a row cap:
# larger orders become several documents, no line is dropped).
MAX_ITEMS = 1000
# Lines of one task that puts documents together: some 40 MB in memory.
LINES_PER_TASK = 250_000


def plain_events(events: DataFrame) -> DataFrame:
    """Plain events ``(id, name, amount, seq)`` from the events table."""
    return events.select(
        F.col("user_id").cast("int").alias("id"),
        F.col("event_type").alias("name"),
        F.col("value").cast("int").alias("amount"),
        F.col("event_id").alias("seq"),
    )


def order_lines(lineitem: DataFrame, part: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per order line: its place in the document, what its item is made
    of, and the columns ``keep`` of ``lineitem``.

    The part join is left to the planner: broadcast when ``part`` is under
    the (size-checked) broadcast threshold, sort-merge join otherwise, with
    AQE splitting a skewed part key.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", *(keep or []))
    pt = part.select("p_partkey", "p_name", "p_retailprice")
    return li.join(pt, li.l_partkey == pt.p_partkey).select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp"),
        (F.col("l_quantity") * F.lit(1000)).cast("int").alias("w"),
        F.col("p_name").alias("description"),
        F.col("p_retailprice").alias("price"),
        *(keep or []),
    )


def _line() -> Column:
    """A line inside its document: its position, which orders the lines, and its item."""
    position = F.struct("line", F.col("part_key").alias("part"), "supp", "w")
    item = F.struct(
        sku(F.col("part_key")).alias("sku"),
        "description",
        F.col("w").alias("weight_quantity"),
        "price",
    )
    return F.struct(position.alias("position"), item.alias("item"))


def order_headers(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Order header: contact, po number, due date, keyed by ``order_key``.

    The customer join is left to the planner (broadcast only under the
    size-checked threshold, sort-merge join otherwise).
    """
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = customer.select("c_custkey", "c_name")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("order_key"),
        F.struct(
            F.col("c_name").alias("name"),
            email_from_name(F.col("c_name"), separators=" #").alias("email"),
            F.lit(CONTACT_PHONE).alias("phone"),
        ).alias("contact_info"),
        F.col("o_orderkey").alias("po_number"),
        due_date(F.col("o_orderdate"), F.pmod(F.col("o_orderkey"), F.lit(30)) + 1).alias("payment_due_date"),
        F.col("o_orderstatus").alias("order_status"),
    )


def order_totals(subtotal_d: Column) -> list[Column]:
    """``subtotal, taxes, total`` from the exact sum of line amounts: each
    rounded to cents in decimal arithmetic, then stored as DOUBLE."""
    subtotal = round2(subtotal_d)
    taxes = taxes_of(subtotal)
    return [
        subtotal.cast("double").alias("subtotal"),
        taxes.cast("double").alias("taxes"),
        round2(subtotal + taxes).cast("double").alias("total"),
    ]


def _written(df: DataFrame, name: str) -> DataFrame:
    """A work table in the shared folder, whose size the planner knows."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def long_orders(lineitem: DataFrame, part: DataFrame, max_items: int = MAX_ITEMS) -> tuple[DataFrame, int]:
    """``order_key, n_parts, subtotal_d`` of the orders of several documents, written,
    and the number of lines of all orders."""
    seen = Observation(f"lines_{uuid.uuid4().hex[:8]}")
    counts = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).observe(seen, F.sum("n").alias("lines"))
    several = _written(
        counts.where(F.col("n") > max_items).select(
            F.col("l_orderkey").alias("order_key"), F.ceil(F.col("n") / F.lit(max_items)).cast("long").alias("n_parts")
        ),
        "several-parts",
    )
    theirs = lineitem.join(several.withColumnRenamed("order_key", "l_orderkey"), "l_orderkey")
    sums = (
        order_lines(theirs, part, ["n_parts"])
        .groupBy("order_key", "n_parts")
        .agg(F.sum(line_amount(F.col("w"), F.col("price"))).alias("subtotal_d"))
    )
    return _written(sums, "long-orders"), seen.get["lines"] or 0


def numbered_lines(lineitem: DataFrame, several: DataFrame) -> DataFrame:
    """``lineitem`` with the number ``part`` of the document a line goes to.

    Only orders of several parts are in the joined list; the planner
    broadcasts it when it is written small, and else AQE may split the lines
    of a long order.  The hash is over the line's file and row, so it differs
    for equal lines and is the same when a task is run again.
    """
    n_parts = several.select(F.col("order_key").alias("l_orderkey"), "n_parts")
    row = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row")
    lines = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", row)
    part = F.coalesce(F.pmod(F.col("row"), F.col("n_parts")), F.lit(0).cast("long")).alias("part")
    return lines.join(n_parts, "l_orderkey", "left").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", part
    )


def purchase_order_documents(
    orders: DataFrame,
    customer: DataFrame,
    lineitem: DataFrame,
    part: DataFrame,
    max_items: int = MAX_ITEMS,
) -> DataFrame:
    """Purchase-order documents in the wire shape.

    Columns: ``contact_info, po_number, items, subtotal, taxes, total,
    payment_due_date`` plus ``order_key``, ``part``, ``n_parts`` (documents of
    the order), ``positions`` (the ordering keys of the items) and
    ``order_status``.  ``lineitem`` must be a scan of files.

    Part 0 of an order is always there; a part that no line hashed to has
    empty ``items``.
    """
    several, n_lines = long_orders(lineitem, part, max_items)
    tasks = max(int(lineitem.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_lines / LINES_PER_TASK))
    # A partial collect_list shrinks nothing (the lists carry every line), so
    # the lines are exchanged first and the lists are built once, after the
    # exchange, in parallel over its partitions.  A line's item is made before the
    # list, once: items and positions are then fields of the list, not lambdas over it.
    grouped = (
        order_lines(numbered_lines(lineitem, several), part, ["part"])
        .repartition(tasks, "order_key", "part")
        .groupBy("order_key", "part")
        .agg(
            F.sort_array(F.collect_list(_line())).alias("lines"),
            F.sum(line_amount(F.col("w"), F.col("price"))).alias("part_d"),
        )
    )
    n_parts = F.coalesce(F.col("n_parts"), F.lit(1).cast("long"))
    headers = (
        order_headers(orders, customer)
        .join(several, "order_key", "left")
        .withColumn("n_parts", n_parts)
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1)))
    )
    # The join keeps the partitioning of the lists.  An order without lines is no document.
    docs = headers.join(grouped, ["order_key", "part"], "left").where((F.col("n_parts") > 1) | F.col("lines").isNotNull())
    return docs.select(
        "contact_info",
        "po_number",
        F.coalesce(F.col("lines.item"), F.array()).alias("items"),
        *order_totals(F.coalesce(F.col("subtotal_d"), F.col("part_d"))),
        "payment_due_date",
        "order_key",
        "part",
        "n_parts",
        F.coalesce(F.col("lines.position"), F.array()).alias("positions"),
        "order_status",
    )


def rolled_up(parts: DataFrame, header: list[str], *sums: Column) -> DataFrame:
    """One row per order from documents that are its parts: the ``header``
    columns, which all parts share, and the aggregates ``sums``.

    A document without a ``po_number`` is no part of an order and stays a row
    of its own.
    """
    alone = F.when(F.col("po_number").isNull(), F.monotonically_increasing_id())
    return parts.withColumn("_alone", alone).groupBy(*header, "_alone").agg(*sums).drop("_alone")


def items_amount(items: Column) -> Column:
    """Σ weight × price over a document's items, exact (A6 array fold)."""
    zero = F.lit(0).cast("decimal(38,6)")
    return F.aggregate(
        items,
        zero,
        lambda acc, x: (acc + line_amount(x["weight_quantity"], x["price"])).cast("decimal(38,6)"),
    )


def items_weight(items: Column) -> Column:
    """Σ weight over a document's items (array fold)."""
    return F.aggregate(items, F.lit(0).cast("long"), lambda acc, x: acc + x["weight_quantity"])

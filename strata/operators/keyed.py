"""Latest row per key (A7): the put-replaces semantics of a keyed store.

A key-value put replaces the item with the same key, so after a stream of
puts the store holds, per key, the last row written.  "Last" is made
explicit with a sequence column (topic offset or event id) instead of an
undefined driver loop order.

Implemented as one aggregate: ``max(struct(seq, row))`` per key.  The
partial aggregate keeps one row per key and map task, so a key holding a
third of all rows is reduced before the shuffle.  Ties on ``seq`` are broken
by the remaining fields, so the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | list[str], seq: str, keep_seq: bool = False) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    values = [c for c in df.columns if c not in keys and c != seq]
    best = F.max(F.struct(F.col(seq).alias("_seq"), *[F.col(c) for c in values])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    cols = [F.col(k) for k in keys] + [F.col(f"_best.{c}").alias(c) for c in values]
    if keep_seq:
        cols.append(F.col("_best._seq").alias(seq))
    return out.select(*cols)


def split_null_keys(df: DataFrame, key: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """``(rows with a key, rejected rows whose key is NULL)``.

    A keyed store cannot take a NULL key; such rows go to a side output
    instead of being written under the text ``"None"``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    return df.filter(has_key), df.filter(~has_key)

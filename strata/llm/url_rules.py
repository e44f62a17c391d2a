"""URL allow / block rules as a sort-merge range join over reversed hosts.

A host is turned into a canonical key: its labels reversed, joined by dots,
closed by a dot (``a.example.net`` -> ``net.example.a.``).  "This host and all
its subdomains" is then one key interval, and such intervals are nested or
disjoint.  URLs are range-partitioned and sorted by (key, row id); each task
sweeps its sorted run once, keeping a stack of the rule hosts whose interval
holds the current key, and asks the stack for the longest rule whose path is a
prefix of the URL's path.  The row id in the range key splits a hot host over
many tasks.

Edge cases: a null URL or one without ``://`` has an empty host and path and
fits no rule; of rules of equal length the one with the longer host wins,
of rules with the same host and path ``block``; repeated URLs are judged one by one; an empty
table gives an empty result.  The sweep ships its rules with the task, so they
may have at most ``MAX_RULES`` entries; a longer list is a table, for which
``judge_urls_by_table`` joins the same intervals as keys: a host lies in the interval of
each of its own suffixes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import lower_ascii, shuffle_parts, table

MAX_RULES = 1_000_000

# The rules of the registered query: (action, host, path).
RULES: tuple[tuple[str, str, str], ...] = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


class Sweep:
    """The stack of rule hosts whose key interval holds the current key."""

    def __init__(self, rules: Sequence[tuple[str, str, str]]):
        if len(rules) > MAX_RULES:
            raise ValueError(f"{len(rules)} rules; the documented bound is {MAX_RULES}")
        by_key: dict[str, dict[str, tuple[int, str, str]]] = {}
        for action, host, path in rules:
            if not host or action not in ("allow", "block"):
                raise ValueError(f"bad rule: {(action, host, path)}")
            key = ".".join(reversed(host.split("."))) + "."
            paths = by_key.setdefault(key, {})
            if path not in paths or action == "block":
                paths[path] = (len(host) + len(path), host + path, action)
        self.keys = sorted(by_key)
        self.paths = [by_key[k] for k in self.keys]
        self.lengths = [sorted({len(p) for p in paths}, reverse=True) for paths in self.paths]
        self.next = 0
        self.stack: list[int] = []

    def move(self, key: str) -> None:
        """Advance to a key not smaller than the one before."""
        while self.next < len(self.keys) and self.keys[self.next] <= key:
            self._close(self.keys[self.next])
            self.stack.append(self.next)
            self.next += 1
        self._close(key)

    def _close(self, key: str) -> None:
        while self.stack and not key.startswith(self.keys[self.stack[-1]]):
            self.stack.pop()

    def best(self, path: str) -> tuple[int, str, str] | None:
        """The longest rule on the stack whose path starts the URL's path."""
        found = None
        for at in reversed(self.stack):
            for n in self.lengths[at]:
                rule = self.paths[at].get(path[:n]) if n <= len(path) else None
                if rule:
                    if found is None or rule[0] > found[0]:
                        found = rule
                    break
        return found


def judge_urls(
    urls: DataFrame,
    id_col: str,
    url_col: str,
    rules: Sequence[tuple[str, str, str]],
    default: str = "allow",
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict."""
    Sweep(rules)  # reject bad rules before any job
    rules = tuple(rules)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Sweep(rules)
        for batch in batches:
            names, verdicts = [], []
            for key, path in zip(batch.column("key").to_pylist(), batch.column("path").to_pylist(), strict=True):
                state.move(key)
                rule = state.best(path)
                names.append(rule[1] if rule else None)
                verdicts.append(rule[2] if rule else default)
            same = [batch.column(c) for c in ("row_id", "host", "path")]
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(names, pa.string()), pa.array(verdicts, pa.string())],
                names=["row_id", "host", "path", "rule", "verdict"],
            )

    host = host_of(F.col(url_col))
    keyed = urls.select(
        F.col(id_col).cast("long").alias("row_id"), host.alias("host"), path_of(F.col(url_col)).alias("path"), host_key(host).alias("key")
    )
    parts = shuffle_parts(urls.sparkSession)
    run = keyed.repartitionByRange(parts, "key", "row_id").sortWithinPartitions("key", "row_id")
    return run.mapInArrow(sweep, "row_id long, host string, path string, rule string, verdict string").withColumnRenamed(
        "row_id", id_col
    )


def judge_urls_by_table(urls: DataFrame, id_col: str, url_col: str, rules: DataFrame, default: str = "allow") -> DataFrame:
    """The same rows as ``judge_urls``, for any number of rules: a table (action, host, path).

    Every host meets the rules of its suffixes (as many as it has labels), and the best rule is
    kept by a partial aggregate, so a hot host is combined before it is shuffled again.
    """
    host = host_of(F.col(url_col))
    row = urls.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("row_id"), host.alias("host"), path_of(F.col(url_col)).alias("path"))
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    of_host = rules.select(F.col("host").alias("suffix"), F.col("path").alias("rule_path"), "action")
    size = F.length("suffix") + F.length("rule_path")
    rule = F.struct(size.alias("size"), F.length("suffix").alias("host_size"), F.col("action"), F.concat("suffix", "rule_path").alias("rule"))
    fits = F.col("suffix").isNotNull() & F.startswith(F.col("path"), F.col("rule_path"))
    met = row.select("*", F.explode(suffixes).alias("suffix")).join(of_host, "suffix", "left")
    best = met.groupBy("row", "row_id", "host", "path").agg(F.max(F.when(fits & F.col("action").isNotNull(), rule)).alias("best"))
    return best.select(
        F.col("row_id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.action", F.lit(default)).alias("verdict")
    )


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URL of ``pages`` against the four rules, default allow."""
    return judge_urls(table(spark, sf_dir, "pages"), "page_id", "url", RULES)


_HOST_SQL = r"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH_SQL = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

OP9_SQL = f"""
WITH rules(action, rhost, rpath) AS (
  VALUES {", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in RULES)}
), split AS (
  SELECT row_number() OVER () AS rn, page_id, {_HOST_SQL} AS host, {_PATH_SQL} AS path FROM pages
), fit AS (
  SELECT s.rn, r.action, r.rhost || r.rpath AS rule,
         row_number() OVER (PARTITION BY s.rn ORDER BY length(r.rhost || r.rpath) DESC, length(r.rhost) DESC, r.action DESC) AS k
  FROM split s JOIN rules r
    ON (s.host = r.rhost OR ends_with(s.host, '.' || r.rhost)) AND starts_with(s.path, r.rpath)
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM split s LEFT JOIN fit f ON s.rn = f.rn AND f.k = 1
"""

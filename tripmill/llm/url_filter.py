"""Allow and block rules for urls: a sort-merge range join on reversed hosts.

A host is turned round label by label, each label followed by a dot, so that a rule's host is a
prefix of exactly its own key and those of its subdomains: an interval of the sort order. Rules
and pages are sorted together over all partitions, equal hosts by page, and swept once with a stack
of the rules whose interval is open. Rules that opened in an earlier partition are found by an
equality join of the first key's own prefixes with the rules: at most one row for each partition and
label, whatever the number of rules or pages.

Of the rules that fit, the one with the longest text (host and path) wins; then the longer host;
of rules with the same host and path, block wins. Defined cases: a url that is null or has no
``://`` has an empty host and path; a page without a fitting rule gets ``default``; a rule with a
null part never fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tripmill.llm.common import ascii_lower, batch_of, checkpointed, released

DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Between the first ``://`` and the next of ``/ ? #``; from there to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


class _Open:
    """A host whose interval is open, with its path rules."""

    def __init__(self, key: str) -> None:
        self.key, self.rules, self.lengths = key, {}, []

    def add(self, host: str, path: str, action: str) -> None:
        if path not in self.rules or action == "block":
            self.rules[path] = (host, action)
        self.lengths = sorted({len(p) for p in self.rules}, reverse=True)

    def best(self, path: str):
        for n in self.lengths:
            found = self.rules.get(path[:n]) if n <= len(path) else None
            if found:
                return len(found[0]) + n, len(found[0]), found[0] + path[:n], found[1]
        return None


def judge_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
               default: str = DEFAULT) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    ``rules`` has ``host``, ``path`` and ``action``.
    """
    host, path = host_and_path(F.col(url))
    id_field = pages.schema[page_id].dataType.simpleString()
    seen = pages.select(F.col(page_id).alias("id"), host.alias("host"), path.alias("path"),
                        F.lit(None).cast("string").alias("action"))
    known = (rules.select(ascii_lower(F.col("host")).alias("host"), "path", "action").dropna()
             .distinct())
    both = (known.select(F.lit(None).cast(id_field).alias("id"), "host", "path", "action")
            .withColumn("page", F.lit(0))
            .unionByName(seen.withColumn("page", F.lit(1)))
            .withColumn("key", reversed_key(F.col("host"))))
    order = ["key", "page", "id", "path"]
    ranged = checkpointed(both.repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn("part", F.spark_partition_id())
                          .select("part", "key", "page", "id", "host", "path", "action"))

    labels = F.split(F.col("key"), r"\.", -1)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda n: F.concat(
        F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))
    heads = ranged.groupBy("part").agg(F.min("key").alias("key"))
    carried = (heads.select("part", F.explode(prefixes).alias("key"))
               .join(known.withColumn("key", reversed_key(F.col("host"))), "key")
               .select("part", "key", "host", "path", "action").collect())
    entering: dict[int, list[tuple]] = {}
    for r in sorted(carried, key=lambda r: len(r[1])):
        entering.setdefault(r[0], []).append(tuple(r[1:]))
    sent = pages.sparkSession.sparkContext.broadcast(entering)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Open] = []
        started = False

        def enter(key: str, host: str, path: str, action: str) -> None:
            if not stack or stack[-1].key != key:
                stack.append(_Open(key))
            stack[-1].add(host, path, action)

        for batch in batches:
            out: list[tuple] = []
            for part, key, page, i, host, path, action in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if not started:
                    started = True
                    for rule in sent.value.get(part, ()):
                        enter(*rule)
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if not page:
                    enter(key, host, path, action)
                    continue
                best = max(filter(None, (s.best(path) for s in stack)), default=None)
                out.append((i, host, path, best and best[2], best[3] if best else default))
            if out:
                ids, *texts = zip(*out)
                yield batch_of(id=pa.array(ids, batch.column(3).type),
                               **{n: pa.array(v, pa.string()) for n, v in zip(
                                   ("host", "path", "rule", "verdict"), texts)})

    return ranged.mapInArrow(
        released(sweep), f"id {id_field}, host string, path string, rule string, verdict string")

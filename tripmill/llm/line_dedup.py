"""Corpus-wide line de-duplication with two Bloom filters.

A key (a line without ASCII white space at its ends, A-Z in lower case) of at least
``MIN_CHARS`` code points that occurs in at least ``MIN_DOCS`` documents loses all its lines,
except in the largest document id that holds it.

1. Each task sends the distinct hashes of its lines, once each, to the filter shard of the hash.
   A shard puts a hash into its once-seen filter, and into its twice-seen filter when the first
   already has it or when the task saw it in two documents.
2. The twice-seen filters, whose size follows the repeated lines only, go to all tasks. Only
   lines they accept are suspects; only suspects are shuffled, as full keys, summed up by task.
3. Exact counts decide. Documents without suspects never move; the others meet their decisions
   by a join on the document id.

Beyond ``FILTER_BYTES`` the filters are not sent and every long line counts as a suspect, which
gives the same rows. Defined cases: null text counts as one empty line; every row is a document of
its own, also with a repeated id, and rows that share the largest id all keep their lines; rows
without an id never count as the largest while another exists.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tripmill.llm.bloom import (
    BY_SHARD, FILTER_BYTES, Repeated, by_shard, repeated, twice_seen)
from tripmill.llm.common import SPACES, batch_of, carried, fields, map_batches, released, staged

MIN_CHARS = 20
MIN_DOCS = 3
HELD_KEYS = 200_000


def line_keys(text: bytes | None, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """Lines of a text and their keys; None where the key is too short."""
    lines = (text or b"").split(b"\n")
    keys: list[bytes | None] = []
    for line in lines:
        key = line.strip(SPACES).lower()
        if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
            keys.append(None)
        else:
            keys.append(key)
    return lines, keys


def _long_keys(text: bytes | None, min_chars: int) -> list[bytes]:
    return list({k for k in line_keys(text, min_chars)[1] if k is not None})


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def seen_lines(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """Hashes of the lines of each task, by filter shard."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            return by_shard(np.fromiter(seen, np.uint64, len(seen)),
                            np.fromiter(seen.values(), bool, len(seen)))
        seen: dict[int, bool] = {}
        for batch in batches:
            for value in batch.column(0).to_pylist():
                for h in map(xxhash.xxh64_intdigest, _long_keys(value, min_chars)):
                    seen[h] = h in seen
            if len(seen) > HELD_KEYS:
                yield flush()
                seen.clear()
        if seen:
            yield flush()
    return docs.select(F.col(text).cast("binary")).mapInArrow(released(gather), BY_SHARD)


def _suspects(texts: list[bytes | None], min_chars: int, test: Repeated) -> list[list[bytes]]:
    """The distinct keys of each text that the filters accept."""
    keys = [_long_keys(t, min_chars) for t in texts]
    every = list({k for ks in keys for k in ks})
    chosen = {every[i] for i in np.flatnonzero(test(_hashes(every)))}
    return [[k for k in ks if k in chosen] for ks in keys]


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                carry: Sequence[str] = (), min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``id``, ``text`` without the lines dropped, ``n_lines``, ``n_dropped``, ``carried``."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("raw"),
                       carried(docs, carry).alias("carried"))
    filters = staged(twice_seen(seen_lines(docs, text, min_chars)), "line-filters")
    test, _ = repeated(filters, filter_bytes)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}

        def flush():
            return batch_of(key=pa.array(list(held), pa.binary()),
                            n=pa.array([v[0] for v in held.values()], pa.int64()),
                            last=pa.array([v[1] for v in held.values()], id_type))
        for batch in batches:
            id_type = batch.column(0).type
            ids = batch.column(0).to_pylist()
            for i, keys in zip(ids, _suspects(batch.column(1).to_pylist(), min_chars, test)):
                for k in keys:
                    v = held.setdefault(k, [0, None])
                    v[0] += 1
                    if i is not None and (v[1] is None or i > v[1]):
                        v[1] = i
            if len(held) > HELD_KEYS:
                yield flush()
                held.clear()
        if held:
            yield flush()

    id_kind = rows.schema["id"].dataType.simpleString()
    often = (rows.select("id", "raw").mapInArrow(released(counts), f"key binary, n bigint, last {id_kind}")
             .groupBy("key").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
             .where(F.col("n") >= min_docs).select("key", "last"))
    # Stored, so that the join below reads both sides anew and Spark can split a hot key.
    often = staged(often, "repeated-lines")

    def tag(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = _suspects(batch.column(1).to_pylist(), min_chars, test)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(found, pa.list_(pa.binary()))],
            [*batch.schema.names, "suspects"])

    def without_raw(batch: pa.RecordBatch) -> pa.RecordBatch:
        return tag(batch).select(["id", "suspects"])

    pairs = map_batches(rows.select("id", "raw"), without_raw,
                        f"id {id_kind}, suspects array<binary>")
    dropped = (pairs.select("id", F.explode("suspects").alias("key")).join(often, "key")
               .where(~F.col("id").eqNullSafe(F.col("last")))
               .groupBy("id").agg(F.collect_set("key").alias("gone"))
               .withColumnRenamed("id", "gone_id"))
    whole = map_batches(rows, tag, fields(rows, rows.columns, "suspects array<binary>"))
    clean = whole.where(F.size("suspects") == 0).select(
        "id", "raw", "carried", F.lit(None).cast("array<binary>").alias("gone"))
    held = (whole.where(F.size("suspects") > 0)
            .join(dropped, F.col("id").eqNullSafe(F.col("gone_id")), "left")
            .select("id", "raw", "carried", "gone"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_lines, n_dropped = [], [], []
        for raw, gone in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            lines, keys = line_keys(raw, min_chars)
            drop = set(gone or ())
            kept = [x for x, k in zip(lines, keys) if k is None or k not in drop]
            texts.append(b"\n".join(kept).decode())
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
        return batch_of(id=batch.column(0), text=pa.array(texts, pa.string()),
                        n_lines=pa.array(n_lines, pa.int64()),
                        n_dropped=pa.array(n_dropped, pa.int64()), carried=batch.column(2))

    out = fields(rows, ["id"], "text string, n_lines bigint, n_dropped bigint")
    return map_batches(clean.unionByName(held), cut, out.add(rows.schema["carried"]))

"""SimHash near-duplicates by multi-index hashing.

Fingerprints have 64 bits in two segments of 32. Two fingerprints that differ in at most three
bits differ in at most one bit in one of the segments. Each distinct fingerprint is entered under
both its segment values, and under the values made by setting one clear bit: of two values that
differ in one bit, just one has that bit clear, so each pair meets at least once. What meets under a
key is compared in full.

Equal fingerprints are one entry, so copies cost nothing. Where more than ``FULL_BUCKET`` distinct
fingerprints share a segment value, those keys are refined by the other segment's two quarters in
the same manner (of the three differing bits left, one quarter has at most one), which bounds a
bucket by the 16 bits that remain. Inside a bucket a search from one fingerprint to its neighbours
emits only the links that first reach each member, not all pairs.

Defined cases: null text and text without words have fingerprint zero and are linked like any other;
documents without an id are linked, but never name a component while another one can.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tripmill.llm.common import batch_of, carried, fields, map_batches, released, staged
from tripmill.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 3
FULL_BUCKET = 2_048
SMALL_RUN = 12
HASHES_AT_ONCE = 1 << 18
BLOCK = 256


def shingle_hashes(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of the word shingles, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
        n = len(words) - size + 1
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """A bit is set if it is set in over half the hashes. As a signed 64-bit number."""
    hashes = shingle_hashes(text, size)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        bits = np.unpackbits(hashes[at:at + HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, carry: Sequence[str] = (),
                 shingle: int = SHINGLE) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("raw"),
                       carried(docs, carry).alias("carried"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
        return batch_of(id=batch.column(0), fp=pa.array(found, pa.int64()),
                        carried=batch.column(2))
    return map_batches(rows, run, fields(rows, ["id"], "fp bigint").add(rows.schema["carried"]))


def _variants(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers, the values and those with one clear bit set, and which are unchanged."""
    rows, out, own = [np.arange(len(values))], [values], [np.ones(len(values), bool)]
    for i in range(bits):
        at = np.flatnonzero((values >> i) & 1 == 0)
        rows.append(at)
        out.append(values[at] | (1 << i))
        own.append(np.zeros(len(at), bool))
    return np.concatenate(rows), np.concatenate(out), np.concatenate(own)


def _segment(fp: np.ndarray, number: int) -> np.ndarray:
    return (fp >> (32 * number)) & 0xFFFFFFFF


def _entries(distinct: DataFrame) -> DataFrame:
    """``key``, ``sub`` (0 until refined), ``fp`` and ``own`` (entered under its own value)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = batch.column(0).to_numpy()
        keys, fps, owns = [], [], []
        for number in (0, 1):
            rows, values, own = _variants(_segment(fp, number), 32)
            keys.append(values | (number << 32))
            fps.append(fp[rows])
            owns.append(own)
        keys = np.concatenate(keys)
        return batch_of(key=keys, sub=np.zeros(len(keys), np.int32), fp=np.concatenate(fps),
                        own=np.concatenate(owns))
    return map_batches(distinct, run, "key bigint, sub int, fp bigint, own boolean")


def _refined(entries: DataFrame) -> DataFrame:
    """Entries of full buckets, entered again by the quarters of the other segment."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, fp, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
        other = np.where(key >> 32 == 0, _segment(fp, 1), _segment(fp, 0))
        out: list[list] = [[], [], [], []]
        for quarter in (0, 1):
            rows, values, _ = _variants((other >> (16 * quarter)) & 0xFFFF, 16)
            for column, values in zip(out, (key[rows], (values | (quarter << 16)) + 1, fp[rows],
                                            own[rows])):
                column.append(values)
        keys, subs, fps, owns = map(np.concatenate, out)
        return batch_of(key=keys, sub=subs.astype(np.int32), fp=fps, own=owns)
    return map_batches(entries.select("key", "sub", "fp", "own"), run,
                       "key bigint, sub int, fp bigint, own boolean")


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= distance


def reach(members: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect a bucket's members: each one to the member that first reached it."""
    left, right = [], []
    waiting = np.unique(members)
    front = waiting[:0]
    while len(waiting):
        if not len(front):
            front, waiting = waiting[:1], waiting[1:]
        now, front = front[:BLOCK], front[BLOCK:]
        near = _near(now[:, None], waiting[None, :], distance)
        hit = near.any(axis=0)
        left.append(now[near[:, hit].argmax(axis=0)])
        right.append(waiting[hit])
        front, waiting = np.concatenate([front, waiting[hit]]), waiting[~hit]
    none = members[:0]
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(distinct: DataFrame, distance: int = DISTANCE, full: int = FULL_BUCKET) -> DataFrame:
    """``a`` and ``b``: links between distinct fingerprints ``fp`` that connect all near ones."""
    entries = _entries(distinct)
    whole = (F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    own_keys = distinct.select(F.explode(F.array(
        whole[1], whole[0].bitwiseOR(F.lit(1 << 32)))).alias("key"))
    heavy = staged(own_keys.groupBy("key").count().where(F.col("count") > full).select("key"),
                   "full-buckets")
    if not heavy.isEmpty():
        entries = entries.join(heavy, "key", "left_anti").unionByName(
            _refined(entries.join(heavy, "key", "left_semi")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(key, sub, fp, own):
            new = np.flatnonzero((np.diff(key, prepend=key[0] - 1) != 0)
                                 | (np.diff(sub, prepend=sub[0]) != 0))
            size = np.diff(new, append=len(key))
            useful = (size > 1) & np.logical_or.reduceat(own, new)
            out: list[list] = [[], []]
            small = useful & (size <= SMALL_RUN)
            start, n = new[small], size[small]
            for step in range(1, SMALL_RUN):
                start, n = start[n > step], n[n > step]
                each = n - step
                at = np.repeat(start, each) + np.arange(each.sum()) - np.repeat(
                    np.cumsum(each) - each, each)
                hit = at[_near(fp[at], fp[at + step], distance)]
                out[0].append(fp[hit])
                out[1].append(fp[hit + step])
            for a, b in zip(new[useful & ~small].tolist(), size[useful & ~small].tolist()):
                for column, values in zip(out, reach(fp[a:a + b], distance)):
                    column.append(values)
            a, b = map(np.concatenate, out)
            return batch_of(a=np.minimum(a, b), b=np.maximum(a, b))

        held: list[np.ndarray] | None = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(now[0]):
                continue
            held = [np.concatenate(x) for x in zip(held, now)] if held else now
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            cut = int(np.argmax(last))
            if cut:
                yield pairs(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if held:
            yield pairs(*held)

    met = entries.repartition("key", "sub").sortWithinPartitions("key", "sub")
    return met.mapInArrow(released(run), "a bigint, b bigint").where("a != b").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    carry: Sequence[str] = (), shingle: int = SHINGLE) -> DataFrame:
    """``id``, ``fp``, ``component`` (smallest id that can be reached), ``first``, ``carried``.

    ``first`` holds for one row of each component, a row with that id.
    """
    rows = staged(fingerprints(docs, doc_id, text, carry, shingle)
                  .withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    named = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")
    distinct = staged(rows.groupBy("fp").agg(F.min(named).alias("first")), "distinct")
    roots = components(links(distinct.select("fp")))
    labelled = staged(distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "labelled")
    firsts = staged(labelled.groupBy("root").agg(F.min("first").alias("first")), "firsts")
    by_fp = staged(labelled.drop("first").join(firsts, "root").select(
        F.col("fp").alias("of"), "first"), "components")
    return rows.join(by_fp, F.col("fp") == F.col("of")).select(
        "id", "fp", F.col("first.id").alias("component"),
        (F.col("first.row") == F.col("row")).alias("first"), "carried")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

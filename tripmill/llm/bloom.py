"""Bloom filters over 64-bit hashes, and which hashes of a corpus occur more than once.

Tasks send their distinct hashes, once each, to the shard of the hash. A shard puts a hash into its
once-seen filter, and into its twice-seen filter when the first already has it or when one task saw
it twice. Twice-seen filters grow with the repeated hashes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tripmill.llm.common import batch_of, released

SHARDS = 512
FILTER_BYTES = 64 << 20
PROBES = 4
BITS_PER_KEY = 12
FIRST_BITS = 1 << 13


class Bloom:
    """Layers of doubling size; a layer takes keys until it has ``BITS_PER_KEY`` bits for each.

    Membership has no false negatives. Each layer wrongly accepts about 0.7 % when full.
    """

    def __init__(self, layers: list[np.ndarray] | None = None) -> None:
        self.layers = layers if layers is not None else []
        self.room = 0

    @staticmethod
    def _places(bits: int, keys: np.ndarray):
        with np.errstate(over="ignore"):
            step = (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20) | np.uint64(1)
            at = keys ^ (keys >> np.uint64(31))
            for _ in range(PROBES):
                place = at & np.uint64(bits - 1)
                yield (place >> np.uint64(3)).astype(np.int64), \
                    (np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
                at = at + step

    def add(self, keys: np.ndarray) -> None:
        while len(keys):
            if not self.room:
                bits = max(FIRST_BITS, 16 * len(self.layers[-1]) if self.layers else 0)
                while bits < BITS_PER_KEY * len(keys):
                    bits *= 2
                self.layers.append(np.zeros(bits // 8, np.uint8))
                self.room = bits // BITS_PER_KEY
            now, keys = keys[:self.room], keys[self.room:]
            layer = self.layers[-1]
            for byte, bit in self._places(8 * len(layer), now):
                np.bitwise_or.at(layer, byte, bit)
            self.room -= len(now)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), bool)
        for layer in self.layers:
            hit = np.ones(len(keys), bool)
            for byte, bit in self._places(8 * len(layer), keys):
                hit &= (layer[byte] & bit) != 0
            found |= hit
        return found

    def to_bytes(self) -> bytes:
        head = np.array([len(self.layers), *map(len, self.layers)], "<u8").tobytes()
        return head + b"".join(x.tobytes() for x in self.layers)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Bloom:
        n = int(np.frombuffer(raw, "<u8", 1)[0])
        sizes, at, layers = np.frombuffer(raw, "<u8", n, 8), 8 + 8 * n, []
        for size in sizes.tolist():
            layers.append(np.frombuffer(raw, np.uint8, size, at))
            at += size
        return cls(layers)


def by_shard(keys: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
    """Distinct hashes of a task and whether it saw them again, one row for each shard."""
    shard = keys % np.uint64(SHARDS)
    order = np.argsort(shard, kind="stable")
    keys, more, shard = keys[order], more[order], shard[order]
    at = np.flatnonzero(np.diff(shard, prepend=np.uint64(SHARDS)))
    ends = [*at[1:], len(shard)]
    return batch_of(
        shard=pa.array([int(shard[i]) for i in at], pa.int32()),
        once=pa.array([keys[i:j].tobytes() for i, j in zip(at, ends)], pa.binary()),
        more=pa.array([keys[i:j][more[i:j]].tobytes() for i, j in zip(at, ends)], pa.binary()))


BY_SHARD = "shard int, once binary, more binary"


def twice_seen(sent: DataFrame) -> DataFrame:
    """``shard``, its twice-seen ``filter``, and ``n`` hashes put in, from rows of ``by_shard``."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, Bloom] = {}
        twice: dict[int, Bloom] = {}
        added: dict[int, int] = {}
        for batch in batches:
            for shard, keys, more in zip(*(c.to_pylist() for c in batch.columns)):
                first, second = once.setdefault(shard, Bloom()), twice.setdefault(shard, Bloom())
                keys, more = np.frombuffer(keys, np.uint64), np.frombuffer(more, np.uint64)
                known = first.contains(keys)
                again = np.union1d(keys[known], more)
                again = again[~second.contains(again)]
                second.add(again)
                added[shard] = added.get(shard, 0) + len(again)
                first.add(keys[~known])
        if twice:
            yield batch_of(shard=pa.array(list(twice), pa.int32()),
                           filter=pa.array([b.to_bytes() for b in twice.values()], pa.binary()),
                           n=pa.array(list(added.values()), pa.int64()))
    return sent.repartition("shard").mapInArrow(released(fill), "shard int, filter binary, n bigint")


class Repeated:
    """Tests hashes against the twice-seen filters; without filters, all count as repeated."""

    def __init__(self, filters: Broadcast | None) -> None:
        self.filters, self.open = filters, None

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if self.filters is None:
            return np.ones(len(hashes), bool)
        if self.open is None:
            self.open = {s: Bloom.from_bytes(raw) for s, raw in self.filters.value.items()}
        shards = (hashes % np.uint64(SHARDS)).astype(np.int64)
        hit = np.zeros(len(hashes), bool)
        order = np.argsort(shards, kind="stable")
        cuts = np.flatnonzero(np.diff(shards[order])) + 1
        for at in np.split(order, cuts) if len(order) else []:
            found = self.open.get(int(shards[at[0]]))
            if found is not None:
                hit[at] = found.contains(hashes[at])
        return hit


def repeated(filters: DataFrame, most: int = FILTER_BYTES) -> tuple[Repeated, int]:
    """Test for repeated hashes and how many there are, about.

    The filters are sent to all tasks if they have at most ``most`` bytes.
    """
    size, n = filters.agg(F.sum(F.length("filter")), F.sum("n")).first()
    if (size or 0) > most:
        return Repeated(None), n
    return Repeated(filters.sparkSession.sparkContext.broadcast(
        {r[0]: bytes(r[1]) for r in filters.collect()})), n or 0

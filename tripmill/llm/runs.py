"""Sorted runs of byte strings: front coding, cutting, and merging without comparing twice.

A front-coded run holds for each string the length of the prefix it shares with the one before and
only the bytes after it. A tournament of losers merges runs by these lengths: the candidate that
shares more with the last string out is the smaller one, and bytes are compared only where both
share equally much, from there on. The shared lengths of the merged order come out of it for free.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import zstandard

STEP = 32
LEVEL = 1


def shared(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    at = start
    while at < n:
        x, y = a[at:at + STEP], b[at:at + STEP]
        if x != y:
            m = min(len(x), len(y))
            if x[:m] == y[:m]:
                return at + m
            diff = int.from_bytes(x[:m], "big") ^ int.from_bytes(y[:m], "big")
            return at + m - (diff.bit_length() + 7) // 8
        at += STEP
    return n


def pack(strings: Sequence[bytes], payload: np.ndarray, known: Sequence[int] | None = None) -> bytes:
    """A front-coded, compressed run; ``known`` are shared lengths, if they are known already."""
    if known is None:
        known = [0] + [shared(a, b) for a, b in zip(strings, strings[1:])]
    tails = [s[n:] for s, n in zip(strings, known)]
    raw = b"".join([
        np.array([len(strings)], "<u8").tobytes(), np.array(known, "<u4").tobytes(),
        np.array([len(t) for t in tails], "<u4").tobytes(), payload.tobytes(), *tails])
    return zstandard.ZstdCompressor(level=LEVEL).compress(raw)


class Run:
    """A packed run, read string by string."""

    def __init__(self, packed: bytes, kind: np.dtype) -> None:
        raw = zstandard.ZstdDecompressor().decompress(packed)
        n = int(np.frombuffer(raw, "<u8", 1)[0])
        self.known = np.frombuffer(raw, "<u4", n, 8).tolist()
        self.sizes = np.frombuffer(raw, "<u4", n, 8 + 4 * n).tolist()
        self.payload = np.frombuffer(raw, kind, n, 8 + 8 * n)
        self.raw, self.start = raw, 8 + 8 * n + n * kind.itemsize

    def __iter__(self) -> Iterator[tuple[bytes, int]]:
        at, last, raw = self.start, b"", self.raw
        for known, size in zip(self.known, self.sizes):
            last = last[:known] + raw[at:at + size]
            at += size
            yield last, known


def cut(strings: Sequence[bytes], splitters: Sequence[bytes]) -> list[tuple[int, int, int]]:
    """Part number, start and end of the pieces of a sorted run; equal strings share a part.

    A part begins with strings above its splitter.
    """
    out, start = [], 0
    if len(splitters) <= len(strings):
        for part, s in enumerate(splitters):
            end = bisect_right(strings, s, start)
            if end > start:
                out.append((part, start, end))
                start = end
        if start < len(strings):
            out.append((len(splitters), start, len(strings)))
        return out
    while start < len(strings):
        part = part_of(strings[start], splitters)
        end = bisect_right(strings, splitters[part], start) if part < len(splitters) \
            else len(strings)
        out.append((part, start, end))
        start = end
    return out


def part_of(string: bytes, splitters: Sequence[bytes]) -> int:
    """The first part whose splitter is not below the string."""
    low, high = 0, len(splitters)
    while low < high:
        mid = (low + high) // 2
        if splitters[mid] < string:
            low = mid + 1
        else:
            high = mid
    return low


def merge(runs: Sequence[Run]) -> Iterator[tuple[bytes, int, int, int]]:
    """All strings in order: string, length shared with the one before, run, place in the run."""
    width = 1 << max(0, len(runs) - 1).bit_length()
    sources = [iter(r) for r in runs]
    heads: list[bytes | None] = [next(s, (None,))[0] for s in sources]
    heads += [None] * (width - len(heads))
    places = [0] * width
    loser, known = [0] * width, [0] * width

    def play(node: int) -> int:
        """Winner below a node; losers keep the length they share with the winner."""
        if node >= width:
            return node - width
        a, b = play(2 * node), play(2 * node + 1)
        x, y = heads[a], heads[b]
        if x is None or y is not None and y < x:
            a, b, x, y = b, a, y, x
        loser[node] = b
        known[node] = shared(x, y) if y is not None else 0
        return a

    winner, length = play(1), 0
    while heads[winner] is not None:
        yield heads[winner], length, winner, places[winner]
        now = next(sources[winner], None)
        places[winner] += 1
        heads[winner], length = now if now else (None, 0)
        node = (width + winner) >> 1
        while node:
            other = loser[node]
            x, y = heads[winner], heads[other]
            if y is not None:
                theirs = known[node]
                if x is None or theirs > length:
                    # The other one shares more with the last string out: it is the smaller.
                    loser[node], known[node] = winner, length
                    winner, length = other, theirs
                elif theirs == length:
                    both = shared(x, y, length)
                    if y[both:both + 1] < x[both:both + 1]:
                        loser[node], known[node] = winner, both
                        winner = other
                    else:
                        known[node] = both
            node >>= 1

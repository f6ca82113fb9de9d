"""Exact repeated substrings of ``SPAN`` bytes, by a sparse suffix array over the whole corpus.

Every window of ``SPAN`` bytes has an anchor: the place of its smallest hash over ``GRAM`` bytes,
the leftmost of equals. Equal windows have equal anchors at equal offsets, so only anchors take part
(about one in 70 bytes), and of these only those whose hash occurs twice (two Bloom filters).

1. Contexts. An anchor stands for a range of windows. Its context, the bytes to its left read
   backwards and then those to its right, is sorted over the corpus: tasks send front-coded sorted
   runs to range partitions, which merge them by a tournament that never compares known prefixes.
   Equal contexts are one entry with one member kept: their windows all repeat. For the other ones,
   the shared lengths in this order give, for each anchor, all lengths to which the text to its left
   agrees with the text left of some other anchor.
2. Suffixes. At each such length a suffix starts that may begin a match. These are sorted and merged
   in the same manner. A suffix that shares at least ``SPAN`` bytes with a neighbour from another
   place is repeated to that length. Any repeated window lies in such a stretch, since the match
   around it starts, left of its anchor, at a length at which both texts stop to agree.

Neighbours across the borders of partitions are settled from the first and last entries of each
partition, so groups may be split anywhere. Copies are reduced to one entry in each task before
they are sent. Strings are compared as bytes; hashes only decide what is looked at.

Defined cases: null text counts as empty; texts below ``SPAN`` bytes lose nothing; bytes are removed
also inside multi-byte characters; rows with equal id and text are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tripmill.llm.bloom import (
    BY_SHARD, FILTER_BYTES, Repeated, by_shard, repeated, twice_seen)
from tripmill.llm.common import batch_of, carried, fields, in_slices, map_batches, released, staged
from tripmill.llm.runs import Run, cut, merge, pack, shared

SPAN = 200
GRAM = 64
CHUNK = 1 << 23
PART_ENTRIES = 60_000
SAMPLE_RATE = 256
PART_SAMPLE = 20
RUN_BYTES = 96 << 20
HASHES_AT_ONCE = 1 << 20

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                               0xD6E8FEB86659FD93)]
# A member: the document's key, a number of its row, and where the anchor or suffix is.
CONTEXT = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("row", "<i8"), ("at", "<i8"),
                    ("left", "<u2"), ("many", "u1")])
SUFFIX = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("row", "<i8"), ("at", "<i8"), ("many", "u1")])
_HASH = 8
_END = b"\xff"  # never part of UTF-8

_OUT = "part int, block binary, k1 bigint, k2 bigint, start bigint, end bigint"


def _gram_hashes(raw: bytes, start: int, end: int) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place of a stretch of text on."""
    n = end - start
    word = np.empty(n - 7, np.uint64)
    for shift in range(min(8, n - 7)):
        own = word[shift::8]
        own[:] = np.frombuffer(raw, "<u8", len(own), start + shift)
    with np.errstate(over="ignore"):
        size, h = 8, word * _MIX[0]
        h ^= h >> np.uint64(32)
        for factor in _MIX[1:]:
            h = h[:-size] * factor + h[size:]
            h ^= h >> np.uint64(29)
            size *= 2
        h *= _MIX[0]
        h ^= h >> np.uint64(32)
    return h


def anchors(raw: bytes) -> tuple[np.ndarray, ...]:
    """Places, hashes, and the first and last window start of each anchor."""
    n = len(raw) - SPAN + 1
    width = SPAN - GRAM + 1
    out: list[tuple[np.ndarray, ...]] = []
    for first in range(0, max(n, 0), CHUNK):
        windows = min(CHUNK, n - first)
        h = _gram_hashes(raw, first, first + windows + SPAN - 1)
        place = np.arange(len(h), dtype=np.uint64)
        key = (h & np.uint64(0xFFFFFFFFFF000000)) | place
        padded = np.full(-(-len(key) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        padded[:len(key)] = key
        blocks = padded.reshape(-1, width)
        before = np.minimum.accumulate(blocks, axis=1).ravel()
        after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(after[:windows], before[width - 1:width - 1 + windows])
        at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        low = np.flatnonzero(np.diff(at, prepend=-1))
        high = np.append(low[1:], windows) - 1
        out.append((at[low] + first, h[at[low]], low + first, high + first))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*out))


def context(raw: bytes, at: int, gram: int, low: int, high: int) -> bytes:
    return b"".join([gram.to_bytes(_HASH, "big"), raw[low:at][::-1], _END, raw[at:high + SPAN]])


def _text_of(entry: bytes, left: int) -> bytes:
    """The text of a context from its first window on."""
    return entry[_HASH:_HASH + left][::-1] + entry[_HASH + left + 1:]


def _spans(rows: Iterable[tuple[int, int, int, int]]) -> pa.RecordBatch | None:
    """Stretches (document key, start, end), joined where they touch."""
    data = np.array(list(rows), np.int64).reshape(-1, 4)
    if not len(data):
        return None
    data = data[np.lexsort((data[:, 2], data[:, 1], data[:, 0]))]
    # Each document gets a range of numbers of its own, so one running maximum serves all.
    doc = np.cumsum((np.diff(data[:, :2], axis=0, prepend=data[:1, :2]) != 0).any(axis=1))
    shift = doc * (int(data[:, 3].max()) + 2)
    end = np.maximum.accumulate(data[:, 3] + shift)
    new = np.flatnonzero(np.concatenate([[True], data[1:, 2] + shift[1:] > end[:-1]]))
    last = np.append(new[1:], len(data)) - 1
    n = len(new)
    return batch_of(part=pa.nulls(n, pa.int32()), block=pa.nulls(n, pa.binary()),
                    k1=data[new, 0], k2=data[new, 1], start=data[new, 2], end=end[last] - shift[new])


def _blocks(parts: Sequence[tuple[int, bytes]]) -> pa.RecordBatch:
    n = len(parts)
    return batch_of(part=pa.array([p for p, _ in parts], pa.int32()),
                    block=pa.array([b for _, b in parts], pa.binary()),
                    **{c: pa.nulls(n, pa.int64()) for c in ("k1", "k2", "start", "end")})


def _packed(strings: list[bytes], payload: np.ndarray, splitters: Sequence[bytes]
            ) -> Iterator[pa.RecordBatch]:
    for part, a, b in cut(strings, splitters):
        yield _blocks([(part, pack(strings[a:b], payload[a:b]))])


def _batch_anchors(texts: list[bytes | None]) -> tuple[list[int], list[tuple[np.ndarray, ...]]]:
    found, which = [], []
    for i, raw in enumerate(texts):
        if raw is not None and len(raw) >= SPAN:
            which.append(i)
            found.append(anchors(raw))
    return which, found


def _seen_anchors(rows: DataFrame) -> DataFrame:
    """Anchor hashes by filter shard; a sample of contexts has the hash in ``once``, no shard."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        picked: list[bytes] = []
        size = 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            yield by_shard(keys, n > 1)
            if picked:
                yield batch_of(shard=pa.nulls(len(picked), pa.int32()),
                               once=pa.array(picked, pa.binary()),
                               more=pa.nulls(len(picked), pa.binary()))
            held.clear()
            picked.clear()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i, (at, grams, low, high) in zip(*_batch_anchors(texts)):
                held.append(grams)
                size += len(grams)
                for j in np.flatnonzero((grams ^ at.astype(np.uint64) * _MIX[1])
                                        % np.uint64(SAMPLE_RATE) == 0).tolist():
                    picked.append(context(texts[i], int(at[j]), int(grams[j]), int(low[j]),
                                          int(high[j]))[:SPAN])
            if size > HASHES_AT_ONCE:
                yield from flush()
                size = 0
        if size:
            yield from flush()
    return rows.select("raw").mapInArrow(released(gather), BY_SHARD)


def _splitters(sample: list[bytes], parts: int) -> list[bytes]:
    sample = sorted(sample)
    return sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []


def _context_runs(rows: DataFrame, test: Repeated, splitters: Sequence[bytes]) -> DataFrame:
    """Sorted runs of contexts, cut at the splitters, and spans of contexts a task has twice."""
    sent = rows.sparkSession.sparkContext.broadcast(splitters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        entries: list[tuple[bytes, int]] = []
        members: list[np.ndarray] = []
        number = size = 0

        def flush():
            entries.sort()
            every = np.concatenate(members)
            strings = [s for s, _ in entries]
            order = np.array([i for _, i in entries])
            new = np.flatnonzero([True] + [a != b for a, b in zip(strings, strings[1:])])
            many = np.diff(new, append=len(strings)) > 1
            whole = np.repeat(many, np.diff(new, append=len(strings)))
            own = every[order[whole]]
            length = np.array([len(strings[i]) for i in np.flatnonzero(whole)], np.int64)
            left = own["left"].astype(np.int64)
            spans = _spans(zip(own["k1"].tolist(), own["k2"].tolist(), (own["at"] - left).tolist(),
                               (own["at"] + length - _HASH - 1 - left).tolist()))
            if spans:
                yield spans
            kept = every[order[new]]
            kept["many"] = many
            yield from _packed([strings[i] for i in new], kept, sent.value)
            entries.clear()
            members.clear()

        for batch in batches:
            texts = batch.column(0).to_pylist()
            k1, k2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            which, found = _batch_anchors(texts)
            for part in in_slices([len(f[0]) for f in found], HASHES_AT_ONCE):
                now = found[part]
                hit = test(np.concatenate([f[1] for f in now]))
                done = 0
                for i, (at, grams, low, high) in zip(which[part], now):
                    own = np.flatnonzero(hit[done:done + len(at)])
                    done += len(at)
                    if not len(own):
                        continue
                    raw, at, grams, low, high = texts[i], at[own], grams[own], low[own], high[own]
                    member = np.zeros(len(own), CONTEXT)
                    member["k1"], member["k2"], member["at"] = k1[i], k2[i], at
                    member["row"], member["left"] = (task << 36) + number + i, at - low
                    base = len(entries)
                    members.append(member)
                    for j, key in enumerate(zip(at.tolist(), grams.tolist(), low.tolist(),
                                                high.tolist())):
                        s = context(raw, *key)
                        entries.append((s, base + j))
                        size += len(s)
                    if size > RUN_BYTES:
                        yield from flush()
                        size = 0
            number += batch.num_rows
        if entries:
            yield from flush()
    return rows.select("raw", "k1", "k2").mapInArrow(released(run), _OUT)


def spread() -> Column:
    """A key that blocks of a part share and spans do not. The hash of a null is not null."""
    return F.when(F.col("part").isNotNull(), F.xxhash64("part")).otherwise(
        F.xxhash64("k1", "k2", "start"))


def _by_part(runs: DataFrame) -> DataFrame:
    """Blocks of a part together in one task; spans anywhere."""
    return runs.repartition(spread()).sortWithinPartitions("part")


def _parts(batches: Iterator[pa.RecordBatch], finish) -> Iterator[pa.RecordBatch]:
    """Pass spans on, and call ``finish`` with each part and its blocks."""
    part, blocks = None, []
    for batch in batches:
        alone = batch.filter(batch.column(0).is_null())
        if alone.num_rows:
            yield alone
        for p, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if p is None:
                continue
            if p != part and blocks:
                yield from finish(part, blocks)
                blocks = []
            part = p
            blocks.append(block)
    if blocks:
        yield from finish(part, blocks)


def _merged_contexts(runs: DataFrame) -> DataFrame:
    """One block a part, of distinct contexts; spans of contexts that several tasks had."""
    def finish(part: int, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        sources = [Run(b, CONTEXT) for b in blocks]
        strings: list[bytes] = []
        known: list[int] = []
        groups: list[list[tuple[int, int]]] = []
        for string, length, source, place in merge(sources):
            if strings and length == len(string) == len(strings[-1]):
                groups[-1].append((source, place))
            else:
                strings.append(string)
                known.append(length)
                groups.append([(source, place)])
        payload = np.array([sources[g[0][0]].payload[g[0][1]] for g in groups], CONTEXT)
        spans = []
        for i, group in enumerate(groups):
            if len(group) > 1:
                payload["many"][i] = 1
                for source, place in group:
                    m = sources[source].payload[place]
                    if not m["many"]:
                        start = int(m["at"]) - int(m["left"])
                        spans.append((m["k1"], m["k2"], start, start + len(strings[i]) - _HASH - 1))
        found = _spans(spans)
        if found:
            yield found
        yield _blocks([(part, pack(strings, payload, known))])

    def run(batches):
        return _parts(batches, finish)
    return _by_part(runs).mapInArrow(released(run), _OUT)


def _walk(known: Sequence[int], entering: Sequence[int]) -> Iterator[list[int]]:
    """For each entry, the lengths it shares with those before it, each length once.

    ``known`` is what an entry shares with the one before; ``entering`` what the first one shares
    with entries of earlier parts. Lengths below the hash are left out.
    """
    stack = sorted(x for x in set(entering) if x >= _HASH)
    for i, length in enumerate(known):
        if i:
            while stack and stack[-1] >= length:
                stack.pop()
            if length >= _HASH:
                stack.append(length)
        yield stack


def _stairs(known: Sequence[int]) -> list[int]:
    """Running minima of shared lengths, from the first entry of a part on."""
    out, low = [], 1 << 30
    for length in known:
        if length < low:
            low = length
            out.append(low)
        if low < _HASH:
            break
    return out


def _edges(contexts: DataFrame) -> tuple[dict[int, tuple[list[int], list[int]]], list[bytes]]:
    """What each part's first and last entries share with other parts; a sample of suffixes.

    A part sends two entries, at most one number for each byte of a context, and some samples.
    """
    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        firsts, lasts, ups, downs, ends, samples = [], [], [], [], [], []
        for block in batch.column(1).to_pylist():
            run = Run(block, CONTEXT)
            strings = [s for s, _ in run]
            firsts.append(strings[0])
            lasts.append(strings[-1])
            ups.append(_stairs(run.known[1:]))
            downs.append(_stairs(run.known[:0:-1]))
            ends.append(min(run.known[1:], default=1 << 30))
            step = -(-len(strings) // PART_SAMPLE)
            samples.append([s[_HASH + 1 + int(left):][:SPAN] for s, left in zip(
                strings[::step], run.payload["left"][::step])])
        kind = pa.list_(pa.int32())
        return batch_of(part=batch.column(0), first=pa.array(firsts, pa.binary()),
                        last=pa.array(lasts, pa.binary()), ups=pa.array(ups, kind),
                        downs=pa.array(downs, kind), least=pa.array(ends, pa.int32()),
                        sample=pa.array(samples, pa.list_(pa.binary())))

    rows = sorted(map_batches(
        contexts, look, "part int, first binary, last binary, ups array<int>, downs array<int>, "
                        "least int, sample array<binary>").collect())
    joint = [shared(bytes(a[2]), bytes(b[1])) for a, b in zip(rows, rows[1:])]

    def reach(steps) -> list[int]:
        out: set[int] = set()
        low = 1 << 30
        for length, stairs, least in steps:
            low = min(low, length)
            if low < _HASH:
                break
            out |= {min(low, s) for s in [1 << 30, *stairs]}
            low = min(low, least)
        return [x for x in out if x >= _HASH]

    found = {}
    for i, row in enumerate(rows):
        before = reach((joint[j], rows[j][4], rows[j][5]) for j in range(i - 1, -1, -1))
        after = reach((joint[j], rows[j + 1][3], rows[j + 1][5]) for j in range(i, len(joint)))
        if before or after:
            found[row[0]] = before, after
    return found, [bytes(s) for r in rows for s in r[6]]


def _suffix_runs(contexts: DataFrame, edges: dict, splitters: Sequence[bytes]) -> DataFrame:
    """Sorted runs of the suffixes that may begin a match."""
    sent = contexts.sparkSession.sparkContext.broadcast((edges, splitters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, splitters = sent.value
        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                before, after = edges.get(part, ((), ()))
                source = Run(block, CONTEXT)
                strings = [s for s, _ in source]
                starts: list[set[int]] = [set(x) for x in _walk(source.known, before)]
                for mine, theirs in zip(reversed(starts),
                                        _walk([0, *source.known[:0:-1]], after)):
                    mine.update(theirs)
                entries: list[tuple[bytes, int, int]] = []
                for i, (string, mine) in enumerate(zip(strings, starts)):
                    left = int(source.payload["left"][i])
                    lengths = {min(x - _HASH, left) for x in mine}
                    if not lengths:
                        continue
                    text = _text_of(string, left)
                    least = SPAN - (len(text) - left)  # from there on a window fits
                    entries += [(text[left - n:], i, n) for n in lengths if n >= least]
                entries.sort()
                texts = [e[0] for e in entries]
                who = np.array([e[1] for e in entries], np.int64)
                kept = np.zeros(len(entries), SUFFIX)
                for name in ("k1", "k2", "row"):
                    kept[name] = source.payload[name][who]
                kept["at"] = source.payload["at"][who] - np.array([e[2] for e in entries], np.int64)
                if not len(kept):
                    continue
                new = np.flatnonzero([True] + [a != b for a, b in zip(texts, texts[1:])])
                each = np.diff(new, append=len(texts))
                spans = []
                for a, n in zip(new[each > 1].tolist(), each[each > 1].tolist()):
                    own = kept[a:a + n]
                    if len(np.unique(own[["row", "at"]])) > 1 and len(texts[a]) >= SPAN:
                        kept["many"][a] = 1
                        spans += [(m["k1"], m["k2"], m["at"], m["at"] + len(texts[a])) for m in own]
                found = _spans(spans)
                if found:
                    yield found
                yield from _packed([texts[i] for i in new], kept[new], splitters)
    return contexts.mapInArrow(released(run), _OUT)


class _Neighbour:
    """The last two places passed, with the length the entry at hand shares with each."""

    def __init__(self) -> None:
        self.place = self.other = None
        self.length = self.other_length = 0

    def step(self, known: int, place, many: bool) -> int:
        """Longest length shared with an earlier entry of another place; then pass this entry.

        ``known`` is what the entry shares with the one just before. A place of many is none.
        """
        self.length, self.other_length = min(self.length, known), min(self.other_length, known)
        if many:
            place = object()
        if place != self.place:
            best = self.length
            self.other, self.other_length = self.place, self.length
            self.place = place
        else:
            best = self.other_length
        self.length = 1 << 30
        return best


def _matches(runs: DataFrame) -> DataFrame:
    """Spans of suffixes that repeat; each part also gives its edges, as a packed run."""
    def finish(part: int, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
        sources = [Run(b, SUFFIX) for b in blocks]
        strings, known, where = [], [], []
        for string, length, source, place in merge(sources):
            strings.append(string)
            known.append(length)
            where.append((source, place))
        payload = np.array([sources[s].payload[p] for s, p in where], SUFFIX)
        places = list(zip(payload["row"].tolist(), payload["at"].tolist()))
        many = payload["many"].astype(bool).tolist()
        best = [0] * len(strings)
        for order, lengths in ((range(len(strings)), known),
                               (range(len(strings) - 1, -1, -1), [*known[1:], 0])):
            near = _Neighbour()
            for i in order:
                best[i] = max(best[i], near.step(lengths[i], places[i], many[i]))
        found = _spans((m["k1"], m["k2"], m["at"], m["at"] + n)
                       for m, n in zip(payload, best) if n >= SPAN)
        if found:
            yield found
        ends = _two_places(range(len(places)), places), _two_places(
            range(len(places) - 1, -1, -1), places)
        edge = sorted({*ends[0], *ends[1]})
        flagged = payload[edge]
        yield _blocks([(part, pack([strings[i] for i in edge], flagged))])

    def run(batches):
        return _parts(batches, finish)
    return _by_part(runs).mapInArrow(released(run), _OUT)


def _two_places(order: Iterable[int], places: list) -> list[int]:
    """The first entries, in this order, of two different places."""
    out: list[int] = []
    for i in order:
        if not out or places[i] != places[out[0]]:
            out.append(i)
        if len(out) == 2:
            break
    return out


def _border_spans(found: DataFrame) -> list[tuple[int, int, int, int]]:
    """Matches between neighbouring parts, from at most four entries of each."""
    edges = [(Run(bytes(r[1]), SUFFIX), r[0]) for r in
             sorted(found.where("block is not null").select("part", "block").collect())]
    out = []
    for (a, _), (b, _) in zip(edges, edges[1:]):
        for x, (s, _) in zip(a.payload[-2:], list(a)[-2:]):
            for y, (t, _) in zip(b.payload[:2], list(b)[:2]):
                n = shared(s, t)
                if n >= SPAN and (x["row"], x["at"]) != (y["row"], y["at"]):
                    out += [(int(m["k1"]), int(m["k2"]), int(m["at"]), int(m["at"]) + n)
                            for m in (x, y)]
    return out


def repeated_spans(rows: DataFrame, filter_bytes: int = FILTER_BYTES,
                   part_entries: int = PART_ENTRIES) -> DataFrame:
    """``k1``, ``k2`` and ``spans`` (start and end byte, in any order) of documents with repeats.

    ``rows`` has ``raw`` and a document key ``k1``, ``k2``.
    """
    seen = staged(_seen_anchors(rows), "anchors")
    filters = staged(twice_seen(seen.where("shard is not null")), "anchor-filters")
    test, n = repeated(filters, filter_bytes)
    # Each repeated hash is sent at least twice; the sample is thinned to a few for each part.
    parts = max(1, -(-3 * n // part_entries))
    sample = seen.where("shard is null").select("once")
    size = sample.count()
    thin = max(1, size // (PART_SAMPLE * parts))
    picked = [bytes(r[0]) for r in
              sample.where(F.pmod(F.xxhash64("once"), F.lit(thin)) == 0).collect()]
    contexts = staged(_merged_contexts(_context_runs(rows, test, _splitters(picked, parts))),
                      "contexts")
    blocks = contexts.where("block is not null")
    edges, suffixes = _edges(blocks)
    matches = staged(_matches(_suffix_runs(blocks, edges, _splitters(suffixes, parts))), "matches")
    border = rows.sparkSession.createDataFrame(
        _border_spans(matches), "k1 bigint, k2 bigint, start bigint, end bigint")
    every = (contexts.where("block is null").select("k1", "k2", "start", "end")
             .unionByName(matches.where("block is null").select("k1", "k2", "start", "end"))
             .unionByName(border))
    return every.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def merged_spans(spans: Sequence[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                carry: Sequence[str] = (), **limits: int) -> DataFrame:
    """``id``, ``kept`` (bytes), ``n_bytes``, ``n_removed``, ``spans`` and ``carried``."""
    raw = F.col(text).cast("binary")
    rows = docs.select(F.col(doc_id).alias("id"), raw.alias("raw"),
                       F.xxhash64(F.col(doc_id).cast("string"), raw).alias("k1"),
                       F.xxhash64(raw, F.lit(1), F.col(doc_id).cast("string")).alias("k2"),
                       carried(docs, carry).alias("carried"))
    spans = repeated_spans(rows, **limits).select(
        F.col("k1").alias("s1"), F.col("k2").alias("s2"), "spans")
    kind = "array<struct<start: bigint, end: bigint>>"
    short = F.coalesce(F.length("raw"), F.lit(0)) < SPAN
    alone = rows.where(short).select("id", "raw", F.lit(None).cast(kind).alias("spans"), "carried")
    held = rows.where(~short).join(
        spans, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left").select(
        "id", "raw", "spans", "carried")

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, sizes, removed, runs = [], [], [], []
        for raw, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw = raw or b""
            gone = merged_spans(spans or ())
            ends = [0, *(b for _, b in gone)]
            starts = [*(a for a, _ in gone), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(ends, starts)))
            sizes.append(len(raw))
            removed.append(sum(b - a for a, b in gone))
            runs.append([{"start": a, "end": b} for a, b in gone])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return batch_of(id=batch.column(0), kept=pa.array(kept, pa.binary()),
                        n_bytes=pa.array(sizes, pa.int64()),
                        n_removed=pa.array(removed, pa.int64()), spans=pa.array(runs, span),
                        carried=batch.column(3))

    schema = fields(rows, ["id"], f"kept binary, n_bytes bigint, n_removed bigint, spans {kind}")
    return map_batches(alone.unionByName(held), apply, schema.add(rows.schema["carried"]))

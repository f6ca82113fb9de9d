"""Benchmark decontamination: an exact containment join of item windows with documents.

A window is ``WINDOW`` consecutive words of an item (all its words, if it has fewer). A document
word inside any occurrence of a window is hit.

1. Windows are cut into shingles of ``SHINGLE`` words; their frequency over all documents is
   counted. Exact containment needs every shingle, so the rarest one is a window's prefix token.
2. Document shingles are joined with the prefix tokens. The token's place in its window gives the
   only possible start, which must leave room for the whole window inside the document.
3. The words of the candidate span are compared with those of the window.

Windows are taken ``WINDOWS_AT_ONCE`` at a time, so what is sent to the tasks is bounded for any
benchmark; each part is one pass over the documents. Defined cases: null text has no words; items
with equal ids count once; an item without an id marks words but is not listed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripmill.llm.common import batch_of, carried, fields, in_slices, map_batches, released, staged

WINDOW = 10
SHINGLE = 3
WINDOWS_AT_ONCE = 200_000
WORDS_AT_ONCE = 1 << 20
ID_BITS = 21

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and non-ASCII characters, A-Z in lower case."""
    return (text or b"").translate(_WORD_BYTES).split()


def item_windows(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item`` and ``window``, words joined by spaces, each pair once."""
    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, windows = [], []
        for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(raw)
            for at in range(max(1, len(words) - WINDOW + 1) if words else 0):
                ids.append(i)
                windows.append(b" ".join(words[at:at + WINDOW]).decode())
        return batch_of(item=pa.array(ids, pa.string()), window=pa.array(windows, pa.string()))
    rows = items.select(F.col(item_id).cast("string"), F.col(text).cast("binary"))
    return map_batches(rows, cut, "item string, window string").distinct()


class Index:
    """Windows as rows of word numbers, their shingles, and after ``order`` their prefix tokens."""

    def __init__(self, windows: list[str]) -> None:
        split = [w.encode().split(b" ") for w in windows]
        self.vocabulary: dict[bytes, int] = {}
        for words in split:
            for w in words:
                self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.length = np.array([len(w) for w in split], np.int64)
        self.rows = np.zeros((len(split), WINDOW), np.int64)
        for i, words in enumerate(split):
            self.rows[i, :len(words)] = [self.vocabulary[w] for w in words]
        self.size = np.minimum(self.length, SHINGLE)
        places = WINDOW - np.minimum(self.size, WINDOW) + 1
        self.tokens: dict[int, np.ndarray] = {}
        self.per_window: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in np.unique(self.size).tolist():
            own = np.flatnonzero(self.size == size)
            keys = np.full((len(own), int(places[own].max())), -1, np.int64)
            for at in range(keys.shape[1]):
                fits = at + size <= self.length[own]
                keys[fits, at] = shingle_keys(self.rows[own][fits, at:at + size], size)[:, 0]
            self.per_window[size] = own, keys
            self.tokens[size] = np.unique(keys[keys >= 0])

    def order(self, counts: dict[int, np.ndarray]) -> None:
        """Choose each window's rarest shingle, the leftmost of equals."""
        self.prefix: dict[int, tuple[np.ndarray, ...]] = {}
        for size, (own, keys) in self.per_window.items():
            known = self.tokens[size]
            often = np.where(keys >= 0, counts[size][np.searchsorted(known, keys) % len(known)],
                             np.iinfo(np.int64).max)
            place = often.argmin(axis=1)
            token = keys[np.arange(len(own)), place]
            by = np.argsort(token, kind="stable")
            token, first = np.unique(token[by], return_index=True)
            self.prefix[size] = (token, np.append(first, len(own)), own[by], place[by])
        self.per_window = {}


def shingle_keys(words: np.ndarray, size: int) -> np.ndarray:
    """Numbers of consecutive words packed into one; -1 where one of them is in no window."""
    n = words.shape[-1] - size + 1
    key = np.zeros((*words.shape[:-1], max(n, 0)), np.int64)
    known = np.ones(key.shape, bool)
    for i in range(size if n > 0 else 0):
        part = words[..., i:i + n]
        key = (key << ID_BITS) | part
        known &= part > 0
    return np.where(known, key, -1)


def numbered(texts: list[bytes | None], vocabulary: dict[bytes, int]
             ) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Slices of documents as one run of word numbers, a zero after each, with their starts."""
    split = [words_of(t) for t in texts]
    for part in in_slices([len(w) for w in split], WORDS_AT_ONCE):
        own = split[part]
        starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in own])]).astype(np.int64)
        words = np.zeros(int(starts[-1]), np.int64)
        for w, at in zip(own, starts.tolist()):
            words[at:at + len(w)] = [vocabulary.get(x, 0) for x in w]
        yield part, words, starts


def occurrences(words: np.ndarray, index: Index) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and window numbers of all window occurrences."""
    for size, (token, first, window, place) in index.prefix.items():
        keys = shingle_keys(words, size)
        at = np.flatnonzero(keys >= 0)
        found = np.searchsorted(token, keys[at])
        found[found == len(token)] = 0
        hit = token[found] == keys[at]
        at, found = at[hit], found[hit]
        each = first[found + 1] - first[found]
        for part in in_slices(each.tolist(), WORDS_AT_ONCE):
            n = each[part]
            row = np.repeat(first[found[part]], n) + (
                np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            w, start = window[row], np.repeat(at[part], n) - place[row]
            room = (start >= 0) & (start + index.length[w] <= len(words))
            w, start = w[room], start[room]
            same = np.ones(len(w), bool)
            for i in range(WINDOW):
                inside = i < index.length[w]
                same &= ~inside | (words[np.minimum(start + i, len(words) - 1)] == index.rows[w, i])
            yield start[same], w[same]


def _shingle_counts(docs: DataFrame, index: Index) -> dict[int, np.ndarray]:
    """How often each shingle of the index occurs in all documents."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((index.vocabulary, index.tokens))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, tokens = sent.value
        sums = {s: np.zeros(len(t) + 1, np.int64) for s, t in tokens.items()}
        for batch in batches:
            for _, words, _ in numbered(batch.column(0).to_pylist(), vocabulary):
                for size, token in tokens.items():
                    keys = shingle_keys(words, size)
                    keys = keys[keys >= 0]
                    found = np.minimum(np.searchsorted(token, keys), len(token) - 1)
                    sums[size] += np.bincount(
                        np.where(token[found] == keys, found, len(token)), minlength=len(token) + 1)
        for size, n in sums.items():
            at = np.flatnonzero(n[:-1])
            yield batch_of(size=pa.array(np.full(len(at), size), pa.int32()),
                           token=pa.array(at, pa.int64()), n=pa.array(n[at], pa.int64()))

    rows = (docs.mapInArrow(released(count), "size int, token bigint, n bigint")
            .groupBy("size", "token").agg(F.sum("n").alias("n")).collect())
    counts = {s: np.zeros(len(t), np.int64) for s, t in index.tokens.items()}
    for size, token, n in rows:
        counts[size][token] = n
    return counts


def _matched(rows: DataFrame, part: DataFrame) -> DataFrame:
    """``rows`` with hit ``spans`` (start and end word), ``items`` and ``n_words``, for one part."""
    spark = rows.sparkSession
    listed = part.groupBy("window").agg(F.collect_set("item").alias("items")).collect()
    index = Index([r[0] for r in listed])
    index.order(_shingle_counts(rows.select("raw"), index))
    sent = spark.sparkContext.broadcast((index, [r[1] for r in listed]))

    def match(batch: pa.RecordBatch) -> pa.RecordBatch:
        index, items = sent.value
        spans: list[list] = []
        named: list[list] = []
        counts: list[int] = []
        texts = batch.column(batch.schema.get_field_index("raw")).to_pylist()
        for part, words, starts in numbered(texts, index.vocabulary):
            edge = np.zeros(len(words) + 1, np.int64)
            doc_window: set[tuple[int, int]] = set()
            for start, w in occurrences(words, index):
                np.add.at(edge, start, 1)
                np.add.at(edge, start + index.length[w], -1)
                doc = np.searchsorted(starts, start, "right") - 1
                doc_window.update(zip(doc.tolist(), w.tolist()))
            held: list[set] = [set() for _ in range(len(starts) - 1)]
            for d, w in doc_window:
                held[d].update(items[w])
            hit = np.diff(np.cumsum(edge[:-1]) > 0, prepend=False, append=False)
            bounds = np.flatnonzero(hit).reshape(-1, 2)
            doc = np.searchsorted(starts, bounds[:, 0], "right") - 1
            own: list[list] = [[] for _ in held]
            for d, (a, b) in zip(doc.tolist(), (bounds - starts[doc][:, None]).tolist()):
                own[d].append({"start": a, "end": b})
            spans += own
            named += [sorted(h) for h in held]
            counts += (np.diff(starts) - 1).tolist()
        return pa.RecordBatch.from_arrays(
            [*batch.columns,
             pa.array(counts, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array(named, pa.list_(pa.string()))],
            [*batch.schema.names, "n_words", "spans", "items"])

    more = "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"
    return map_batches(rows, match, fields(rows, rows.columns, more))


def find_contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id",
                       text: str = "text", item_id: str = "item_id", item_text: str = "text",
                       carry: Sequence[str] = (), at_once: int = WINDOWS_AT_ONCE) -> DataFrame:
    """``id``, ``raw`` (text as UTF-8), ``carried``, ``n_words``, hit ``spans``, ``n_hit``, ``items``.

    Spans are maximal runs of hit words, by word number, their end excluded.
    """
    windows = staged(item_windows(items, item_id, item_text), "windows")
    parts = max(1, -(-windows.count() // at_once))
    part_of = F.pmod(F.xxhash64("window"), F.lit(parts))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("raw"),
                       carried(docs, carry).alias("carried"))
    if parts > 1:
        # Parts are put together again by the place of a row in a stored copy.
        rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "documents")
    found = [_matched(rows, windows.where(part_of == i)) for i in range(parts)]
    if parts > 1:
        pieces = reduce(DataFrame.unionByName,
                        [f.select("row", "n_words", "spans", "items") for f in found])
        joined = pieces.groupBy("row").agg(
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        merged = F.aggregate(F.array_sort("spans"), F.array().cast(
            "array<struct<start: bigint, end: bigint>>"), _merge_span)
        result = rows.join(joined.withColumn("spans", merged), "row").drop("row")
    else:
        result = found[0]
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return result.withColumn("n_hit", covered)


def _merge_span(done, span):
    """Sorted spans joined where they touch or overlap."""
    last = F.element_at(done, -1)
    joined = F.struct(last["start"].alias("start"),
                      F.greatest(last["end"], span["end"]).alias("end"))
    return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["start"]),
                  F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
                  ).otherwise(F.concat(done, F.array(span)))

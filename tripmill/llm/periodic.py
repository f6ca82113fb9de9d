"""Periodic runs of words: stretches in which a phrase repeats at once, several times over.

By a dictionary of basic factors (``factors.py``). For each power of two ``L``, two successive
occurrences of a factor of ``L`` words whose distance ``q`` is at most ``L`` lie in a window of
``2 L``; there the distance is the smallest period of the words they cover, and inside a run every
start has its successor at just that distance. So starts that follow one another with one distance
form an arithmetic progression, and each such stretch proposes a run, which is extended on both
sides while the words agree. A run of period ``q`` and four or more repeats is proposed at the first
``L`` not below ``q``, and again at greater ones; repeats of a proposal are dropped.

The work is ``n log n`` in the words of a text at worst and about three passes on prose. A text is
handled whole, inside one task; nothing is shuffled.

Defined cases: null or empty text has no words, no runs and an empty collapsed text; rows with equal
or null ids are handled singly; extra columns are only passed on when named in ``carry``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tripmill.llm.common import batch_of, carried, fields, map_batches
from tripmill.llm.factors import basic_factors, word_numbers

LEAST_WORDS = 6
LEAST_REPEATS = 4
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _proposals(length: int, starts: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of the progressions of one factor length."""
    order = np.argsort(names, kind="stable")
    at, name = starts[order], names[order]
    gap = np.diff(at)
    near = (name[1:] == name[:-1]) & (gap <= length)
    first, period = at[:-1][near], gap[near]
    if not len(first):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((first, period))
    first, period = first[order], period[order]
    breaks = np.flatnonzero((np.diff(first) != 1) | (np.diff(period) != 0)) + 1
    begin, end = np.r_[0, breaks], np.r_[breaks, len(first)] - 1
    return np.column_stack([first[begin], first[end] + period[end] + length, period[begin]])


def _extended(numbers: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Runs made as long as their period holds. Numbers of two texts are never equal."""
    start, end, period = (c.copy() for c in found.T)
    open_ = np.arange(len(start))
    while len(open_):
        open_ = open_[start[open_] > 0]
        open_ = open_[numbers[start[open_] - 1] == numbers[start[open_] - 1 + period[open_]]]
        start[open_] -= 1
    open_ = np.arange(len(start))
    while len(open_):
        open_ = open_[end[open_] < len(numbers)]
        open_ = open_[numbers[end[open_]] == numbers[end[open_] - period[open_]]]
        end[open_] += 1
    return np.column_stack([start, end, period])


def find_runs(numbers: np.ndarray, least_words: int = LEAST_WORDS,
              least_repeats: int = LEAST_REPEATS) -> np.ndarray:
    """Rows (start, end, period) of all maximal runs, by start, then period.

    ``least_repeats`` is at least three: below, the first factor length may overlook a run.
    """
    if least_repeats < 3:
        raise ValueError("runs of fewer than three repeats are not proposed")
    parts = [np.zeros((0, 3), np.int64)]
    for length, starts, names in basic_factors(numbers):
        found = _extended(numbers, _proposals(length, starts, names))
        size = found[:, 1] - found[:, 0]
        parts.append(found[size >= np.maximum(least_words, least_repeats * found[:, 2])])
    found = np.unique(np.concatenate(parts), axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS,
                  carry: Sequence[str] = ()) -> DataFrame:
    """``id``, ``n_words``, ``runs`` (start, length and period in words), ``collapsed``, ``carried``.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``collapsed`` is the text's words, joined by one space,
    without those that a run holds after its first period.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("raw"),
                       carried(docs, carry).alias("carried"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(raw or b"").split() for raw in batch.column(1).to_pylist()]
        numbers, _ = word_numbers(texts)
        ends = np.cumsum([len(w) for w in texts])
        begins = ends - [len(w) for w in texts]
        found = find_runs(numbers, least_words, least_repeats)
        depth = np.zeros(len(numbers) + 1, np.int64)
        np.add.at(depth, found[:, 0] + found[:, 2], 1)
        np.add.at(depth, found[:, 1], -1)
        dropped = np.cumsum(depth)[:-1] > 0
        owner = np.searchsorted(ends, found[:, 0], "right")
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        found[:, 1] -= found[:, 0]
        found[:, 0] -= begins[owner]
        collapsed = []
        for i, words in enumerate(texts):
            if cuts[i] < cuts[i + 1]:
                gone = dropped[begins[i]:ends[i]].tolist()
                words = [w for w, g in zip(words, gone) if not g]
            collapsed.append(b" ".join(words).decode())
        runs = pa.StructArray.from_arrays([pa.array(found[:, i]) for i in (0, 1, 2)],
                                          ["start", "length", "period"])
        return batch_of(id=batch.column(0), n_words=pa.array(ends - begins, pa.int64()),
                        runs=pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs),
                        collapsed=pa.array(collapsed, pa.string()), carried=batch.column(2))

    schema = fields(rows, ["id"], f"n_words bigint, runs array<{RUN}>, collapsed string")
    return map_batches(rows, run, schema.add(rows.schema["carried"]))


def strongest(runs: Column) -> Column:
    """The run that repeats most often, by the exact ratio of length to period; the first of equals.

    Null where there is no run.
    """
    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)
    return F.reduce(runs, F.lit(None).cast(RUN), better)


def run_lines(runs: Column) -> Column:
    """``start,length,period`` of every run, each followed by a line feed."""
    return F.concat_ws("", F.transform(runs, lambda r: F.concat_ws(
        "", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))

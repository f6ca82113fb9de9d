"""Toxicity as ordered severity: a cumulative-link model on sparse word features.

A document's features are its distinct words and their first ``PREFIXES`` letters. The model holds
one weight for each feature, shared by all grades, and ordered thresholds:
P(grade >= k) = logistic(score - threshold_k). It gives the expected severity, the sum of these
probabilities, and rejects a document whose P(grade >= 1) is at least ``REJECT``.

Labels are 0 or 1. The grade of a toxic document is 1 to ``GRADES``, by where its number of marked
words (words with a chosen feature) stands among the toxic training documents.

The fit uses a bounded sample of labelled documents: at most ``SAMPLE`` of each label, those with
the smallest hash of their id; equal texts count once. Features are chosen by their document
frequency in that sample (at least ``MIN_LOG_ODDS`` more likely in toxic documents), at most
``FEATURES``. The sample's texts stay on the executors; the driver fits on the chosen features only.
All documents are scored, as whole texts.

Defined cases: null text scores like a text without features; labels that are null count as absent,
of several labels the largest counts; without labels of both kinds no document is rejected and all
severities are 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripmill.llm.common import batch_of, carried, fields, map_batches, released, staged

PREFIXES = (4, 5, 6)
GRADES = 3
SAMPLE = 6_000
FEATURES = 20_000
MIN_LOG_ODDS = 3.0
MIN_DOCS = 3
MIN_SHARE = 0.002
PENALTY = 5e-4
STEPS = 800
REJECT = 0.5
CACHED_WORDS = 150_000

_OTHER = re.compile(r"[\W\d_]+")
_ASCII_OTHER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
                     for b in range(256))


def raw_words(text: bytes | None) -> set[bytes]:
    """Distinct runs of ASCII letters and non-ASCII characters."""
    return set((text or b"").translate(_ASCII_OTHER).split())


@lru_cache(maxsize=5_000)
def word_features(raw: bytes) -> tuple[str, ...]:
    """The word in lower case, without signs that are no letters, and its beginnings."""
    out: list[str] = []
    for word in _OTHER.split(raw.decode().lower()):
        if word:
            out.append(word)
            out += [word[:n] + "-" for n in PREFIXES if len(word) >= n]
    return tuple(out)


@dataclass
class Model:
    """Feature weights, and the thresholds of the grades 1 and up."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for each score and grade."""
        t = np.array(self.thresholds)
        return 1 / (1 + np.exp(np.clip(t[None, :] - scores[:, None], -500, 500)))


class Scorer:
    """Document scores; the sum of a word's weights is kept for words seen before."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}

    def word(self, raw: bytes) -> float:
        weights = self.model.weights
        value = sum(weights.get(f, 0.0) for f in word_features.__wrapped__(raw))
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        self.known[raw] = value
        return value

    def score(self, text: bytes | None) -> float:
        words = raw_words(text)
        known = self.known.get
        return sum([self.word(w) if (v := known(w)) is None else v for w in words])


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
            most: int) -> DataFrame:
    """``label`` and ``raw`` of the sampled documents."""
    known = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(doc_id).agg((F.max(label) > 0).cast("int").alias("label")))
    order = [F.xxhash64(F.col(doc_id).cast("string")), F.col(doc_id)]
    chosen = [known.where(F.col("label") == y).orderBy(*order).limit(most) for y in (0, 1)]
    ids = chosen[0].unionByName(chosen[1]).withColumnRenamed(doc_id, "chosen_id")
    # At most 2 * most ids, so they can be sent to all tasks.
    joined = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("raw")).join(
        F.broadcast(ids), F.col("id") == F.col("chosen_id"))
    return (joined.groupBy(F.sha2("raw", 256).alias("digest"))
            .agg(F.max("label").alias("label"), F.first("raw").alias("raw"))
            .select("label", "raw"))


def _choose(sample: DataFrame) -> tuple[dict[str, int], Counter]:
    """Numbers of the chosen features; documents of each label."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush():
            for label, counts in seen.items():
                yield batch_of(feature=pa.array(list(counts), pa.string()),
                               label=pa.array([label] * len(counts), pa.int32()),
                               n=pa.array(list(counts.values()), pa.int64()))
                counts.clear()
        for batch in batches:
            for label, raw in zip(*(c.to_pylist() for c in batch.columns)):
                seen[label].update({f for w in raw_words(raw) for f in word_features(w)})
                seen[label][""] += 1
            if sum(map(len, seen.values())) > CACHED_WORDS:
                yield from flush()
        yield from flush()

    counts = (sample.mapInArrow(released(count), "feature string, label int, n bigint").groupBy("feature")
              .agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
                   F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean")))
    counts = staged(counts, "features")
    total = counts.where("feature = ''").first()
    docs = Counter({1: total[1], 0: total[2]} if total else {})
    if not docs[0] or not docs[1]:
        return {}, docs
    odds = (F.log((F.col("toxic") + 0.5) / (docs[1] + 1))
            - F.log((F.col("clean") + 0.5) / (docs[0] + 1)))
    least = max(MIN_DOCS, int(MIN_SHARE * docs[1]))
    rows = (counts.where((F.col("feature") != "") & (F.col("toxic") >= least)
                         & (odds >= MIN_LOG_ODDS))
            .orderBy(F.desc("toxic"), "feature").limit(FEATURES).select("feature").collect())
    return {r[0]: i for i, r in enumerate(rows)}, docs


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", most: int = SAMPLE) -> Model:
    sample = staged(_sample(docs, labels, doc_id, text, label, most), "sample")
    number, seen = _choose(sample)
    if not number:
        return Model()
    sent = docs.sparkSession.sparkContext.broadcast(number)

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        known, found, marked = sent.value, [], []
        for raw in batch.column(1).to_pylist():
            per_word = [[known[f] for f in word_features(w) if f in known] for w in raw_words(raw)]
            found.append(sorted(n for fs in per_word for n in fs))
            marked.append(sum(map(bool, per_word)))
        return batch_of(label=batch.column(0), marked=pa.array(marked, pa.int32()),
                        found=pa.array(found, pa.list_(pa.int32())))

    rows = map_batches(sample, find, "label int, marked int, found array<int>").orderBy(
        "label", "marked", "found").collect()
    label_of = np.array([r[0] for r in rows])
    marked = np.array([r[1] for r in rows])
    toxic = np.sort(marked[label_of == 1])
    place = np.searchsorted(toxic, marked, "right") / len(toxic)
    grade = np.where(label_of == 1, 1 + np.minimum((place * GRADES).astype(int), GRADES - 1), 0)
    return fit_cumulative([r[2] for r in rows], grade, list(number))


def fit_cumulative(found: Sequence[Sequence[int]], grade: np.ndarray, names: list[str],
                   steps: int = STEPS, penalty: float = PENALTY) -> Model:
    """Maximum likelihood with squared penalty, by gradient steps with momentum (Adam).

    Thresholds stay ordered: each is the one before plus the exponential of a parameter.
    """
    size = np.array([len(f) for f in found])
    row = np.repeat(np.arange(len(found)), size)
    column = np.array([n for f in found for n in f], np.int64)
    top = int(grade.max())
    p = np.zeros(len(names) + top)
    p[len(names)] = 2.0
    first, second = np.zeros_like(p), np.zeros_like(p)
    beyond = grade[:, None] >= np.arange(1, top + 1)[None, :]
    for step in range(1, steps + 1):
        w, gaps = p[:len(names)], np.exp(p[len(names) + 1:])
        t = p[len(names)] + np.concatenate([[0.0], np.cumsum(gaps)])
        x = np.bincount(row, w[column], len(found))
        up = 1 / (1 + np.exp(np.clip(t[None, :] - x[:, None], -50, 50)))  # P(grade >= k)
        own_low = np.where(grade > 0, up[np.arange(len(x)), np.maximum(grade, 1) - 1], 1.0)
        own_high = np.where(grade < top, up[np.arange(len(x)), np.minimum(grade, top - 1)], 0.0)
        share = np.maximum(own_low - own_high, 1e-12)
        slope = up * (1 - up)
        by_t = np.zeros_like(up)
        at = np.flatnonzero(grade > 0)
        by_t[at, grade[at] - 1] += slope[at, grade[at] - 1] / share[at]
        at = np.flatnonzero(grade < top)
        by_t[at, grade[at]] -= slope[at, grade[at]] / share[at]
        grad_t = by_t.sum(axis=0) / len(x)
        grad_w = -np.bincount(column, by_t.sum(axis=1)[row], len(names)) / len(x) + penalty * w
        later = np.cumsum(grad_t[::-1])[::-1]
        grad = np.concatenate([grad_w, [later[0]], later[1:] * gaps])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        p -= 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    # Weights are whole 1/1024ths, so that sums do not depend on the order of words.
    weights = np.round(p[:len(names)] * 1024) / 1024
    gaps = np.exp(p[len(names) + 1:])
    return Model(dict(zip(names, weights.tolist())),
                 (p[len(names)] + np.concatenate([[0.0], np.cumsum(gaps)])).tolist())


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
            carry: Sequence[str] = (), reject: float = REJECT) -> DataFrame:
    """``id``, expected ``severity``, most likely ``grade``, ``toxic`` (rejected) and ``carried``."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("raw"),
                       carried(docs, carry).alias("carried"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scorers: list[Scorer] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not scorers:
            scorers.append(Scorer(sent.value))
        model = sent.value
        scores = np.array([scorers[0].score(t) for t in batch.column(1).to_pylist()])
        up = model.probabilities(scores)
        each = np.column_stack([np.ones(len(up)), up]) - np.column_stack([up, np.zeros(len(up))])
        toxic = up[:, 0] >= reject if up.shape[1] else np.zeros(len(up), bool)
        return batch_of(id=batch.column(0), severity=up.sum(axis=1),
                        grade=each.argmax(axis=1).astype(np.int32), toxic=toxic,
                        carried=batch.column(2))

    schema = fields(rows, ["id"], "severity double, grade int, toxic boolean")
    return map_batches(rows, run, schema.add(rows.schema["carried"]))

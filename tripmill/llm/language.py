"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of ``ORDER`` letters over the lower-case text, in which every run of
other characters is one blank. The highest order uses counts, the lower ones the number of distinct
letters seen before, each with its own discount. All languages share sorted arrays of n-gram keys
with one row of log-probabilities each, already interpolated; n-grams no language has seen back off
through arrays of context weights.

A text goes to the language with the lowest cross-entropy per letter. It is also marked as rejected
if that entropy is above the language's ``QUANTILE`` over training documents. The score is the best
language's share when entropies are turned into weights of 2 ** (-SHARPNESS * bits).

Counts cover all training documents and none is left out. They are summed up in tasks and then by
Spark. Up to ``ENTRIES`` rows the driver builds the arrays and sends them; beyond that Spark builds
the same levels as tables in the shared folder, and tasks read through these in small batches for
the distinct n-grams of ``KEYS_AT_ONCE`` letters of text at a time. Rejection is calibrated on all
training documents of a language, its quantile at most 1 / ``RANKS`` of them off.

Defined cases: text that is null or has no letter is ``und`` with score 0 and is not rejected; so
is every text when nothing was learned; of equal entropies the first language in order wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import Column, DataFrame, functions as F

from tripmill.llm.common import batch_of, released, staged
from tripmill.llm.token_files import open_folder
from tripmill.session import workspace

ORDER = 4
LETTER_BITS = 16
ENTRIES = 2_000_000
RANKS = 100_000
QUANTILE = 0.995
SHARPNESS = 4.0
KEYS_AT_ONCE = 1 << 22
ROWS_AT_ONCE = 1 << 16
UNKNOWN = "und"

_LETTER_MASK = np.uint64((1 << LETTER_BITS) - 1)
_IS_LETTER = np.zeros(1 << LETTER_BITS, bool)


def _letters() -> np.ndarray:
    if not _IS_LETTER.any():
        _IS_LETTER[:] = [chr(c).isalpha() for c in range(1 << LETTER_BITS)]
    return _IS_LETTER


def ngram_keys(text: str | None) -> np.ndarray:
    """Keys of all n-grams of ``ORDER``, letters packed from high to low; empty without letters.

    Letters beyond the first plane share one number.
    """
    none = np.zeros(0, np.uint64)
    if not text:
        return none
    code = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    far = code > 0xFFFF
    if far.any():
        code = code.copy()
        code[far] = [0xFFFF if chr(c).isalpha() else 0 for c in code[far].tolist()]
        letter = _letters()[code] | (code == 0xFFFF)
    else:
        letter = _letters()[code]
    if not letter.any():
        return none
    code = np.where(letter, code, 0).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code = np.concatenate([np.zeros(ORDER - 1, np.uint64), code[keep]])
    n = len(code) - ORDER + 1
    key = np.zeros(n, np.uint64)
    for i in range(ORDER):
        key = (key << np.uint64(LETTER_BITS)) | code[i:i + n]
    return key


def count_ngrams(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """``lang``, ``key`` (as a signed number) and ``n`` over all documents with both columns."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        size = 0

        def gather():
            for name, keys in waiting.items():
                held.setdefault(name, []).append(
                    np.unique(np.concatenate(keys), return_counts=True))
            waiting.clear()

        for batch in batches:
            for name, value in zip(*(c.to_pylist() for c in batch.columns)):
                keys = ngram_keys(value)
                waiting.setdefault(name, []).append(keys)
                size += len(keys)
                if size > KEYS_AT_ONCE:
                    gather()
                    size = 0
        gather()
        for name, parts in held.items():
            key, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.bincount(at, np.concatenate([c for _, c in parts]), len(key)).astype(np.int64)
            yield batch_of(lang=pa.array([name] * len(key), pa.string()),
                           key=key.view(np.int64), n=n)
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    return (rows.mapInArrow(released(count), "lang string, key bigint, n bigint")
            .groupBy("lang", "key").agg(F.sum("n").alias("n")))


@dataclass
class Level:
    """N-grams of one order and their contexts, sorted, with a row of log2 values for each."""

    keys: np.ndarray
    prob: np.ndarray
    contexts: np.ndarray
    backoff: np.ndarray


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


class Model:
    """Languages, the levels from the highest order down, and the floor below single letters."""

    def __init__(self, languages: list[str], levels: list[Level], floor: np.ndarray) -> None:
        self.languages, self.levels, self.floor = languages, levels, floor
        self.limits = np.full(len(languages), np.inf)

    def entropies(self, keys: np.ndarray) -> np.ndarray:
        """Mean bits per letter for each language."""
        total, weight = np.zeros(len(self.languages)), np.zeros((len(keys), len(self.languages)))
        rest, carry = keys, None
        for order, level in zip(range(ORDER, 0, -1), self.levels):
            rest = rest & np.uint64((1 << (LETTER_BITS * order)) - 1)
            at, hit = _find(level.keys, rest)
            total += level.prob[at[hit]].sum(axis=0, dtype=np.float64)
            if carry is not None:
                total += carry[hit].sum(axis=0, dtype=np.float64)
            if hit.all():
                return -total / len(keys)
            rest = rest[~hit]
            carry = np.zeros((len(rest), len(total))) if carry is None else carry[~hit]
            if order > 1:
                at, known = _find(level.contexts, rest >> np.uint64(LETTER_BITS))
                carry[known] += level.backoff[at[known]]
        total += carry.sum(axis=0) + len(rest) * self.floor
        return -total / len(keys)

    def predict(self, text: str | None) -> tuple[str, float, float | None, bool]:
        """Language, score, bits per letter, and whether the text is rejected."""
        keys = ngram_keys(text)
        if not len(keys) or not self.languages:
            return UNKNOWN, 0.0, None, False
        return self.verdict(self.entropies(keys))

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        return [self.predict(t) for t in texts]

    def verdict(self, bits: np.ndarray) -> tuple[str, float, float, bool]:
        best = int(bits.argmin())
        score = 1 / np.exp2(np.maximum(SHARPNESS * (bits[best] - bits), -1000)).sum()
        return (self.languages[best], float(score), float(bits[best]),
                bool(bits[best] > self.limits[best]))


@dataclass
class Stored:
    """A table in the shared folder: a key and a probability for each language."""

    path: str
    width: int

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A row of log2 values for each key, zeros where there is none, and which there are."""
        keys, back = np.unique(wanted, return_inverse=True)
        values, hit = np.zeros((len(keys), self.width), np.float32), np.zeros(len(keys), bool)
        files, path = open_folder(self.path)
        for batch in ds.dataset(path, filesystem=files, format="parquet").to_batches(
                columns=["key", "row"], batch_size=ROWS_AT_ONCE, batch_readahead=1,
                fragment_readahead=1, use_threads=False):
            at, there = _find(keys, batch.column(0).to_numpy().view(np.uint64))
            rows = batch.column(1).flatten().to_numpy().reshape(-1, self.width)
            values[at[there]] = np.log2(np.maximum(rows[there], 1e-12))
            hit[at[there]] = True
        return values[back], hit[back]


class StoredModel(Model):
    """The same model with levels of any size, which stay in the shared folder."""

    def __init__(self, languages: list[str], levels: list[tuple[Stored, Stored]],
                 floor: np.ndarray) -> None:
        super().__init__(languages, [], floor)
        self.stored = levels

    def letters(self, keys: np.ndarray) -> np.ndarray:
        """log2 of the probability of each key's last letter, for each language."""
        out, left = np.zeros((len(keys), len(self.languages))), np.arange(len(keys))
        for order, (level, contexts) in zip(range(ORDER, 0, -1), self.stored):
            rest = keys[left] & np.uint64((1 << (LETTER_BITS * order)) - 1)
            values, hit = level.find(rest)
            out[left] += values
            rest, left = rest[~hit], left[~hit]
            if not len(left):
                return out
            if order > 1:
                out[left] += contexts.find(rest >> np.uint64(LETTER_BITS))[0]
        out[left] += self.floor
        return out

    def predict(self, text: str | None) -> tuple[str, float, float | None, bool]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        every = [ngram_keys(t) for t in texts]
        sizes = np.array([len(k) for k in every], np.int64)
        if not sizes.sum():
            return [(UNKNOWN, 0.0, None, False)] * len(texts)
        keys, back = np.unique(np.concatenate(every), return_inverse=True)
        value, ends = self.letters(keys), np.cumsum(sizes)
        return [self.verdict(-value[back[end - n:end]].mean(axis=0)) if n
                else (UNKNOWN, 0.0, None, False) for n, end in zip(sizes.tolist(), ends.tolist())]


def store(counts: DataFrame, languages: list[str]) -> StoredModel:
    """The model of ``build`` from ``lang``, ``key`` and ``n``, by joins and aggregates."""
    spark, width = counts.sparkSession, len(languages)
    names = spark.createDataFrame(list(enumerate(languages)), "i int, name string")
    places = F.array(*[F.lit(i) for i in range(width)])
    orders = [counts.join(F.broadcast(names), F.col("lang") == F.col("name"))
              .select("i", "key", F.col("n").cast("double").alias("n"))]
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("key").bitwiseAND(F.lit((1 << (LETTER_BITS * order)) - 1))
        orders.append(staged(orders[-1].groupBy("i", suffix.alias("key")).agg(
            F.count("*").cast("double").alias("n")), "orders"))

    def dense(rows: DataFrame, key: str, missing: dict[str, float]) -> DataFrame:
        """An array over the languages for each key."""
        maps = rows.groupBy(key).agg(*[F.map_from_entries(F.collect_list(F.struct("i", c))).alias(c)
                                       for c in missing])

        def each(name: str) -> Column:
            return F.transform(places, lambda i: F.coalesce(F.element_at(name, i),
                                                            F.lit(missing[name])))
        return maps.select(key, *[each(c).alias(c) for c in missing])

    def kept(rows: DataFrame) -> tuple[Stored, DataFrame]:
        path = workspace(spark, "level")
        rows.write.parquet(path)
        return Stored(path, width), spark.read.schema(rows.schema).parquet(path)

    levels, lower = [], None
    for order, rows in zip(range(1, ORDER + 1), reversed(orders)):
        few = {r[0]: r[1:] for r in rows.groupBy("i").agg(
            F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).collect()}
        discount = F.array(*[F.lit(float(one / (one + 2 * two) if one else 0.5))
                             for one, two in (few[i] for i in range(width))])
        context = F.shiftrightunsigned("key", LETTER_BITS)
        groups = rows.groupBy("i", context.alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds")).withColumn(
            "share", F.get(discount, F.col("i")) * F.col("kinds") / F.col("total"))
        groups = staged(dense(groups, "context", {"total": 1.0, "share": 1.0}), "contexts")
        found = dense(rows, "key", {"n": 0.0}).withColumn("context", context)
        if lower is None:
            n = found.count()
            floor = np.array(groups.first()["share"]) / (n + 1)
            found = found.withColumn("below", F.array(*[F.lit(1 / (n + 1))] * width))
        else:
            suffix = F.col("key").bitwiseAND(F.lit((1 << (LETTER_BITS * (order - 1))) - 1))
            found = found.join(lower.select(F.col("key").alias("suffix"), F.col("row").alias(
                "below")), suffix == F.col("suffix"))
        prob, lower = kept(found.join(groups, "context").select("key", F.transform(
            places, lambda i: F.greatest(F.get("n", i) - F.get(discount, i), F.lit(0.0))
            / F.get("total", i) + F.get("share", i) * F.get("below", i)).alias("row")))
        levels.append((prob, kept(groups.select(
            F.col("context").alias("key"), F.col("share").alias("row")))[0]))
    return StoredModel(languages, levels[::-1], np.log2(np.maximum(floor, 1e-12)))


def build(languages: list[str], rows: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """Model from each language's n-gram keys and counts."""
    keys = np.unique(np.concatenate([k for k, _ in rows]))
    counts = np.zeros((len(keys), len(rows)))
    for i, (k, n) in enumerate(rows):
        counts[np.searchsorted(keys, k), i] = n
    orders = [(keys, counts)]
    for order in range(ORDER - 1, 0, -1):
        shorter = orders[-1][0] & np.uint64((1 << (LETTER_BITS * order)) - 1)
        keys, at = np.unique(shorter, return_inverse=True)
        before = np.zeros((len(keys), len(rows)))
        for i in range(len(rows)):
            before[:, i] = np.bincount(at, orders[-1][1][:, i] > 0, len(keys))
        orders.append((keys, before))

    lower = None
    levels: list[Level] = []
    for order, (keys, counts) in zip(range(1, ORDER + 1), reversed(orders)):
        once, twice = (counts == 1).sum(axis=0), (counts == 2).sum(axis=0)
        discount = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
        contexts, at = np.unique(keys >> np.uint64(LETTER_BITS), return_inverse=True)
        total, kinds = (np.stack([np.bincount(at, c, len(contexts)) for c in m.T], axis=1)
                        for m in (counts, counts > 0))
        seen = total > 0
        share = np.where(seen, discount * kinds / np.where(seen, total, 1), 1.0)
        if lower is None:
            floor = share[0] / (len(keys) + 1)
            below = np.broadcast_to(1 / (len(keys) + 1), counts.shape)
        else:
            suffix = keys & np.uint64((1 << (LETTER_BITS * (order - 1))) - 1)
            below = lower[1][np.searchsorted(lower[0], suffix)]
        own = np.maximum(counts - discount, 0) / np.where(seen, total, 1)[at]
        prob = own + share[at] * below
        lower = keys, prob
        levels.append(Level(keys, np.log2(prob).astype(np.float32), contexts,
                            np.log2(np.maximum(share, 1e-12)).astype(np.float32)))
    return Model(languages, levels[::-1], np.log2(np.maximum(floor, 1e-12)))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        entries: int = ENTRIES) -> Model:
    """Model of the languages of labelled documents."""
    counts = staged(count_ngrams(docs, lang, text), "ngrams")
    if counts.count() > entries:
        languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
        model: Model = store(counts, languages)
    else:
        rows = counts.toPandas()
        if not len(rows):
            return Model([], [], np.zeros(0))
        languages = sorted(rows["lang"].unique())
        model = build(languages, [
            (own["key"].to_numpy().view(np.uint64), own["n"].to_numpy())
            for own in (rows[rows["lang"] == name].sort_values("key") for name in languages)])
    known = docs.where(F.col(lang).isNotNull())
    limits = (predict(known, model, doc_id, text, F.col(lang)).where("lang = label")
              .groupBy("lang").agg(F.percentile_approx("bits", F.lit(QUANTILE), F.lit(RANKS))
                                   .alias("limit")).collect())
    for name, limit in limits:
        if limit is not None:
            model.limits[languages.index(name)] = limit
    return model


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
            label: Column | None = None) -> DataFrame:
    """``id``, ``lang``, ``score``, ``bits``, ``rejected`` and, if given, ``label`` unchanged."""
    label = F.lit(None).cast("string") if label is None else label
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), label.alias("label"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [t for batch in batches for t in batch.column(1).to_pylist()]
        found = iter(sent.value.predict_all(texts))
        for batch in batches:
            own = [next(found) for _ in range(batch.num_rows)]
            lang, score, bits, rejected = zip(*own) if own else ((), (), (), ())
            yield batch_of(id=batch.column(0), lang=pa.array(lang, pa.string()),
                           score=pa.array(score, pa.float64()), bits=pa.array(bits, pa.float64()),
                           rejected=pa.array(rejected, pa.bool_()), label=batch.column(2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(1).nbytes
            # A model that is held needs no more than one batch; a stored one is read through once.
            if size > KEYS_AT_ONCE or not isinstance(sent.value, StoredModel):
                yield from judged(held)
                held, size = [], 0
        if held:
            yield from judged(held)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(released(run), f"id {kind}, lang string, score double, bits double, "
                                "rejected boolean, label string")

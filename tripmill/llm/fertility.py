"""Quality rules by tokeniser fertility: how public vocabularies cut a text into tokens.

Three measures of a text's tokens tell odd text from the prose of its language:

* characters per token of a byte-level vocabulary made for many languages;
* the share of byte tokens, by which a piece vocabulary falls back on letters it has no piece for;
* evenness, the entropy of the piece tokens over the greatest entropy of as many tokens.

Each word is encoded alone, as it would be behind a space, so the measures follow from the distinct
words of a text and their counts; words of over ``WORD_CHARS`` characters are encoded in parts.

Bands come from the corpus. Per language (where that is null: per script of most letters) and per
power of two of the number of tokens, the quartiles of each measure are taken over all documents,
each distinct set of measures counted once, so that copies weigh nothing. A band reaches ``REACH``
times the distance from the median to a quartile beyond that quartile, the distance being at least
the measure's least spread. Odd texts of less than a quarter of a cell do not move its bands. Few
characters per token, a large byte share, and tokens too even or too uneven reject. Cells of fewer
than ``LEAST_TEXTS`` distinct texts use the band of their language, and if that has fewer too, of
their size in all languages, and at last of all texts.

Defined cases: null and empty text has no words; a text without tokens lies in every band, and its
measures are null; ties and copies get the same verdict; lone null ids are passed on. Texts are
handled whole.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, functions as F

from tripmill.llm.common import batch_of, carried, fields, map_batches, staged
from tripmill.llm.factors import basic_factors, word_numbers

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # percent of words

MARK = "▁"
WORD_CHARS = 64
WORDS_AT_ONCE = 256
CACHED_WORDS = 400_000
CACHED_BYTES = 48

LEAST_TEXTS = 50
REACH = 5.0
PERCENTILES = (0.25, 0.5, 0.75)
# Per measure: places after which it is rounded for the percentiles, least spread, whether a low
# and whether a high value speaks against a text.
MEASURES = {"chars_per_token": (3, 0.04, True, False),
            "byte_share": (3, 0.01, False, True),
            "evenness": (3, 0.04, True, True)}

# First code points of the blocks in which scripts differ; a script holds up to the next one.
SCRIPTS = [(0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
           (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Indic"),
           (0x0E00, "Thai"), (0x0E80, "other"), (0x10A0, "Georgian"), (0x1100, "Hangul"),
           (0x1200, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"),
           (0x2C60, "Latin"), (0x2C80, "other"), (0x3040, "Kana"), (0x3100, "Han"),
           (0xA000, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"), (0xF900, "Han"),
           (0xFB00, "other"), (0x20000, "Han"), (0x32000, "other")]
_STARTS = np.array([s for s, _ in SCRIPTS])


def script_of(text: str) -> str | None:
    """The script of most letters; the alphabetically first of equals, null without a letter."""
    if text.isascii():
        return "Latin" if any(map(str.isalpha, text)) else None
    letters = "".join(filter(str.isalpha, text))
    points = np.frombuffer(letters.encode("utf-32-le"), np.uint32)
    found = np.bincount(np.searchsorted(_STARTS, points, "right") - 1, minlength=len(SCRIPTS))
    totals: dict[str, int] = {}
    for (_, name), n in zip(SCRIPTS, found.tolist()):
        totals[name] = totals.get(name, 0) + n
    return min(totals, key=lambda s: (-totals[s], s)) if len(points) else None


class Vocabularies:
    """A piece model with byte fallback and a byte-level rank file; encodes words behind a space.

    Neither lets a token reach over a space, so words without white space of their own are encoded
    many at once and cut where a token begins with the space.
    """

    def __init__(self, pieces: str, ranks: str, pattern: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.opens = np.array([self.model.id_to_piece(i).startswith(MARK)
                               for i in range(self.size)])
        with open(ranks, "rb") as lines:
            pairs = dict(line.split() for line in lines if line.strip())
        table = {base64.b64decode(k): int(v) for k, v in pairs.items()}
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={},
                                       mergeable_ranks=table)
        self.ranks_open = np.zeros(max(table.values()) + 1, bool)
        self.ranks_open[[v for k, v in table.items() if k.startswith(b" ")]] = True
        # Of each word, as 32-bit integers in bytes: its number of rank tokens, then its piece ids.
        self.known: dict[bytes, bytes] = {}

    def _one(self, word: str) -> bytes:
        parts = [word[i:i + WORD_CHARS] for i in range(0, len(word), WORD_CHARS)]
        count = sum(len(self.ranks.encode_ordinary(" " + p)) for p in parts)
        ids = [i for own in self.model.encode(parts, num_threads=1) for i in own]
        return np.array([count, *ids], np.int32).tobytes()

    def _each(self, words: list[str]) -> list[bytes]:
        text = " ".join(words)
        ids = np.array(self.model.encode(text), np.int32)
        ranked = np.array(self.ranks.encode_ordinary(" " + text), np.int64)
        cuts = np.flatnonzero(self.opens[ids])
        counts = np.diff(np.r_[np.flatnonzero(self.ranks_open[ranked]), len(ranked)])
        if len(cuts) != len(words) or len(counts) != len(words):
            raise ValueError("a token reaches over a space")
        raw = np.insert(ids, cuts, counts).astype(np.int32).tobytes()
        ends = (4 * np.r_[cuts + np.arange(len(cuts)), len(ids) + len(cuts)]).tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Words with marks, white space beyond ASCII or many letters are encoded singly."""
        found, plain, keys = {}, [], []
        for key in words:
            word = key.decode()
            if len(word) <= WORD_CHARS and word.isprintable() and MARK not in word:
                plain.append(word)
                keys.append(key)
            else:
                found[key] = self._one(word)
        for at in range(0, len(plain), WORDS_AT_ONCE):
            found.update(zip(keys[at:at + WORDS_AT_ONCE],
                             self._each(plain[at:at + WORDS_AT_ONCE])))
        return found

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece ids of all words, how many each has, and the number of rank tokens of each."""
        found = list(map(self.known.get, words))
        if None in found:
            new = self._encoded(list({w for w, f in zip(words, found) if f is None}))
            found = [new[w] if f is None else f for w, f in zip(words, found)]
            if len(self.known) > CACHED_WORDS:
                self.known = {}
            self.known.update((w, f) for w, f in new.items() if len(w) <= CACHED_BYTES)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.int32)
        heads = np.cumsum(sizes) - sizes
        return np.delete(flat, heads), sizes - 1, flat[heads].astype(np.int64)


@lru_cache(maxsize=2)
def vocabularies(pieces: str, ranks: str, pattern: str) -> Vocabularies:
    return Vocabularies(pieces, ranks, pattern)


def _repeated_words(numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each text, its words inside windows that occur in it twice or more."""
    cover = np.zeros(len(numbers) + 1, np.int64)
    for length, starts, _ in basic_factors(numbers):
        if length == WINDOW:
            cover[starts] += 1
            np.subtract.at(cover, starts + WINDOW, 1)
            break
    total = np.cumsum(np.cumsum(cover)[:-1] > 0)
    return np.diff(np.r_[0, total][np.r_[0, ends]])


def _duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def _token_measures(found: list[dict], counts: np.ndarray, word_chars: np.ndarray,
                    vocabulary: Vocabularies) -> tuple[np.ndarray, ...]:
    """Number of piece tokens and the three measures of each text; NaN without tokens."""
    texts = len(found)
    owner = np.repeat(np.arange(texts), [len(d) for d in found])
    ids, sizes, ranked = vocabulary([w for d in found for w in d])
    weight = np.repeat(counts, sizes)
    of_token = np.repeat(owner, sizes)
    keys, distinct = pd.factorize(of_token * vocabulary.size + ids)
    times = np.bincount(keys, weight, len(distinct))
    n = np.bincount(of_token, weight, texts)
    in_bytes = np.bincount(of_token, weight * vocabulary.is_byte[ids], texts)
    logs = np.bincount(distinct // vocabulary.size, times * np.log2(np.maximum(times, 1)), texts)
    with np.errstate(divide="ignore", invalid="ignore"):
        greatest = np.log2(np.minimum(n, vocabulary.size))
        even = np.where(n > 1, (np.log2(n) - logs / n) / greatest, 1.0)
        return (n.astype(np.int64), word_chars / np.bincount(owner, counts * ranked, texts),
                in_bytes / n, np.where(n > 0, even, np.nan))


MEASURED = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
            "n_repeat_words bigint, script string, n_tokens bigint, chars_per_token double, "
            "byte_share double, evenness double")


def measure(docs: DataFrame, pieces: str, ranks: str, pattern: str, doc_id: str = "doc_id",
            text: str = "text", lang: str = "lang", carry: Sequence[str] = ()) -> DataFrame:
    """``id``, ``lang``, counts of words, symbols and repeats, script and token measures."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"),
                       F.col(text).alias("text"), carried(docs, carry).alias("carried"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(2).to_pylist()]
        words = [t.encode().split() for t in texts]
        ends = np.cumsum([len(w) for w in words])
        numbers, found = word_numbers(words)
        del words
        blanks = [sum(map(t.count, BLANKS)) for t in texts]
        chars = np.array([len(t) for t in texts]) - blanks
        tokens, *measures = _token_measures(
            found, np.bincount(numbers), chars, vocabularies(pieces, ranks, pattern))
        return batch_of(
            id=batch.column(0), lang=batch.column(1), n_words=np.diff(np.r_[0, ends]),
            word_chars=chars, n_symbols=np.array([sum(map(t.count, SYMBOLS)) for t in texts]),
            n_dup_lines=np.array([_duplicate_lines(t) for t in texts]),
            n_repeat_words=_repeated_words(numbers, ends),
            script=pa.array([script_of(t) for t in texts], pa.string()), n_tokens=tokens,
            **{name: pa.array(v, pa.float64(), from_pandas=True)
               for name, v in zip(MEASURES, measures)},
            carried=batch.column(3))

    schema = fields(rows, ["id", "lang"], MEASURED).add(rows.schema["carried"])
    return map_batches(rows, run, schema)


def _cell(measured: DataFrame) -> DataFrame:
    """The rows with ``kind``, language or else script, and ``size``, the power of two of tokens."""
    kind = F.coalesce(F.concat(F.lit("lang "), F.col("lang").cast("string")),
                      F.concat(F.lit("script "), F.col("script")), F.lit("none"))
    return measured.withColumn("kind", kind).withColumn(
        "size", F.when(F.col("n_tokens") > 0, F.floor(F.log2("n_tokens"))).cast("int"))


def bands(measured: DataFrame, reach: float = REACH, least: int = LEAST_TEXTS) -> DataFrame:
    """``kind``, ``size`` and, per measure, the ``_low`` and ``_high`` end of its band."""
    distinct = (_cell(measured).where("n_tokens > 0")
                .select("kind", "size", "n_tokens", *MEASURES).distinct())
    for name, (places, *_) in MEASURES.items():
        distinct = distinct.withColumn(name, F.round(name, places))
    # Rounded measures have few values, so exact percentiles stay small.
    grouped = distinct.groupingSets([["kind", "size"], ["kind"], ["size"], []], "kind", "size")
    found = staged(grouped.agg(
        F.grouping_id().alias("level"), F.count("*").alias("n"),
        *[F.percentile(m, F.array(*map(F.lit, PERCENTILES))).alias(m) for m in MEASURES]), "bands")
    ends = []
    for name, (_, spread, _, _) in MEASURES.items():
        low, mid, high = (F.col(name)[i] for i in range(3))
        ends += [(low - reach * F.greatest(mid - low, F.lit(spread))).alias(f"{name}_low"),
                 (high + reach * F.greatest(high - mid, F.lit(spread))).alias(f"{name}_high")]
    found = found.select("level", "kind", "size", "n", *ends)
    names = [f"{m}_{e}" for m in MEASURES for e in ("low", "high")]

    def level(number: int) -> DataFrame:
        of = found.where(F.col("level") == number)
        return of.select("kind", "size", "n", F.struct(*names).alias("band"))
    every = level(3).select(F.col("band").alias("every"))
    kinds = level(1).where(F.col("n") >= least).select("kind", F.col("band").alias("of_kind"))
    sizes = level(2).where(F.col("n") >= least).select("size", F.col("band").alias("of_size"))
    # ``every`` has one row, or none if there is no text at all.
    cells = level(0).join(kinds, "kind", "left").join(sizes, "size", "left").join(every)
    own = F.when(F.col("n") >= least, F.col("band"))
    return cells.select("kind", "size", F.coalesce(own, "of_kind", "of_size", "every").alias("b")
                        ).select("kind", "size", "b.*")


def base_failed() -> Column:
    """Too few words, or too many of them inside repeated windows."""
    return ((F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """The rows with ``base_failed``, ``odd`` (measures outside their band) and ``kept``."""
    joined = _cell(measured).join(limits, ["kind", "size"], "left")
    odd = []
    for name, (_, _, low, high) in MEASURES.items():
        out = F.lit(False)
        if low:
            out |= F.col(name) < F.col(f"{name}_low")
        if high:
            out |= F.col(name) > F.col(f"{name}_high")
        odd.append(F.when(out, F.lit(name)))
    judged = joined.withColumn("odd", F.array_compact(F.array(*odd))).withColumn(
        "base_failed", base_failed())
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("odd") == 0))
    return judged.select(*measured.columns, "base_failed", "odd", "kept")


def quality(docs: DataFrame, pieces: str, ranks: str, pattern: str, doc_id: str = "doc_id",
            text: str = "text", lang: str = "lang", carry: Sequence[str] = ()) -> DataFrame:
    """Measures and verdict of every document; tokens are counted once and stored."""
    measured = staged(measure(docs, pieces, ranks, pattern, doc_id, text, lang, carry), "measured")
    return judge(measured, bands(measured))

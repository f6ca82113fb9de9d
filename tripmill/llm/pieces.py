"""SentencePiece merge-type encoding by a table of last tokens, and decoding.

The encoding of every prefix of a text ends in one definite token. It is found from left to right:
an automaton reports the pieces that end at a place, and the piece is the right one if it is
compatible with the last token of the prefix before it, that is if merging the two pieces' letters
gives back just these two. Ids are then read off backwards. The work is linear in the text.

No piece of the model holds a space mark after another letter, so a text falls apart before each
run of spaces, and words seen before keep their ids. Letters without a piece become byte pieces.
Defined cases: null text counts as empty and has no ids; ids without a piece decode as the
library's unknown mark, control ids as nothing.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from tripmill.llm.common import batch_of, carried, fields, in_slices, map_batches

MARK = "▁"
UNKNOWN_TEXT = " ⁇ "
CACHED_WORDS = 120_000  # in two generations of half as many
CACHED_PAIRS = 240_000
CACHED_CHARS = 48
IDS_AT_ONCE = 1 << 20

_SPACED = re.compile(" +[^ ]*")


class Pieces:
    """Vocabulary of a model and its prefix-table encoder."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece: list[str] = []
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.byte_ids = [0] * 256
        self.surface: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.piece.append(piece)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif model.is_control(i):
                self.surface.append(b"")
            elif model.is_unknown(i):
                self.surface.append(UNKNOWN_TEXT.encode())
            else:
                self.score[piece], self.id_of[piece] = model.get_score(i), i
                self.surface.append(piece.replace(MARK, " ").encode())
                if MARK in piece.lstrip(MARK):
                    raise ValueError("a piece holds a space mark behind a letter")
        self.ends = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            self.ends.add_word(piece, i)
        self.ends.make_automaton()
        self.sizes = list(map(len, self.piece))
        self.halves: dict[str, tuple[str, str] | None] = {}
        # Whether a pair of ids stays; the pair is one number. Where nothing stands before, the
        # first id is the number of pieces, and above that for a letter without a piece.
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Merge letters, best score first and leftmost of equals; also the last pair merged."""
        parts, last = list(text), None
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts, last
            last = parts[at], parts[at + 1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge gave this one; None for a single letter."""
        if piece not in self.halves:
            parts, last = self.merged(piece)
            self.halves[piece] = last if len(parts) == 1 else (piece, "")
        return self.halves[piece]

    def compatible(self, before: int, piece: int) -> bool:
        """Whether two pieces, by id, stay as they are next to each other; kept for the next time."""
        if len(self.fits) >= CACHED_PAIRS:
            self.fits.clear()
        many = len(self.piece)
        left = self.piece[before] if before < many else chr(before - many - 1) if before > many else ""
        fits = self.fits[before * many + piece] = self._stay(left, self.piece[piece])
        return fits

    def _stay(self, left: str, right: str) -> bool:
        """Undo the merges of both pieces, latest first, and look for one across the border.

        A merge across the border wins if it scores better than the merges that follow it: those
        of the left piece stand before it and win a tie, those of the right piece lose it.
        """
        halves = self.split(left) if left else None, self.split(right)
        if halves[0] == (left, "") or halves[1] == (right, ""):
            return False  # the letters of one do not even merge to it alone
        if not left:
            return True
        if left[-2:] == MARK * 2 or right[:2] == MARK * 2:
            return self.merged(left + right)[0] == [left, right]  # runs of spaces score alike
        bound, or_equal = -float("inf"), False
        while True:
            across = self.score.get(left + right)
            if across is not None and (across > bound or or_equal and across == bound):
                return False
            of_left, of_right = self.split(left), self.split(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or of_left and self.score[left] < self.score[right]:
                bound, or_equal, left = self.score[left], False, of_left[1]
            else:
                bound, or_equal, right = self.score[right], True, of_right[0]

    def word_ids(self, word: str) -> bytes:
        """Ids of a word behind a space. Letters without a piece become their bytes' ids."""
        word = MARK + word.replace(" ", MARK)
        many, sizes, fits = len(self.piece), self.sizes, self.fits
        last = [many] * (len(word) + 1)  # by length of the prefix
        # The automaton reports ends from left to right, and the longest piece of each end first.
        for end, piece in self.ends.iter(word):
            end += 1
            if last[end] == many:
                start = end - sizes[piece]
                before = last[start]
                if before == many and start:
                    before = last[start] = many + 1 + ord(word[start - 1])
                fit = fits.get(before * many + piece)
                if fit is None:
                    fit = self.compatible(before, piece)
                if fit:
                    last[end] = piece
        out, end = [], len(word)
        while end:
            piece = last[end]
            if piece < many:
                out.append(piece)
                end -= sizes[piece]
            else:
                end -= 1
                out += [self.byte_ids[b] for b in reversed(word[end].encode())]
        out.reverse()
        return array("i", out).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit integers."""
        if not text:
            return b""
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " in text or text[0] == " ":
            words = [w[1:] for w in _SPACED.findall(" " + text)]
        else:
            words = text.split(" ")
        parts = list(map(self.known.get, words))
        if None in parts:
            if 2 * len(self.known) > CACHED_WORDS:
                self.known, self.older = {}, self.known
            for i, part in enumerate(parts):
                if part is None:
                    word = words[i]
                    ids = self.known.get(word) or self.older.get(word) or self.word_ids(word)
                    if len(word) <= CACHED_CHARS:
                        self.known[word] = ids
                    parts[i] = ids
        return b"".join(parts)

    def decode(self, ids: Sequence[int]) -> str:
        """Text of ids; the mark before the first word goes."""
        parts = [self.surface[i] if 0 <= i < len(self.surface) else UNKNOWN_TEXT.encode()
                 for i in ids]
        return self.joined(parts, ids[0] if len(ids) else None)

    def joined(self, parts: list[bytes], first: int | None) -> str:
        text = b"".join(parts).decode("utf-8", "replace")
        marked = first is not None and 0 <= first < len(self.piece) and \
            self.piece[first].startswith(MARK)
        return text[1:] if marked else text


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_pieces(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text",
                  carry: Sequence[str] = ()) -> DataFrame:
    """``id``, ``ids`` (array of int) and ``carried``."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"),
                       carried(docs, carry).alias("carried"))

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = pieces(model).encode
        parts = [encode(t or "") for t in batch.column(1).to_pylist()]
        ends = np.cumsum([0, *map(len, parts)]) // 4
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                       pa.array(np.frombuffer(b"".join(parts), np.int32)))
        return batch_of(id=batch.column(0), ids=ids, carried=batch.column(2))

    schema = fields(rows, ["id"], "ids array<int>").add(rows.schema["carried"])
    return map_batches(rows, encode, schema)


def decode_pieces(rows: DataFrame, model: str, ids: str = "ids", text: str = "decoded"
                  ) -> DataFrame:
    """The rows with one more column, the text of their ids; null ids give empty text."""
    at = rows.columns.index(ids)

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = pieces(model)
        surface = np.array([*table.surface, UNKNOWN_TEXT.encode()], object)
        column = batch.column(at)
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        flat[(flat < 0) | (flat >= len(table.surface))] = len(table.surface)
        sizes = np.array([n or 0 for n in column.value_lengths().to_pylist()], np.int64)
        texts: list[str] = []
        start = 0
        for part in in_slices(sizes.tolist(), IDS_AT_ONCE):
            own = sizes[part]
            found = surface[flat[start:start + own.sum()]].tolist()
            ends = np.cumsum([0, *own]).tolist()
            for a, b in zip(ends, ends[1:]):
                texts.append(table.joined(found[a:b], int(flat[start + a]) if b > a else None))
            start += ends[-1]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                          [*batch.schema.names, text])

    return map_batches(rows, decode, fields(rows, rows.columns, f"`{text}` string"))

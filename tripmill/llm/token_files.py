"""Token ids in seekable binary files: one zstandard frame for each document.

File layout, all numbers little-endian: ``MAGIC``; one frame per document, holding its ids as
unsigned 32-bit integers, with zstandard's own content checksum; the seek table, one ``ENTRY`` per
document in file order; the ``FOOTER`` (place of the table, its entries and CRC-32, ``MAGIC``).
An entry has the frame's place, its compressed size, its number of ids, the CRC-32 of the compressed
bytes, and the document id, so a reader fetches footer, table and the frames it wants, no more.

Documents are in ascending id order over the files by number. A file is written under a name of its
own attempt and then renamed, so retried tasks cannot leave a torn file. Files go through the file
system that the folder's address names. Defined cases: null text has the end id only; null ids come
first; equal ids are ordered by a hash of the text.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tripmill.llm.common import batch_of, in_slices, released, staged

MAGIC = b"TOKSEEK1"
ENTRY = np.dtype([("place", "<u8"), ("size", "<u4"), ("ids", "<u4"), ("crc", "<u4"),
                  ("named", "<u4"), ("doc_id", "<i8")])
FOOTER = np.dtype([("place", "<u8"), ("entries", "<u8"), ("crc", "<u4"), ("magic", "S8")])
LEVEL = 3
CACHED_WORDS = 400_000
CACHED_CHARS = 48
CHARS_AT_ONCE = 8 << 20
WORDS_AT_ONCE = 1_000
BATCH_BYTES = 16 << 20

MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
ENDS = frozenset(MARKS)
AFTER_CYRILLIC = "\u0530"
SPACE_SIGN = "Ġ"  # how the vocabulary writes a space

_SPACE_RUN = re.compile(r" \s|\s ")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class WordEncoder:
    """The library's byte-level encoder, with the ids of frequent words kept.

    Its splitting pattern always starts a new word at a space between two characters that are not
    white space. Text is cut there, and each word is encoded by the library once. Text that holds
    an added token, such as the end of a text, is encoded whole, since the library looks for these
    before it splits.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        tokens = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(tokens.values()) + 1, bool)
        self.spaced[[i for t, i in tokens.items() if t.startswith(SPACE_SIGN)]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _each(self, words: list[str]) -> list[bytes]:
        """Ids of each word behind a space, from one call.

        A word without further spaces has just one token that begins with a space, its first.
        """
        if not words:
            return []
        text = "".join([" " + w for w in words])
        if text.count(" ") > len(words):
            return [self._encoded(" " + w) for w in words]
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids,
                       "<u4")
        raw = ids.tobytes()
        cuts = [*(4 * np.flatnonzero(self.spaced[ids])).tolist(), len(raw)]
        if len(cuts) != len(words) + 1:
            return [self._encoded(" " + w) for w in words]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _cut(self, words: list[str]) -> list[bytes]:
        """Ids of words behind a space, closing marks apart from the rest.

        The splitting pattern takes a run of letters as far as it goes, so what follows its last
        letter starts anew. Only letters that each version of Unicode knows are relied on.
        """
        heads, tails = list(words), {}
        for i, word in enumerate(words):
            if word[-1:] in ENDS:
                head = word.rstrip(MARKS)
                if head[-1:].isalpha() and head[-1] < AFTER_CYRILLIC:
                    heads[i], tails[i] = head, word[len(head):]
        closing = {t: self._encoded(t) for t in set(tails.values())}
        ids = self._known(heads)
        for i, tail in tails.items():
            ids[i] += closing[tail]
        return ids

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of words behind a space; each new one is encoded once."""
        parts = list(map(self.known.get, words))
        if None in parts:
            holes = [i for i, p in enumerate(parts) if p is None]
            missing = {words[i] for i in holes}
            found = {w: self.older[w] for w in missing & self.older.keys()}
            new = list(missing - found.keys())
            for at in range(0, len(new), WORDS_AT_ONCE):
                some = new[at:at + WORDS_AT_ONCE]
                found.update(zip(some, self._each(some)))
            for i in holes:
                parts[i] = found[words[i]]
            if len(self.known) > CACHED_WORDS:
                self.known, self.older = {}, self.known
            if max(map(len, found)) > CACHED_CHARS:
                found = {w: p for w, p in found.items() if len(w) <= CACHED_CHARS}
            self.known.update(found)
        return parts

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if any(t in text for t in self.added):
            return self._encoded(text)
        words = _LONE_SPACE.split(text) if _SPACE_RUN.search(text) else text.split(" ")
        first, words = words[0], words[1:]
        if first == "" and words:
            first, words = " " + words[0], words[1:]
        # Only the last word can end in white space, which would run into the next one.
        last = " " + words.pop() if words and words[-1][-1:].isspace() else ""
        return b"".join([self._encoded(first), *self._cut(words), self._encoded(last)])

    def _together(self, texts: list[str]) -> list[bytes | None]:
        """Ids of texts: their distinct words are looked up, then put together by number.

        Only texts in which each space stands alone between two words are done here; others and
        those that hold an added token give ``None``.
        """
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        flat = split.flatten().dictionary_encode()
        bounds = split.offsets.to_numpy()
        words = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = flat.indices.to_numpy().astype(np.int64)
        odd = np.fromiter((not w or w.strip() != w for w in words), bool, len(words))
        plain = np.maximum.reduceat(odd[which], bounds[:-1]) == 0
        plain &= np.fromiter((not any(a in t for a in self.added) for t in texts), bool, len(texts))
        # Odd words belong to texts left out, the first word of a text has no space before it.
        own = np.full(len(words) + len(texts), b"", object)
        own[:len(words)][~odd] = self._cut([w for w, o in zip(words, odd.tolist()) if not o])
        own[len(words):] = [self._encoded(t.partition(" ")[0]) if p else b""
                            for t, p in zip(texts, plain.tolist())]
        which[bounds[:-1]] = len(words) + np.arange(len(texts))
        ids = pa.array(own, pa.large_binary()).take(pa.array(which))
        _, places, raw = ids.buffers()
        cuts = np.frombuffer(places, "<i8")[bounds].tolist()
        raw = memoryview(raw)
        return [bytes(raw[a:b]) if p else None
                for a, b, p in zip(cuts, cuts[1:], plain.tolist())]

    def encode_all(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Ids of each text; ``CHARS_AT_ONCE`` letters are taken together."""
        for part in in_slices([len(t) for t in texts], CHARS_AT_ONCE):
            for text, ids in zip(texts[part], self._together(texts[part])):
                yield self.encode(text) if ids is None else ids


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def open_folder(uri: str):
    return arrow_fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:")
                                        else os.path.abspath(uri))


class Writer:
    """One file. Use ``add`` for each document, then ``close``."""

    def __init__(self, uri: str, attempt: str) -> None:
        self.fs, self.path = open_folder(uri)
        folder, _, name = self.path.rpartition("/")
        self.fs.create_dir(folder, recursive=True)
        self.draft = f"{folder}/_{name}.{attempt}"
        self.out = self.fs.open_output_stream(self.draft)
        self.out.write(MAGIC)
        self.at, self.entries = len(MAGIC), []
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.packer.compress(ids)
        self.out.write(frame)
        self.entries.append((self.at, len(frame), len(ids) // 4, zlib.crc32(frame),
                             doc_id is not None, doc_id or 0))
        self.at += len(frame)

    def close(self) -> None:
        seek = np.array(self.entries, ENTRY).tobytes()
        self.out.write(seek)
        self.out.write(np.array([(self.at, len(self.entries), zlib.crc32(seek), MAGIC)],
                                FOOTER).tobytes())
        self.out.close()
        if self.fs.get_file_info(self.path).type != arrow_fs.FileType.NotFound:
            self.fs.delete_file(self.path)
        self.fs.move(self.draft, self.path)


class Reader:
    """Seek table of one file; frames are fetched and checked one by one."""

    def __init__(self, uri: str) -> None:
        self.fs, self.path = open_folder(uri)
        self.file = self.fs.open_input_file(self.path)
        foot = np.frombuffer(self._bytes(self.file.size() - FOOTER.itemsize, FOOTER.itemsize),
                             FOOTER)[0]
        if foot["magic"] != MAGIC:
            raise ValueError(f"{uri} is not a complete token file")
        seek = self._bytes(int(foot["place"]), int(foot["entries"]) * ENTRY.itemsize)
        if zlib.crc32(seek) != foot["crc"]:
            raise ValueError(f"the seek table of {uri} is damaged")
        self.entries = np.frombuffer(seek, ENTRY)
        self.unpacker = zstandard.ZstdDecompressor()

    def _bytes(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def ids(self, number: int) -> bytes:
        """Ids of the document with this number in the file; reads its frame alone."""
        entry = self.entries[number]
        frame = self._bytes(int(entry["place"]), int(entry["size"]))
        if zlib.crc32(frame) != entry["crc"]:
            raise ValueError(f"frame {number} of {self.path} is damaged")
        return self.unpacker.decompress(frame, max_output_size=max(1, 4 * int(entry["ids"])))

    def find(self, doc_ids: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """Ids of the wanted documents, only their frames being read."""
        wanted = np.fromiter(doc_ids, np.int64)
        hit = np.isin(self.entries["doc_id"], wanted) & (self.entries["named"] == 1)
        for number in np.flatnonzero(hit).tolist():
            yield int(self.entries["doc_id"][number]), np.frombuffer(self.ids(number), "<u4")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id",
                      text: str = "text", end_id: int = 0) -> DataFrame:
    """Write the files; one row for each: ``number``, ``path``, ``docs``, ``ids``."""
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out = TaskContext.get(), None
        number, total = task.partitionId(), 0
        path = f"{folder}/tokens-{number:06d}.tok"
        encode_all = encoder(tokenizer).encode_all
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, ids in zip(batch.column(0).to_pylist(), encode_all(texts)):
                out = out or Writer(path, str(task.taskAttemptId()))
                ids += end
                out.add(i, ids)
                total += len(ids) // 4
        if out:
            out.close()
            yield batch_of(number=pa.array([number], pa.int32()), path=[path],
                           docs=pa.array([len(out.entries)], pa.int64()),
                           ids=pa.array([total], pa.int64()))

    rows = (docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
            .withColumn("salt", F.xxhash64("text")))
    ordered = (rows.repartitionByRange("id", "salt").sortWithinPartitions("id", "salt")
               .select("id", "text"))
    return staged(ordered.mapInArrow(released(write), "number int, path string, docs bigint, ids bigint"),
                  "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """Every document of the files: ``id``, ``start`` (ids before it) and ``ids`` (binary).

    The running totals of whole files are added up on the driver: one number a file.
    """
    listed = sorted(files.select("number", "path", "ids").collect())
    totals = np.cumsum([0, *(r[2] for r in listed)]).tolist()
    spark = files.sparkSession
    rows = spark.createDataFrame([(r[1], t) for r, t in zip(listed, totals)],
                                 "path string, start bigint")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed():
            return batch_of(id=pa.array(ids, pa.int64()), start=pa.array(starts, pa.int64()),
                            ids=pa.array(values, pa.binary()))
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                reader, size = Reader(path), 0
                ids, starts, values = [], [], []
                for number, entry in enumerate(reader.entries):
                    value = reader.ids(number)
                    ids.append(int(entry["doc_id"]) if entry["named"] else None)
                    starts.append(start)
                    values.append(value)
                    start += len(value) // 4
                    size += len(value)
                    if size > BATCH_BYTES:
                        yield packed()
                        ids, starts, values, size = [], [], [], 0
                if ids:
                    yield packed()

    # One file a task: round-robin over as many partitions.
    return rows.repartition(max(1, len(listed))).mapInArrow(
        released(read), "id bigint, start bigint, ids binary")

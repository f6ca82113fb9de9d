"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
import xxhash
from tokenizers import Tokenizer

SPACES = " \t\n\x0b\x0c\r"


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def neighbours(vectors: dict, queries, k: int) -> dict:
    ids = np.array(sorted(vectors))
    rows = np.array([vectors[i] for i in ids.tolist()], float)
    out = {}
    for q in queries:
        dist = np.sqrt(((rows - np.array(vectors[q], float)) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, dist)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(dist[j])) for j in order]
    return out


def fingerprint(text: str | None, size: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]
    if words and not shingles:
        shingles = [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: dict, distance: int = 3) -> dict:
    """Smallest id that can be reached from each id."""
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def repeats(docs: dict, size: int = 200) -> dict:
    raw = {i: (t or "").encode() for i, t in docs.items()}
    seen = Counter(r[i:i + size] for r in raw.values() for i in range(len(r) - size + 1))
    out = {}
    for d, r in raw.items():
        gone = [False] * len(r)
        for i in range(len(r) - size + 1):
            if seen[r[i:i + size]] > 1:
                gone[i:i + size] = [True] * size
        runs = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out[d] = len(r), sum(gone), runs, sha(bytes(b for b, g in zip(r, gone) if not g))
    return out


def lines(docs: list) -> list:
    """``(id, text, n_lines, n_dropped)`` of ``(id, text)`` rows."""
    def key(line):
        return lower(line.strip(SPACES))
    holders = defaultdict(list)
    for i, text in docs:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(i)
    last = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    out = []
    for i, text in docs:
        every = (text or "").split("\n")
        kept = [x for x in every if last.get(key(x), i) == i]
        out.append((i, "\n".join(kept), len(every), len(every) - len(kept)))
    return out


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contamination(docs: dict, items: list) -> dict:
    windows = defaultdict(set)
    for i, text in items:
        w = words(text)
        for a in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[a:a + 10])].add(i)
    out = {}
    for d, text in docs.items():
        w, hit, named = words(text), set(), set()
        for window, own in windows.items():
            for a in range(len(w) - len(window) + 1):
                if tuple(w[a:a + len(window)]) == window:
                    hit |= set(range(a, a + len(window)))
                    named |= own
        listed = ",".join(sorted(map(str, named)))
        out[d] = len(w), len(hit), len(named), sha(listed), bool(hit)
    return out


def token_rows(docs: dict) -> dict:
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = {}, 0
    for i in sorted(docs):
        ids = tokenizer.encode(docs[i] or "", add_special_tokens=False).ids + [0]
        out[i] = start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    return out


def piece_rows(docs: dict) -> dict:
    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = {}
    for i, text in docs.items():
        ids = model.encode(text or "")
        out[i] = len(ids), sha(",".join(map(str, ids))), sha(model.decode(ids))
    return out


def quality_base(text: str | None) -> tuple:
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen = Counter(windows)
    repeated = {j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if x.strip(SPACES)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated),
            len(w) < 20 or 100 * len(repeated) > 30 * len(w))


def fertility(text: str | None, pieces, ranks) -> tuple | None:
    """Piece tokens, characters per rank token, share of byte pieces, evenness."""
    parts = [w[i:i + 64] for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")
             for i in range(0, len(w), 64)]
    ids = [i for p in parts for i in pieces.encode(p)]
    if not ids:
        return None
    n, times = len(ids), Counter(ids)
    entropy = -sum(c / n * math.log2(c / n) for c in times.values())
    return (n, sum(map(len, parts)) / sum(len(ranks.encode_ordinary(" " + p)) for p in parts),
            sum(pieces.is_byte(i) for i in ids) / n,
            entropy / math.log2(min(n, pieces.get_piece_size())) if n > 1 else 1.0)


def with_given_run(doc_id, text: str | None) -> list[str]:
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n or doc_id is None:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def periodic(w: list) -> list:
    """``(start, length, period)`` of every run, by start, then period."""
    out, n = [], len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if size >= max(6, 4 * q) and not any(
                    all(w[x] == w[x + p] for x in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_row(w: list) -> tuple:
    found = periodic(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = (None,) * 4
    for s, size, q in found:
        if best[0] is None or size * best[2] > best[1] * q:
            best = s, size, q, 1000 * size // q
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    return (len(found), *best, sha(listed),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def whitened(vectors: list, steps: int = 64, shift: int = 1_000_000) -> tuple:
    """``x`` of every vector, count and sums of the distinct ones, eigenvalues and vectors."""
    x = [tuple(math.floor(steps * c) + shift for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1], directions[:, ::-1]

"""Dictionary of basic factors: equal stretches of 1, 2, 4, ... words share a number.

Sequences stand one after the other in one array. The words of each sequence have numbers of their
own, so a stretch that crosses a border, or meets its like only in another sequence, occurs once.
Stretches that occur once are dropped at every length, since nothing longer that holds them can
occur twice; what stays of ordinary prose after four words is next to nothing.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd


def word_numbers(sequences: Iterable[Sequence[Hashable]]) -> tuple[np.ndarray, list[dict]]:
    """Numbers of all words, and for each sequence its distinct words in order of first use.

    The numbers of a sequence follow those of the sequence before it without a gap.
    """
    numbers: list[int] = []
    distinct: list[dict] = []
    base = 0
    for words in sequences:
        own: dict[Hashable, int] = {}
        numbers += [own.setdefault(w, base + len(own)) for w in words]
        distinct.append(own)
        base += len(own)
    return np.array(numbers, np.int64), distinct


def _repeated(starts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those whose key occurs again, with keys numbered from 0."""
    names, _ = pd.factorize(keys)
    again = np.bincount(names)[names] > 1 if len(names) else np.zeros(0, bool)
    return starts[again], names[again]


def basic_factors(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, starts, names)`` for every power of two: the factors that occur twice or more.

    Starts ascend; two factors of a length are equal if their names are. Ends at the first length
    at which nothing repeats.
    """
    names_at = np.full(len(numbers), -1, np.int64)
    starts, names = _repeated(np.arange(len(numbers)), numbers)
    length = 1
    while len(starts):
        yield length, starts, names
        names_at[starts] = names
        inside = starts + length < len(numbers)
        left, right = names[inside], names_at[starts[inside] + length]
        names_at[starts] = -1
        starts, left, right = starts[inside][right >= 0], left[right >= 0], right[right >= 0]
        starts, names = _repeated(starts, left * (len(numbers) + 1) + right)
        length *= 2

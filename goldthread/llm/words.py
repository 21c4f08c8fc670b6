"""Words and their hashes, in numpy, for functions that run on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

SMALL_BATCH = 256  # texts handled at once, so that a batch of long ones stays small


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space, tab, line feed, vertical tab, form feed and carriage return, in UTF-8."""
    return text.encode().split() if text else []


def lowered(text: str | None) -> str | None:
    """A-Z in lower case, everything else as it is."""
    return text.encode().lower().decode() if text else text


def hash_words(words: list[bytes] | list[str]) -> np.ndarray:
    """A 64-bit hash (SipHash with a fixed key) of each word."""
    if not words:
        return np.zeros(0, np.uint64)
    cells = np.empty(len(words), dtype=object)
    cells[:] = words
    return pd.util.hash_array(cells, categorize=False)


def hash_runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` consecutive words, in order."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out ^ hashes[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mix(out)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def pieces(batch: pd.DataFrame, rows: int = SMALL_BATCH) -> Iterator[pd.DataFrame]:
    for start in range(0, len(batch), rows):
        yield batch.iloc[start:start + rows]


def hashed_texts(word_lists: list[list[bytes]] | list[list[str]]) -> list[np.ndarray]:
    """The word hashes of several texts, hashed in one go."""
    flat = hash_words([w for words in word_lists for w in words])
    return np.split(flat, np.cumsum([len(w) for w in word_lists])[:-1]) if word_lists else []

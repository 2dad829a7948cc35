"""Word shingles: 64-bit hashes by numpy over a batch of texts, and the same idea as Spark expressions.

A word is a maximal run of ASCII letters and digits or non-ASCII characters
in the lower-cased text; a shingle is five consecutive words. A text of one
to four words has one shingle, all its words; a text without a word has none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SIZE = 5
#: Word characters of the numpy and of the Spark form.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_IS_WORD = np.zeros(256, bool)
_IS_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
_IS_WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix (bijective)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        full = np.full(max(n, 1 << 20), base, np.uint64)
        full[0] = 1
        have = np.multiply.accumulate(full)
        if n <= 1 << 22:
            _powers[name] = have
    return have


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text and the index of its text (in order).

    Works on the whole batch at once: a polynomial prefix hash over the
    bytes gives each word's hash as a difference. About 40 bytes of memory
    per byte of text, so callers pass batches of about a million characters.
    """
    return term_hashes([t.lower().encode() for t in texts])


def term_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of texts that are lower-cased bytes already."""
    if not any(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    text_start = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]])
    word = _IS_WORD[data]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0)))
    starts, ends = edge[::2], edge[1::2]
    prefix = np.empty(len(data) + 1, np.uint64)
    prefix[0] = 0
    np.cumsum((data + np.uint64(1)) * _power(_BASE, len(data), "power")[:len(data)], out=prefix[1:])
    hashes = (prefix[ends] - prefix[starts]) * _power(_INVERSE, len(data), "inverse")[starts]
    return mix(hashes), np.searchsorted(text_start, starts, "right") - 1


def shingle_hashes(texts: list[str], size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of every text and the index of its text, in order, repeats included."""
    words, owner = word_hashes(texts)
    n = len(words)
    if not n:
        return words, owner
    counts = np.bincount(owner, minlength=len(texts))
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    first = np.zeros(len(texts), np.int64)
    first[1:] = np.cumsum(counts)[:-1]
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    left = (first + counts)[owner] - np.arange(n)  # words from here to the text's end
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += np.where(left > k, padded[k:k + n] * factors[k], np.uint64(0))
    keep = (left >= size) | ((counts[owner] < size) & (left == counts[owner]))
    return mix(total[keep]), owner[keep]


def weighted_sets(texts: list[str], size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text (44-bit ids, ascending), their counts, and the index of their text."""
    hashes, owner = shingle_hashes(texts, size)
    if len(texts) >= 1 << 20:
        raise ValueError("pass fewer than 2**20 texts at a time")
    key = (owner.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20))
    key.sort()
    at = np.flatnonzero(np.diff(key, prepend=np.uint64(0xFFFFFFFFFFFFFFFF)))
    count = np.diff(at, append=len(key))
    distinct = key[at]
    return distinct & np.uint64((1 << 44) - 1), count, (distinct >> np.uint64(44)).astype(np.int64)


def words_column(text: Column) -> Column:
    """Array of the words of ``text`` as a Spark expression (null text: empty array)."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")

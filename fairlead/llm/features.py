"""Hashed n-gram features of texts: words, word pairs, and the shapes of words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from fairlead.llm.common import LOWER, mix, stretch_hashes, text_bytes, words

BITS = 20

# Classes of characters that make a word's shape: lower, upper, digit, beyond ASCII, and each
# punctuation mark on its own.
CLASSES = np.arange(256, dtype=np.uint8)
CLASSES[ord("a") : ord("z") + 1] = 1
CLASSES[ord("A") : ord("Z") + 1] = 2
CLASSES[ord("0") : ord("9") + 1] = 3
CLASSES[128:] = 1


def shape_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's classes, repeats in a row taken once."""
    if not len(start):
        return np.zeros(0, np.uint64)
    kinds = CLASSES[data]
    changed = np.ones(len(data), bool)
    changed[1:] = kinds[1:] != kinds[:-1]
    changed[start] = True
    kept = np.flatnonzero(changed)
    a, b = np.searchsorted(kept, start), np.searchsorted(kept, end)
    return stretch_hashes(kinds[kept], a, b, 7)


def ngram_features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, sorted by row, of a column of texts.

    Features below 2**bits: lower-cased words and pairs of them, shapes of one, two and three
    words in a row, and whether two and three words in a row are the same. Null and empty
    texts, and texts of white space, have none.
    """
    data, at = text_bytes(texts)
    start, end, row = words(data, at)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = stretch_hashes(LOWER[data], start, end, 3)
    shape = shape_hashes(data, start, end)
    same = np.zeros(len(row), bool)
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    two, three = row[1:] == row[:-1], row[2:] == row[:-2]
    with np.errstate(over="ignore"):
        k = np.uint64(0x9E3779B97F4A7C15)
        grams = [
            (word, row, 11),
            ((word[:-1] * k + word[1:])[two], row[1:][two], 12),
            (shape, row, 13),
            ((shape[:-1] * k + shape[1:])[two], row[1:][two], 14),
            (((shape[:-2] * k + shape[1:-1]) * k + shape[2:])[three], row[2:][three], 15),
            (same[1:][two].astype(np.uint64), row[1:][two], 16),
            ((same[1:-1].astype(np.uint64) * 2 + same[2:])[three], row[2:][three], 17),
        ]
    keys = [
        np.unique((r.astype(np.uint64) << np.uint64(bits)) | (mix(h, kind) >> np.uint64(64 - bits)))
        for h, r, kind in grams
    ]
    keys = np.unique(np.concatenate(keys))
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & np.uint64((1 << bits) - 1)).astype(np.int64)

"""Sparse linear models over hashed word n-grams: feature hashing, FTRL-proximal training,
scoring as sparse dot products.  Used inside tasks; Spark deals out the rows.

Edge cases: a text without words has no n-grams and scores the sigmoid of the bias; words of any length
are hashed whole; no rows leave all weights 0.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SHAPES = bytes.maketrans(bytes(range(256)), bytes(
    ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)))
_RUN = re.compile(rb"(.)\1+", re.S)
_CACHE_WORDS = 300_000
_CACHE_BYTES = 64       # longer words are known by a digest, so that the count bounds the bytes too
SCALE = 20.0            # weight of all n-grams of a text together


class _Words(dict):
    """Word -> row of its hashes in a growing table; emptied between texts when full."""

    def __init__(self, hashes):
        super().__init__()
        self._hashes, self._new, self._table = hashes, [], np.empty((1 << 12, 2), np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self._new.append(self._hashes(word))
        return at

    def _digested(self, word: bytes) -> bytes:
        """The word as a key; a long one by its digest (with a blank, which no word has) and hashed at once."""
        if len(word) <= _CACHE_BYTES:
            return word
        key = b" " + xxhash.xxh3_128_digest(word)
        if key not in self:
            self[key] = len(self)
            self._new.append(self._hashes(word))
        return key

    def lookup(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _CACHE_WORDS:
            self.clear()
        if len(max(words, key=len)) > _CACHE_BYTES:
            words = list(map(self._digested, words))
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self._new:
            while len(self._table) < len(self):
                self._table = np.concatenate((self._table, np.empty_like(self._table)))
            self._table[len(self) - len(self._new):len(self)] = self._new
            self._new = []
        return self._table[at]


class NgramHasher:
    """Hashes a text's word n-grams into ``2 ** bits`` columns.

    Views: the words in lower case (n = 1 .. ``order``) and, if ``shapes``, the word shapes
    (letters, capitals, digits as classes, runs collapsed; n = 1, 2) together with a mark
    for a word that repeats the one before.  ``grams`` gives the column of every n-gram of
    the text, repeats included; each weighs ``scale(len(grams))``.
    """

    def __init__(self, bits: int = 18, order: int = 2, shapes: bool = True):
        self.bits, self.order, self.shapes = bits, order, shapes
        self._words = _Words(lambda w: (xxhash.xxh64_intdigest(w.lower(), 1),
                                        xxhash.xxh64_intdigest(_RUN.sub(rb"\1", w.translate(_SHAPES)), 2)))

    def grams(self, text: bytes) -> np.ndarray:
        words = text.split()
        if not words:
            return np.empty(0, np.int64)
        h = self._words.lookup(words)
        first = gram = np.ascontiguousarray(h[:, 0])
        parts = [first]
        for n in range(2, self.order + 1):
            if len(words) >= n:
                gram = (gram[:-1] * _M1) ^ first[n - 1:]
                parts.append(gram * _M2)
        if self.shapes:
            s = np.ascontiguousarray(h[:, 1])
            parts += [s, (s[:-1] * _M1 ^ s[1:] ^ (first[:-1] == first[1:])) * _M2]
        return (np.concatenate(parts) * _M1 >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def scale(n: int) -> float:
        return SCALE / max(n, 1)

    def row(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Sparse training row: distinct columns and their values."""
        grams = self.grams(text)
        index, count = np.unique(grams, return_counts=True)
        return index, count * self.scale(len(grams))

    def dot(self, weights: np.ndarray, text: bytes) -> float:
        """Sparse dot product of a text's row and the weights (bias last)."""
        grams = self.grams(text)
        return float(weights[grams].sum()) * self.scale(len(grams)) + float(weights[-1])


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Ftrl:
    """FTRL-proximal logistic regression (per-coordinate rates, L1 and L2); the last of the
    ``size + dense + 1`` weights is the bias, before it those of ``dense`` extra inputs."""

    def __init__(self, size: int, dense: int = 0, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.2, l2: float = 1.0):
        self.size, self.alpha, self.beta, self.l1, self.l2 = size, alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + dense + 1), np.zeros(size + dense + 1)

    def _at(self, i: np.ndarray) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        l1 = np.where(i < self.size, self.l1, 0.0)
        return np.where(np.abs(z) <= l1, 0.0,
                        -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + np.where(i < self.size, self.l2, 0.0)))

    def learn(self, index: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self._at(index)
        g = (sigmoid(w @ value) - label) * value
        n = self.n[index]
        self.z[index] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[index] = n + g * g

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int) -> np.ndarray:
        """Weights after ``epochs`` passes in the given order, each pass turned by a fixed shuffle."""
        rng = np.random.default_rng(7)
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                self.learn(*rows[k])
        return self._at(np.arange(len(self.z)))

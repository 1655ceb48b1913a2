"""SetSketch registers of word-shingle sets: hashing, sketching, banding and the joint estimate. Plain numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from boxloom.llm.common import lower_az

#: Registers, and registers per band.
REGISTERS, BAND = 120, 4
#: Base of the exponential spacing, rate, and largest register value: registers are 16-bit.
BASE, RATE, TOP = 1.001, 20.0, 65_535
WORD = re.compile(r"[^ \t\n\v\f\r]+")
STEP = np.uint64(0x9E3779B97F4A7C15)
REMEMBERED = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def seeds(n: int, salt: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 20)) * STEP)


MULTIPLIERS = seeds(REGISTERS, 1) | np.uint64(1)
BAND_SEEDS = seeds(REGISTERS // BAND, 2)


class Shingler:
    """Sorted distinct 64-bit hashes of the k-word shingles of texts; word hashes are remembered."""

    def __init__(self, k: int) -> None:
        self.k, self.known = k, {}

    def word_hashes(self, text: str) -> np.ndarray:
        words = WORD.findall(lower_az(text))
        known = self.known
        new = [w for w in set(words) if w not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = set(words)
        for w in new:
            known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str) -> np.ndarray:
        """With fewer than k words the whole sequence is the one shingle; without words there is none."""
        w = self.word_hashes(text)
        if not len(w):
            return w
        length = min(self.k, len(w))
        h = np.full(len(w) - length + 1, length, np.uint64) * STEP
        for j in range(length):
            h = mix(h + w[j : len(w) - length + 1 + j])
        return np.unique(h)


def registers(shingles: np.ndarray) -> np.ndarray:
    """Per register the least of the elements' exponential variates, on the exponential scale, cut to 0 .. TOP.

    The least variate belongs to the least hash, so only the minima are transformed. Registers of a union are the
    larger ones of both (`np.maximum`).
    """
    least = np.full(REGISTERS, np.uint64(2**64 - 1))
    for a in range(0, len(shingles), 2048):
        least = np.minimum(least, (shingles[a : a + 2048, None] * MULTIPLIERS[None, :]).min(0))
    x = -np.log1p(-(least.astype(float) / 2**64).clip(1e-19, 1 - 1e-12)) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.uint16)


def bands(regs: np.ndarray) -> np.ndarray:
    """Hashed bands of a matrix of registers: one row per sketch."""
    parts = regs.reshape(len(regs), -1, BAND).astype(np.uint64)
    h = np.broadcast_to(BAND_SEEDS, parts.shape[:2])
    for j in range(BAND):
        h = mix(h + parts[:, :, j])
    return h.view(np.int64)


def estimate(equal: np.ndarray, more: np.ndarray, fewer: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of largest likelihood, given the registers that are equal, larger in a and larger in b, and both sizes."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    top = np.minimum(u / v, v / u)

    def share(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        p, q = share(u - v * j), share(v - u * j)
        return more * np.log(np.maximum(p, 1e-12)) + fewer * np.log(np.maximum(q, 1e-12)) + equal * np.log(np.maximum(1 - p - q, 1e-12))

    low, high = np.zeros_like(top), top.copy()
    for _ in range(30):  # concave in j: cut thirds
        a, b = low + (high - low) / 3, high - (high - low) / 3
        left = likelihood(a) > likelihood(b)
        high, low = np.where(left, b, high), np.where(left, low, a)
    return (low + high) / 2

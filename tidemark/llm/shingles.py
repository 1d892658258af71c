"""Word-shingle fingerprints of whole texts with numpy, and min-hash signatures of them."""

from __future__ import annotations

import hashlib

import numpy as np

_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(int(_SEED.integers(0, 2**62)) * 4 + 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = _SEED.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection with good high and low bits)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and its inverse, grown as longer texts come."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 14)
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _INVERSE)],
                                   dtype=np.uint64)


_POWERS = Powers()


def words_of_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, 64-bit hash) of each word, A-Z lower-cased; split at ASCII white space."""
    raw = np.frombuffer(raw.lower(), np.uint8)
    if not len(raw):
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64)
    inside = ~_BLANK[raw]
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    _POWERS.to(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _POWERS.up[:len(raw)], out=total[1:])
    return start, end, mix((total[end] - total[start]) * _POWERS.down[start])


def word_hashes(text: str | None) -> np.ndarray:
    return words_of_bytes((text or "").encode("utf-8", "surrogatepass"))[2]


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(width, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += words[k:n + k] * _STEP[k]
    return np.unique(mix(total))


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class MinHash:
    """``n`` minima of seeded 32-bit permutations over a set of shingle hashes."""

    def __init__(self, n: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1)
        self.shift = rng.integers(0, 2**32, n, dtype=np.uint32)

    def __call__(self, shingles: np.ndarray, block: int = 1024) -> np.ndarray:
        low = np.full(len(self.factor), 2**32 - 1, np.uint32)
        for k in range(0, len(shingles), block):
            part = (shingles[k:k + block] >> np.uint64(32)).astype(np.uint32)
            values = part[:, None] * self.factor
            values += self.shift
            np.minimum(low, values.min(axis=0), out=low)
        return low

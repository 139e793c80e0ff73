"""Words, word n-grams as 64-bit hashes, and min-hash sketches, all on arrays."""

from __future__ import annotations

import math

import numpy as np

#: A-Z to a-z; every other ASCII character that is neither a letter nor a digit to a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CHUNK = 20_000  # words hashed at a time
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of letters and digits, A-Z lower-cased."""
    return text.translate(FOLD).split()


def _powers_to(n: int) -> list[np.ndarray]:
    """The base's and its inverse's powers below ``n``."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the input spread over all bits of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngram_hashes(words: list[bytes], n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, in order; of all words as one run if they are fewer; none without words.

    The words are joined by spaces and hashed as substrings: a polynomial's prefix sums, differences, and the offset
    divided out again.
    """
    if not words:
        return np.empty(0, np.uint64)
    n = min(n, len(words))
    parts = []
    for at in range(0, len(words) - n + 1, _CHUNK):
        own = words[at : at + _CHUNK + n - 1]
        data = np.frombuffer(b" ".join(own), np.uint8)
        lengths = np.fromiter(map(len, own), np.int64, len(own))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        power, inverse = _powers_to(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        first, last = starts[: len(own) - n + 1], ends[n - 1 :]
        parts.append(mixed((sums[last] - sums[first]) * inverse[first]))
    return np.concatenate(parts)


def choose_bands(threshold: float, recall: float, rows: int) -> int:
    """The fewest bands of ``rows`` rows that find a pair at the threshold with the given probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


class MinHash:
    """Sketches of n-gram sets: 32-bit minima for bands, and their lowest bytes to estimate similarity."""

    def __init__(self, bands: int, rows: int, seed: int = 1) -> None:
        self.bands, self.rows = bands, rows
        draws = np.random.default_rng(seed).integers(1, 1 << 63, (3, bands * rows), dtype=np.uint64)
        self.factors, self.shifts = draws[0] * np.uint64(2) + np.uint64(1), draws[1]
        self.salts = draws[2].reshape(bands, rows) * np.uint64(2) + np.uint64(1)

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        best = np.full(self.bands * self.rows, 0xFFFFFFFF, np.uint64)
        for at in range(0, len(hashes), 1024):
            drawn = (hashes[at : at + 1024, None] * self.factors + self.shifts) >> np.uint64(32)
            np.minimum(best, drawn.min(axis=0), out=best)
        return best

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band, from the minima of one or of many sets."""
        mixed_rows = mixed(minima.reshape(*minima.shape[:-1], self.bands, self.rows) * self.salts)
        return mixed(mixed_rows.sum(axis=-1) + np.arange(1, self.bands + 1, dtype=np.uint64) * _BASE).view(np.int64)

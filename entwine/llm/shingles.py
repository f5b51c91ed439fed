"""Word shingles of many texts at once, as 64-bit hashes, on byte arrays."""

from __future__ import annotations

import numpy as np

# The word separators, space and the control characters 9 to 13.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[32, 9, 10, 11, 12, 13]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_rng = np.random.default_rng(7)
BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    name = str(int(base))
    if len(_powers.get(name, ())) < n:
        size = max(n, 1 << 16)
        out = np.full(size, base, np.uint64)
        out[0] = 1
        _powers[name] = np.multiply.accumulate(out)
    return _powers[name][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SEPARATORS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and how many words each text has. Words do not cross texts."""
    inside = ~separators[raw]
    n = len(raw)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return begin, end, np.diff(np.searchsorted(begin, offsets))


def word_hashes(folded: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each word: a polynomial in BASE, taken as a difference of prefix sums, then mixed."""
    sums = np.zeros(len(folded) + 1, np.uint64)
    np.cumsum(BYTE[folded] * powers(BASE, len(folded)), out=sums[1:])
    return mixed((sums[end] - sums[begin]) * powers(INVERSE, len(folded) + 1)[begin] + (end - begin).astype(np.uint64))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after the other, and where each text's begin (n + 1).

    A text of fewer words has its whole sequence as one shingle; a text without words has none.
    """
    begin, end, count = words(raw, offsets)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(count) + 1, np.int64)
    word = word_hashes(FOLD[raw], begin, end)
    first = np.cumsum(count) - count
    n = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    text = np.repeat(np.arange(len(count)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[text]
    length = np.minimum(count, width)[text]
    padded = np.concatenate([word, np.zeros(width, np.uint64)])
    h = np.zeros(len(at), np.uint64)
    for k in range(width):
        h = mixed(h + np.where(k < length, padded[at + k], np.uint64(0)) + np.uint64(k + 1))
    edges = np.concatenate([[0], np.cumsum(n)])
    sets = [np.unique(h[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return (np.concatenate(sets) if sets else h), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def min_max(values: np.ndarray, offsets: np.ndarray, permutations: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of each set under each permutation, from one evaluation of it: (permutations, sets) each.
    Sets must not be empty."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(0, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = rng.integers(0, 1 << 63, permutations, dtype=np.uint64)
    low, high = (np.empty((permutations, len(offsets) - 1), np.uint64) for _ in range(2))
    for k in range(permutations):
        x = (values ^ masks[k]) * factors[k]
        x ^= x >> np.uint64(32)
        x *= factors[k]
        low[k] = np.minimum.reduceat(x, offsets[:-1])
        high[k] = np.maximum.reduceat(x, offsets[:-1])
    return low, high

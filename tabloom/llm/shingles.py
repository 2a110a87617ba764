"""Word shingles of whole texts as sorted 64-bit numbers, and their MinHash samples."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
SAMPLES = 128
ROWS = 4
SKETCH_BITS = 1024
SKETCH_SAMPLE = 512

_STEPS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    np.uint64,
)
_rng = np.random.default_rng(20240229)
_FACTORS = (_rng.integers(0, 2**32, SAMPLES, dtype=np.uint32) | np.uint32(1))[None, :]
_TERMS = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint32)[None, :]
_MOST_KEPT_WORDS = 500_000
_kept: dict[bytes, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Distinct shingles of five words; the whole sequence, if it has fewer words.

    A-Z are lower-cased; words lie between ASCII white space.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(_kept) > _MOST_KEPT_WORDS:
        _kept.clear()
    get, codes = _kept.get, []
    for w in words:
        c = get(w)
        if c is None:
            c = _kept[w] = xxhash.xxh3_64_intdigest(w)
        codes.append(c)
    h = np.array(codes, np.uint64)
    n = max(len(h) - WIDTH + 1, 1)
    total = np.zeros(n, np.uint64)
    for j in range(min(WIDTH, len(h))):
        total += mixed(h[j : j + n] + _STEPS[j])* _STEPS[j]
    if len(h) < WIDTH:
        total += np.uint64(len(h))
    return np.unique(mixed(total))


def samples(found: np.ndarray) -> np.ndarray:
    """The minima of a non-empty set under ``SAMPLES`` hash functions."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    low = None
    for k in range(0, len(x), 4096):
        part = (x[k : k + 4096, None] * _FACTORS + _TERMS).min(axis=0)
        low = part if low is None else np.minimum(low, part)
    return low


def bands(low: np.ndarray) -> np.ndarray:
    """One signed number for each band of ``ROWS`` samples."""
    pairs = low.reshape(-1, ROWS).astype(np.uint64)
    key = np.arange(len(pairs), dtype=np.uint64) * _STEPS[0]
    for j in range(ROWS):
        key = mixed(key * _STEPS[1] + pairs[:, j] + _STEPS[2])
    return key.view(np.int64)


def level_of(n: int) -> int:
    """How often a set of n is halved by its hash until about ``SKETCH_SAMPLE`` are left."""
    return max(0, (max(n, 1) - 1) // SKETCH_SAMPLE).bit_length()


def odd_sketches(found: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the set's MinHash sample at its own level and at the next.

    The sample at level l holds the shingles whose hash lies below 2 ** (64 - l),
    so samples of different sets at one level can be compared.  Bit i tells
    whether an odd number of them falls on i.  The XOR of two sketches is the
    sketch of the symmetric difference of the samples, and has at most as many
    bits as that difference has members.
    """
    h, out = mixed(found ^ _STEPS[3]), []
    level = level_of(len(found))
    for own in (level, level + 1):
        sample = h[h < np.uint64(2 ** (64 - own))] if own else h
        at = (mixed(sample + _STEPS[4]) % np.uint64(SKETCH_BITS)).astype(np.int64)
        odd = np.bincount(at, minlength=SKETCH_BITS) & 1
        out.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
    return np.concatenate(out)


def linked(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    """100 * intersection >= percent * union, on full sets."""
    if not len(a) or not len(b):
        return False
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)

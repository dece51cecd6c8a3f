"""MinHash samples of word shingles, band keys, and odd sketches of the samples."""

from __future__ import annotations

import numpy as np

from lendscope.llm.words import Words, inside_documents, mix, rolling, seeds

WORDS = 5
ROWS = 4
BANDS = 32
SAMPLES = ROWS * BANDS
BITS = 512


def shingle_sets(words: Words, width: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document: (hashes, first), as in ``Words``.

    A document with fewer words than a shingle has one, its whole sequence; one without words none.
    """
    found = rolling(words.hashes, width)
    sets, sizes = [], []
    for start, end in zip(words.first[:-1], words.first[1:], strict=True):
        n = end - start
        if n >= width:
            own = np.unique(found[start : end - width + 1])
        elif n:
            own = rolling(words.hashes[start:end], int(n), start=10 + int(n))
        else:
            own = found[:0]
        sets.append(own)
        sizes.append(len(own))
    return np.concatenate([found[:0], *sets]), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def set_digests(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each set, whatever the order; equal sets have equal digests."""
    out = np.zeros((len(first) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        with np.errstate(over="ignore"):
            for k, a in enumerate(seeds(2, 900)):
                out[full, k] = np.add.reduceat(mix(sets * a), first[:-1][full])
    return out


def samples(sets: np.ndarray, first: np.ndarray, n: int = SAMPLES) -> np.ndarray:
    """MinHash samples of non-empty sets, a row per set. Empty sets get the largest number."""
    out = np.full((n, len(first) - 1), np.uint64(2**64 - 1))
    full = np.flatnonzero(np.diff(first))
    if len(full):
        at = first[:-1][full]
        with np.errstate(over="ignore"):
            for k, a in enumerate(seeds(n, 2_000)):
                out[k, full] = np.minimum.reduceat(sets * a, at)
    return out.T


def band_keys(sampled: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each run of ``rows`` samples; keys of different bands differ."""
    n, width = sampled.shape
    grouped = sampled.reshape(n, width // rows, rows)
    total = np.zeros((n, width // rows), np.uint64)
    with np.errstate(over="ignore"):
        for k, a in enumerate(seeds(rows, 3_000)):
            total += mix(grouped[:, :, k]) * a
        return mix(total + seeds(width // rows, 4_000)[None, :])


def odd_sketches(sampled: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Each sample flips one bit; a bitmap per row holds the parities. Bytes, a row per set."""
    n, width = sampled.shape
    with np.errstate(over="ignore"):
        bit = (mix(sampled + seeds(width, 5_000)[None, :]) % np.uint64(bits)).astype(np.int64)
    place = (np.arange(n)[:, None] * bits + bit).ravel()
    odd = (np.bincount(place, minlength=n * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, bits), axis=1)


def differing_bits(similarity: float, bits: int = BITS, n_samples: int = SAMPLES) -> float:
    """Bits that differ on average between the odd sketches of two sets of this similarity.

    The inverse of the estimator  J = 1 + bits / (4 samples) * ln(1 - 2 differing / bits).
    """
    return bits / 2 * (1 - np.exp(-4 * n_samples * (1 - similarity) / bits))

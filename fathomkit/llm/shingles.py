"""Word shingles of texts, MinHash signatures over them, and band keys."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

SHINGLE_WORDS = 5
HASHES = 128
BAND_ROWS = 4

_random = np.random.RandomState(20_240_601)
_A = _random.randint(1 << 62, size=HASHES, dtype=np.int64).astype(np.uint64) * 2 + 1
_B = _random.randint(1 << 62, size=HASHES, dtype=np.int64).astype(np.uint64)
_ODD = _random.randint(1 << 62, size=max(SHINGLE_WORDS, BAND_ROWS) + 1, dtype=np.int64).astype(np.uint64) * 2 + 1
_BLOCK = 1 << 14


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers, so that their low and high bits depend on all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles_of(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the windows of ``size`` words (stretches without ASCII white space).

    A text of fewer words has one shingle of them all; a text without words has none.
    """
    words = text.encode().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    key = np.full(n, size, np.uint64)
    for j in range(size):
        key += hashes[j: j + n] * _ODD[j]
    return np.unique(mixed(key))


def digest_of(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature_of(shingles: np.ndarray) -> np.ndarray:
    """MinHash values, 32 bits each, of a set that is not empty."""
    low = np.full(HASHES, (1 << 64) - 1, np.uint64)
    for at in range(0, len(shingles), _BLOCK):
        block = shingles[at: at + _BLOCK]
        np.minimum(low, (block[None, :] * _A[:, None] + _B[:, None]).min(1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def band_keys(signature: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` values, signed as Spark stores it."""
    bands = signature.reshape(-1, rows).astype(np.uint64)
    key = (bands * _ODD[:rows]).sum(1, dtype=np.uint64) + np.arange(len(bands), dtype=np.uint64) * _ODD[rows]
    return mixed(key).view(np.int64)

"""Sets of hashed shingles of words, and their digests."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 3
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes. Bytes split and lower-case by ASCII rules alone."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, U)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), U, len(tokens))
    width = min(n, len(tokens))
    total = np.full(len(tokens) - width + 1, width, U)
    for i in range(width):
        total = mixed(total + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(total)


def digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a set from others."""
    one = xxhash.xxh3_128_intdigest(tokens.tobytes())
    return (one >> 64) - (1 << 63), (one & (1 << 64) - 1) - (1 << 63)

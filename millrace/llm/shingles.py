"""Hashed word shingles of whole texts, vectorised over a block of documents.

A block of texts becomes one byte array. Word hashes come from prefix sums of a
polynomial over the bytes, so each byte is touched a fixed number of times by numpy,
whatever the word lengths; a shingle hash mixes the hashes of its five words.
"""

from __future__ import annotations

import numpy as np

#: Bytes of text worked on at once; a longer single text makes a block of its own.
BLOCK_BYTES = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_cache: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache.get("up", ())) < n:
        _cache["up"], _cache["down"] = _powers(_BASE, n), _powers(_BASE_INV, n)
    return _cache["up"], _cache["down"]


def _block(texts: list[bytes], k: int) -> list[np.ndarray]:
    buf = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    starts_of_docs = np.cumsum([0] + [len(t) + 1 for t in texts])
    space = _SPACE[buf]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    begin = np.flatnonzero(before & ~space)
    end = np.flatnonzero(space & ~before)
    up, down = _tables(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=sums[1:])
    words = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    first = np.searchsorted(begin, starts_of_docs)
    n = len(words)
    grams = np.zeros(max(n - k + 1, 0), dtype=np.uint64)
    for j in range(k):
        grams = mix(grams * _U(_BASE) + words[j : j + len(grams)])
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            h = np.full(1, b - a, dtype=np.uint64)
            for w in words[a:b]:
                h = mix(h * _U(_BASE_INV) + w)
            out.append(h)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def shingle_sets(texts: list[str | None], k: int = 5):
    """For each text its sorted distinct hashed shingles, uint64; A-Z lower-cased first.

    Fewer than ``k`` words: the whole sequence is the one shingle. No words: empty.
    """
    block: list[bytes] = []
    size = 0
    for t in texts:
        block.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(block[-1])
        if size >= BLOCK_BYTES:
            yield from _block(block, k)
            block, size = [], 0
    if block:
        yield from _block(block, k)

"""Vectorised word and shingle hashing over chunks of documents (numpy inside tasks).

Words are maximal runs of bytes other than space and \\x09-\\x0D, after A-Z are
lower-cased.  All hashes are 64-bit and depend on the bytes alone, so the same words
hash alike in every task.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_MIX = tuple(_U(c) for c in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53))
_TABLE = np.random.Generator(np.random.PCG64(20240601)).integers(0, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the base and of its inverse modulo 2**64, kept between calls."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        inverse = _U(pow(int(_BASE), -1, 2**64))
        for name, base in (("up", _BASE), ("down", inverse)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(33))
    x = x * _MIX[0]
    x ^= x >> _U(29)
    x *= _MIX[1]
    x ^= x >> _U(32)
    return x


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums of a byte array; one longer than the array."""
    up, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[buf] * up, out=out[1:])
    return out


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of buf[start:end] for each pair, from prefix_sums(buf); the same bytes give the same hash at any place."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one byte array with a space after each, and the place where each begins (one more than texts)."""
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(lengths + 1, out=begins[1:])
    return np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8), begins


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets): words of text i are hashes[offsets[i]:offsets[i+1]]."""
    buf, begins = joined(texts)
    upper = (buf >= 65) & (buf <= 90)
    buf = buf + upper.astype(np.uint8) * np.uint8(32)
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(np.diff(space.astype(np.int8)))
    start, end = edge[space[edge]] + 1, edge[~space[edge]] + 1
    if len(buf) and not space[0]:
        start = np.concatenate([[0], start])
    hashes = range_hashes(prefix_sums(buf), start, end)
    return hashes, np.searchsorted(start, begins)


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of k-word shingles of each text, concatenated, and their offsets.

    A text of fewer words than k has its whole sequence as its only shingle; one without
    words has none.
    """
    hashes, offsets = words(texts)
    n = max(0, len(hashes) - k + 1)
    grams = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        grams = grams * _BASE + hashes[i : i + n]
    grams = mix(grams)
    counts = np.diff(offsets)
    whole = counts.astype(np.uint64)  # of texts shorter than k: their sequence, folded word by word
    for i in range(k - 1):
        more = (counts > i) & (counts < k)
        whole[more] = mix(whole[more] * _BASE + hashes[offsets[:-1][more] + i])
    parts, sizes = [], np.zeros(len(texts) + 1, dtype=np.int64)
    for i in np.flatnonzero(counts):
        s = np.unique(grams[offsets[i] : offsets[i + 1] - k + 1]) if counts[i] >= k else whole[i : i + 1]
        parts.append(s)
        sizes[i + 1] = len(s)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(sizes)


def chunks(ids, texts, limit: int):
    """Split parallel lists into runs whose texts have at most ``limit`` bytes (a longer text runs alone)."""
    a, total = 0, 0
    for i, t in enumerate(texts):
        if i > a and total + len(t) > limit:
            yield ids[a:i], texts[a:i]
            a, total = i, 0
        total += len(t)
    if a < len(texts):
        yield ids[a:], texts[a:]

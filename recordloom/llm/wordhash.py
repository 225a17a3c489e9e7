"""Words of many texts hashed at once with numpy.

A word's hash is a polynomial over its bytes modulo 2**64, from prefix sums over a whole block of
texts, with a final mix; it depends on the word alone, so it is the same on every machine.
"""

from __future__ import annotations

import numpy as np

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_GAP = np.zeros(256, dtype=bool)
_IS_GAP[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}
#: Bytes of text whose words are hashed together.
STRETCH = 1 << 19


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse."""
    if len(_powers.get("up", ())) < n:
        size = max(STRETCH + 1, n)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def word_hashes(texts: list[str], lower: bool = True, places: bool = False) -> tuple[np.ndarray, ...]:
    """Hashes of all words of ``texts`` in order, and for each text the index of its first word (one more at the end).

    ``lower`` maps A-Z to a-z first; other letters keep their case. With ``places``, also the first
    byte of each word in the texts joined by line breaks.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
    block = b"\n".join(raw) + b"\n"
    if lower:
        block = block.translate(LOWER)
    data = np.frombuffer(block, dtype=np.uint8)
    gap = _IS_GAP[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).astype(np.int8)))
    begins, ends = edge[0::2], edge[1::2]
    hashes = np.empty(len(begins), dtype=np.uint64)
    i = 0
    while i < len(begins):  # a stretch of whole words at a time, so that a very long text takes no more memory
        j = max(i + 1, int(np.searchsorted(ends, begins[i] + STRETCH, side="right")))
        start, stop = begins[i], ends[j - 1]
        up, down = _power(int(stop - start) + 1)
        total = np.zeros(stop - start + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[start:stop]] * up[: stop - start], out=total[1:])
        hashes[i:j] = mix((total[ends[i:j] - start] - total[begins[i:j] - start]) * down[begins[i:j] - start])
        i = j
    firsts = np.searchsorted(begins, np.concatenate(([0], np.cumsum(sizes))))
    return (hashes, firsts, begins) if places else (hashes, firsts)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; the whole sequence as one if it is shorter; none without words."""
    if not len(words):
        return words
    n = min(width, len(words))
    total = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        total = mix(total * np.uint64(_INVERSE) + words[i : len(words) - n + 1 + i])
    return np.unique(total)

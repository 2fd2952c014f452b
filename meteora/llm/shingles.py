"""Word shingles of Arrow text columns as sorted sets of 64-bit hashes.

A word's hash is a polynomial over a random table of its bytes, read off
prefix sums of the whole buffer, and then mixed; a shingle's hash combines
its words' hashes. Two shingles are taken to be equal when their 64-bit
hashes are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes worked on at once; a longer text is worked on by itself.
CHUNK = 1 << 20

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_TABLE[65:91] = _TABLE[97:123]  # A-Z as a-z
_MULT = _rng.integers(1 << 62, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = int(_MULT[0])
_BACK = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK), base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(steps)
        if n > 16 * CHUNK:
            _POWERS.pop(base)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts laid end to end (text d is
    data[cuts[d]:cuts[d + 1]]), and each text's range of words."""
    solid = ~_SPACE[data]
    fresh = np.ones(len(data) + 1, bool)
    fresh[1:-1] = ~solid[:-1]
    fresh[cuts] = True
    starts = np.flatnonzero(solid & fresh[:-1])
    over = np.ones(len(data), bool)
    over[:-1] = ~solid[1:] | fresh[1:-1]
    ends = np.flatnonzero(solid & over) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * _powers(_BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers(_BACK, len(data))[starts]
    return mix(h), np.searchsorted(starts, cuts)


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    h = words[: len(words) - k + 1] * _MULT[k]
    for i in range(1, k):
        h = h + words[i: len(words) - k + 1 + i] * _MULT[k + i]
    return mix(h + np.uint64(k))


def shingle_sets(texts: pa.Array, k: int):
    """The sorted hash set of every text, in order; null and wordless texts
    have the empty set, fewer than ``k`` words make one shingle."""
    if texts.null_count:
        texts = texts.fill_null("")
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        cuts = offsets[at:to + 1] - offsets[at]
        words, bounds = _word_hashes(data[offsets[at]:offsets[to]], cuts)
        every = _shingles(words, k) if len(words) >= k else words[:0]
        for d in range(to - at):
            lo, hi = bounds[d], bounds[d + 1]
            if hi - lo >= k:
                yield np.unique(every[lo:hi - k + 1])
            elif hi > lo:
                yield _shingles(words[lo:hi], int(hi - lo))
            else:
                yield words[:0]
        at = to


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit key of a set."""
    h = np.add.reduce(mix(s * _MULT[60]), keepdims=True) + np.array([len(s)], np.uint64) * _MULT[61]
    return int(mix(h).view(np.int64)[0])


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _MULT[62] + b * _MULT[63])

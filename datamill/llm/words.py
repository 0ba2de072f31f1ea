"""Words and word windows of whole Arrow batches as 64-bit hashes, without Python loops."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20
SEGMENT_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(20240901).integers(1, 2**63, size=256, dtype=np.uint64)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of the hashes over all 64 (the finisher of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _STEP), np.full(n, _STEP_BACK)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of texts of about `limit` bytes: their rows, their bytes, and where each starts.

    A null is an empty text. A text over the limit is a run of its own, never cut.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if len(texts) == 0:
        return
    _, places, data = texts.buffers()
    at = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield slice(first, last), raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_hashes(data: np.ndarray, starts_of_text: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of a block, and where each text starts in that list.

    A word's hash is a polynomial of its bytes modulo 2^64, taken from running sums, then
    mixed. `lower` takes A-Z as a-z.
    """
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(starts_of_text), np.int64)
    inner = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[starts_of_text] = True
    begins, ends = inner.copy(), inner.copy()
    begins[1:] &= ~inner[:-1] | edge[1:n]
    ends[:-1] &= ~inner[1:] | edge[1:n]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    values = _LOWER if lower else _BYTES
    out = np.empty(len(begin), np.uint64)
    word = 0
    while word < len(begin):
        stop = int(np.searchsorted(begin, begin[word] + SEGMENT_BYTES))
        low, high = begin[word], end[stop - 1]
        size = max(SEGMENT_BYTES, 1 << int(high - low).bit_length())
        up, down = _powers(size)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * up[: high - low], out=sums[1:])
        b, e = begin[word:stop] - low, end[word:stop] - low
        out[word:stop] = (sums[e] - sums[b]) * down[b]
        word = stop
    return mix(out), np.searchsorted(begin, starts_of_text)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of `k` words, in order."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = words[:n].copy()
    for j in range(1, k):
        h *= _GRAM
        h += words[j : j + n]
    return mix(h)


def sequence_hash(words: np.ndarray) -> int:
    """A 64-bit hash of a whole word sequence, its length included."""
    if len(words) == 0:
        return 0
    up, _ = _powers(max(SEGMENT_BYTES, 1 << len(words).bit_length()))
    return int(mix(np.array([np.sum(words * up[: len(words)]) + np.uint64(len(words))], np.uint64))[0])

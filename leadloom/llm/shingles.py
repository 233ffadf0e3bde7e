"""Word shingles of texts as 64-bit numbers, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240229)
_CODE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 5
_BACK = pow(_BASE, -1, 2**64)
_LOWER_CODE = _CODE[_LOWER]
#: Bytes that are hashed in one go, few enough for a cache; a longer word makes its block longer.
BLOCK = 1 << 16


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (the usual shift and multiply rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, grown when a block needs more."""

    def __init__(self):
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up, self.down = (np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, b, dtype=np.uint64))])
                                      for b in (_BASE, _BACK))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_edges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of the bytes ``data``."""
    space = np.ones(len(data) + 2, dtype=bool)
    np.take(_SPACE, data, out=space[1:-1])
    change = np.flatnonzero(space[1:] != space[:-1])
    return change[::2], change[1::2]


def _block_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = word_edges(data)
    up, down = _POWERS.get(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LOWER_CODE[data] * up[:len(data)], out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start of every word of ``blob`` (UTF-8, A-Z lower-cased) and its hash."""
    starts, _, hashes = word_spans(blob)
    return starts, hashes


def word_spans(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and hash of every word of ``blob``."""
    data = np.frombuffer(blob, dtype=np.uint8)
    starts, ends, at = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)], 0
    hashes = [np.empty(0, dtype=np.uint64)]
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data):
            # Words are short as a rule, so the last space is looked for near the end first.
            near = max(at, end - 256)
            gaps = np.flatnonzero(_SPACE[data[near:end]])
            if not len(gaps):
                near, gaps = at, np.flatnonzero(_SPACE[data[at:end]])
            if len(gaps):
                end = near + int(gaps[-1]) + 1
                break
            end = min(end + BLOCK, len(data))
        s, e, h = _block_words(data[at:end])
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(h)
        at = end
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def shingle_sets(texts: list[bytes | str | None], k: int) -> list[np.ndarray]:
    """Per text (as is, or its UTF-8) its distinct ``k``-word shingles, sorted; fewer words are one shingle, no word is none."""
    parts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else t or b"" for t in texts]
    edges = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])]).astype(np.int64)
    starts, words = word_hashes(b" ".join(parts))
    bounds = np.searchsorted(starts, edges)
    rolled = np.full(len(words), k, dtype=np.uint64)
    for j in range(k):
        rolled[:max(len(words) - j, 0)] = mix(rolled[:max(len(words) - j, 0)] * np.uint64(3) + words[j:])
    sets = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo >= k:
            one = np.sort(rolled[lo:hi - k + 1])
            new = np.ones(len(one), dtype=bool)
            np.not_equal(one[1:], one[:-1], out=new[1:])
            sets.append(one[new])
        elif hi > lo:
            one = np.full(1, hi - lo, dtype=np.uint64)
            for w in words[lo:hi]:
                one = mix(one * np.uint64(3) + w)
            sets.append(one)
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return sets

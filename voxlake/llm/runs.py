"""Tokens of whole texts by bytes: runs of one character class, hashed together, and a memo of what each distinct run means.

A run stands by its 64-bit hash (mixed with its length); the memo keeps 12 bytes and the ids of a run, never its text.
"""

from __future__ import annotations

import numpy as np

from voxlake.llm.common import spread
from voxlake.llm.repeats import mix

_B = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {"up": np.ones(0, np.uint64), "down": np.ones(0, np.uint64)}
RANDOM = np.random.default_rng(99).integers(1, 2**63, 256, dtype=np.uint64)
FOLDED = RANDOM.copy()  # A-Z like a-z
FOLDED[65:91] = FOLDED[97:123]
SLOTS = 22


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_POWERS["up"]):
        for name, base in (("up", _B), ("down", pow(_B, -1, 1 << 64))):
            _POWERS[name] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n - 1, 0), base, np.uint64)]), dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = FOLDED) -> np.ndarray:
    """Hashes of the pieces of data between starts and ends."""
    up, down = powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up, out=total[1:])
    h = (total[ends] - total[starts]) * down[np.minimum(starts, max(len(data) - 1, 0))] if len(starts) else np.empty(0, np.uint64)
    return mix(h, (ends - starts).astype(np.uint64))


def runs(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of one class other than 0; no run spans two texts."""
    c = classes[data]
    new = np.ones(len(data) + 1, bool)
    new[1:-1] = c[1:] != c[:-1]
    new[offsets] = True
    edges = np.flatnonzero(new)
    starts, ends = edges[:-1], edges[1:]
    keep = c[starts] != 0 if len(data) else np.zeros(0, bool)
    return starts[keep], ends[keep]


class Memo:
    """Numbers of known hashes, and a list of values for each."""

    def __init__(self, most: int):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.table = np.full(1 << SLOTS, -1, np.int32)
        self.keys = np.empty(0, np.uint64)
        self.more_keys, self.more = np.empty(0, np.uint64), np.empty(0, np.int64)  # those whose slot was taken, sorted
        self.flat, self.start = np.empty(0, np.int32), np.zeros(1, np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Number of each hash, or -1."""
        at = self.table[(h >> np.uint64(64 - SLOTS)).astype(np.int64)].astype(np.int64)
        if not len(self.keys):
            return at
        miss = np.flatnonzero((at < 0) | (self.keys[at] != h))
        at[miss] = -1
        if len(self.more_keys) and len(miss):
            k = np.minimum(np.searchsorted(self.more_keys, h[miss]), len(self.more_keys) - 1)
            hit = self.more_keys[k] == h[miss]
            at[miss[hit]] = self.more[k[hit]]
        return at

    def add(self, h: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        """New distinct hashes with their values."""
        number = np.arange(len(self.keys), len(self.keys) + len(h))
        slot = (h >> np.uint64(64 - SLOTS)).astype(np.int64)
        free = self.table[slot] < 0
        self.table[slot[free][::-1]] = number[free][::-1]
        late = self.table[slot] != number
        keys, more = np.concatenate([self.more_keys, h[late]]), np.concatenate([self.more, number[late]])
        order = np.argsort(keys)
        self.more_keys, self.more = keys[order], more[order]
        self.keys = np.concatenate([self.keys, h])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])

    def values(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All values of some numbers, and how many each has."""
        sizes = self.start[at + 1] - self.start[at]
        return self.flat[np.repeat(self.start[at], sizes) + spread(sizes)], sizes


def unknown(memo: Memo, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of hashes: the distinct new ones, and a place of each."""
    at = np.flatnonzero(memo.find(h) < 0)
    new, first = np.unique(h[at], return_index=True)
    return new, at[first]

"""A read-only map from uint64 keys to row numbers, with vectorised lookups (linear probing)."""

from __future__ import annotations

import numpy as np

_FIBONACCI = np.uint64(0x9E3779B97F4A7C15)


class HashTable:
    """Maps ``keys[i]`` (distinct) to ``i``; ``find`` gives -1 for absent keys."""

    def __init__(self, keys: np.ndarray) -> None:
        keys = np.ascontiguousarray(keys, np.uint64)
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.rows = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._slot(keys)
        while len(left):
            free = self.rows[slot] < 0
            first, chosen = np.unique(slot[free], return_index=True)
            winners = left[free][chosen]
            self.rows[first], self.keys[first] = winners, keys[winners]
            lost = self.rows[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _FIBONACCI) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = self.rows[slot]
        todo = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self.mask
            row = self.rows[slot]
            out[todo] = row
            more = (self.keys[slot] != keys[todo]) & (row >= 0)
            todo, slot = todo[more], slot[more]
        return out

"""Cuckoo filter over 16-byte keys with batch operations in numpy.

Buckets of four 16-bit fingerprints; a key lives in one of two buckets that
are computable from each other and the fingerprint.  Unlike a Bloom filter
it supports deletion.  ``contains`` has no false negatives.
"""

from __future__ import annotations

import numpy as np

SLOTS, MAX_ROUNDS, LOAD = 4, 500, 0.8


def split_keys(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """16-byte keys as two vectors of 64-bit words."""
    words = np.frombuffer(blob, dtype="<u8").reshape(-1, 2)
    return words[:, 0], words[:, 1]


class CuckooFilter:
    def __init__(self, buckets: int):
        self.slots = np.zeros((buckets, SLOTS), dtype=np.uint16)

    @classmethod
    def sized_for(cls, keys: int) -> CuckooFilter:
        return cls(1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD))))))

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        out = cls(1)
        out.slots = np.frombuffer(data, dtype=np.uint16).reshape(-1, SLOTS).copy()
        return out

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()

    @property
    def mask(self) -> np.uint64:
        return np.uint64(len(self.slots) - 1)

    def _place(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = (a & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        return mark, (b & self.mask).astype(np.int64)

    def _other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        jump = (mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        return (bucket.astype(np.uint64) ^ (jump & self.mask)).astype(np.int64)

    def contains(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mark, first = self._place(a, b)
        second = self._other(mark, first)
        return ((self.slots[first] == mark[:, None]) | (self.slots[second] == mark[:, None])).any(axis=1)

    def insert(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Insert distinct keys; False if they don't fit (grow and rebuild)."""
        mark, bucket = self._place(a, b)
        for step in range(MAX_ROUNDS):
            if not len(mark):
                return True
            order = np.argsort(bucket, kind="stable")
            mark, bucket = mark[order], bucket[order]
            start = np.concatenate([[True], bucket[1:] != bucket[:-1]])
            rank = np.arange(len(bucket)) - np.flatnonzero(start)[np.cumsum(start) - 1]
            free = self.slots[bucket] == 0
            fits = rank < free.sum(axis=1)
            if fits.any():  # the rank-th pending key of a bucket takes its rank-th free slot
                nth = np.cumsum(free[fits], axis=1) == (rank[fits] + 1)[:, None]
                self.slots[bucket[fits], np.argmax(nth & free[fits], axis=1)] = mark[fits]
            mark, bucket, rank = mark[~fits], bucket[~fits], rank[~fits]
            if step >= 2 and len(mark):  # evict one resident per contended bucket
                lead = np.concatenate([[True], bucket[1:] != bucket[:-1]])
                slot = (step + bucket[lead]) % SLOTS
                mark[lead], self.slots[bucket[lead], slot] = self.slots[bucket[lead], slot].copy(), mark[lead]
            bucket = self._other(mark, bucket)
        return not len(mark)

    def delete(self, a: np.ndarray, b: np.ndarray) -> None:
        """Remove keys that were inserted before (one entry each)."""
        mark, first = self._place(a, b)
        second = self._other(mark, first)
        for m, i, j in zip(mark, first, second):
            for at in (i, j):
                hit = np.flatnonzero(self.slots[at] == m)
                if len(hit):
                    self.slots[at, hit[0]] = 0
                    break


def filled(a: np.ndarray, b: np.ndarray) -> CuckooFilter:
    """A filter of sufficient size that holds the given distinct keys."""
    f = CuckooFilter.sized_for(len(a))
    while not f.insert(a, b):
        f = CuckooFilter(2 * len(f.slots))
    return f

"""A cuckoo filter over 64-bit keys in numpy: insert, look up and delete in bulk."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MAX_ROUNDS = 400


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class CuckooFilter:
    """16-bit fingerprints, four to a bucket; a key's second bucket follows
    from its first and its fingerprint, so entries can move and be deleted
    without the key.  A false positive has a chance of about 8 / 65,535; there
    are no false negatives for keys that were inserted and not deleted.
    """

    def __init__(self, capacity: int, cells: np.ndarray | None = None):
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, capacity) / SLOTS / 0.8))))
        self.cells = np.zeros((buckets, SLOTS), np.uint16) if cells is None else cells
        self.mask = np.uint64(len(self.cells) - 1)

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter that holds ``keys``; twice the room, if they don't fit."""
        room = len(keys)
        while True:
            made = cls(room)
            if made.insert(keys):
                return made
            room *= 2

    @classmethod
    def loads(cls, data: bytes) -> CuckooFilter:
        return cls(0, np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dumps(self) -> bytes:
        return self.cells.tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = mixed(keys.astype(np.uint64))
        mark = (h >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        one = h & self.mask
        return mark, one.astype(np.int64), self.other(one, mark)

    def other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return ((bucket.astype(np.uint64) ^ mixed(mark.astype(np.uint64))) & self.mask).astype(np.int64)

    def put(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Put marks into free slots of their buckets; which found one."""
        done = np.zeros(len(mark), bool)
        for slot in range(SLOTS):
            todo = np.flatnonzero(~done & (self.cells[bucket, slot] == 0))
            if len(todo):
                _, first = np.unique(bucket[todo], return_index=True)
                todo = todo[first]
                self.cells[bucket[todo], slot] = mark[todo]
                done[todo] = True
        return done

    def insert(self, keys: np.ndarray) -> bool:
        """Add each key once; False if the filter is too full (use a larger one)."""
        mark, one, two = self.places(keys)
        for turn in range(2 * SLOTS):  # keys of one bucket take turns
            if not len(mark):
                return True
            left = ~self.put(mark, one if turn < SLOTS else two)
            mark, one, two = mark[left], one[left], two[left]
        bucket, turn = one, 0
        while len(mark):
            if turn == MAX_ROUNDS:
                return False
            # One entry of each bucket moves to its other place to make room.
            _, first = np.unique(bucket, return_index=True)
            slot = (mark[first].astype(np.int64) + turn) % SLOTS
            at = bucket[first]
            out = self.cells[at, slot].copy()
            self.cells[at, slot] = mark[first]
            wait = np.ones(len(mark), bool)
            wait[first] = False
            mark, bucket = np.concatenate([mark[wait], out]), np.concatenate([bucket[wait], self.other(at, out)])
            left = (mark != 0) & ~self.put(mark, bucket)
            mark, bucket = mark[left], bucket[left]
            turn += 1
        return True

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(keys)
        mark = mark[:, None]
        return (self.cells[one] == mark).any(axis=1) | (self.cells[two] == mark).any(axis=1)

    def delete(self, keys: np.ndarray) -> None:
        """Take out one entry of each key; only keys that are in may be given."""
        mark, one, two = self.places(keys)
        for turn in range(2 * SLOTS):
            while len(mark):
                bucket = one if turn < SLOTS else two
                hit = np.flatnonzero(self.cells[bucket, turn % SLOTS] == mark)
                if not len(hit):
                    break
                _, first = np.unique(bucket[hit], return_index=True)
                hit = hit[first]
                self.cells[bucket[hit], turn % SLOTS] = 0
                left = np.ones(len(mark), bool)
                left[hit] = False
                mark, one, two = mark[left], one[left], two[left]

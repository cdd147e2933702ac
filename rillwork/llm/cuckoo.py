"""A cuckoo filter over 16-byte digests, with deletion."""

from __future__ import annotations

import numpy as np

SLOTS, KICKS = 4, 500


class CuckooFilter:
    """Buckets of four 16-bit marks. ``full`` is set once an insertion fails; such a filter answers
    "maybe" to everything until it is built anew, so an overflow loses nothing."""

    def __init__(self, buckets: int, table: np.ndarray | None = None, full: bool = False):
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table
        self.full = full

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """Room for ``keys`` at a load of at most a half."""
        return cls(1 << max(4, int(np.ceil(np.log2(max(keys, 1) / SLOTS * 2)))))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        table = np.frombuffer(data, np.uint16, offset=2).reshape(-1, SLOTS).copy()
        return cls(len(table), table, bool(data[0]))

    def dump(self) -> bytes:
        return bytes([self.full, 0]) + self.table.tobytes()

    def places(self, keys: list[bytes]):
        """Mark, first and second bucket of each key."""
        words = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
        mask = np.uint64(len(self.table) - 1)
        mark = (words[:, 1] % np.uint64(65_535) + np.uint64(1)).astype(np.uint16)
        one = words[:, 0] & mask
        return mark, one.astype(np.int64), (one ^ self.step(mark)).astype(np.int64)

    def step(self, mark):
        mixed = np.asarray(mark, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(20)) & np.uint64(len(self.table) - 1)

    def contains(self, keys: list[bytes]) -> np.ndarray:
        if self.full or not keys:
            return np.ones(len(keys), bool)
        mark, one, two = self.places(keys)
        mark = mark[:, None]
        return (self.table[one] == mark).any(1) | (self.table[two] == mark).any(1)

    def insert(self, keys: list[bytes]) -> None:
        if not keys or self.full:
            return
        for mark, one, two in zip(*self.places(keys)):
            for spot in (one, two):
                if len(empty := np.flatnonzero(self.table[spot] == 0)):
                    self.table[spot, empty[0]] = mark
                    break
            else:
                if not self._kick(mark, two):
                    self.full = True
                    return

    def _kick(self, mark, spot) -> bool:
        for turn in range(KICKS):
            slot = turn % SLOTS
            mark, self.table[spot, slot] = self.table[spot, slot], mark
            spot = int(spot) ^ int(self.step(mark))
            if len(empty := np.flatnonzero(self.table[spot] == 0)):
                self.table[spot, empty[0]] = mark
                return True
        return False

    def remove(self, keys: list[bytes]) -> None:
        """Only for keys that were inserted."""
        if not keys or self.full:
            return
        for mark, one, two in zip(*self.places(keys)):
            for spot in (one, two):
                if len(held := np.flatnonzero(self.table[spot] == mark)):
                    self.table[spot, held[0]] = 0
                    break

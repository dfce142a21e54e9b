"""A cuckoo filter on numpy: members can be added and taken out again, many at a time.

A member (a 64-bit hash) leaves a 16-bit mark in one of two buckets of four slots; each bucket follows from the mark and
the other bucket. An answer of no is always right; one of yes is wrong for about 1 in 8000 strangers.
"""

import numpy as np

SLOTS = 4
LOAD = 0.8
TURNS = 500
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class CuckooFilter:
    def __init__(self, table: np.ndarray):
        self.table, self.mask = table, np.uint64(len(table) - 1)

    @classmethod
    def sized(cls, members: int) -> "CuckooFilter":
        """An empty filter in which ``members`` find a place."""
        buckets = 1 << max(3, int(np.ceil(np.log2(max(1, members) / (SLOTS * LOAD)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> "CuckooFilter":
        return cls(np.frombuffer(data, "<u2").reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _other(self, mark: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ ((mark.astype(np.uint64) * FACTOR >> np.uint64(32)) & self.mask)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mark = np.maximum(hashes >> np.uint64(48), np.uint64(1)).astype(np.uint16)
        return mark, hashes & self.mask

    def _settle(self, mark: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put marks into free slots of their buckets; those left over come back."""
        order = np.argsort(at, kind="stable")
        mark, at = mark[order], at[order]
        begins = np.concatenate([[True], at[1:] != at[:-1]])
        rank = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        free = self.table[at] == 0
        fits = rank < free.sum(1)
        slot = (free & (np.cumsum(free, 1) == rank[:, None] + 1)).argmax(1)
        self.table[at[fits], slot[fits]] = mark[fits]
        return mark[~fits], at[~fits]

    def insert(self, hashes: np.ndarray) -> bool:
        """Add members. False if one finds no place: the filter is then of no use and must be rebuilt larger."""
        mark, at = self._places(hashes)
        for turn in range(TURNS):
            for _ in range(2):
                if not len(mark):
                    return True
                mark, at = self._settle(mark, at)
                at = self._other(mark, at)
            if not len(mark):
                return True
            # In each full bucket one mark takes the slot of another, which moves to its other bucket.
            _, one = np.unique(at, return_index=True)
            slot = turn % SLOTS
            mark[one], self.table[at[one], slot] = self.table[at[one], slot], mark[one]
            at[one] = self._other(mark[one], at[one])
        return not len(mark)

    def remove(self, hashes: np.ndarray) -> None:
        """Take members out; only what was inserted may be removed."""
        mark, first = self._places(hashes)
        second = self._other(mark, first)
        while len(mark):
            at = np.where((self.table[first] == mark[:, None]).any(1), first, second)
            _, one = np.unique(at, return_index=True)
            same = self.table[at[one]] == mark[one][:, None]
            found = same.any(1)
            self.table[at[one][found], same.argmax(1)[found]] = 0
            rest = np.ones(len(mark), bool)
            rest[one] = False
            mark, first, second = mark[rest], first[rest], second[rest]

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        mark, at = self._places(hashes)
        other = self._other(mark, at)
        return ((self.table[at] == mark[:, None]) | (self.table[other] == mark[:, None])).any(1)

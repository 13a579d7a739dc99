"""Cuckoo filters in numpy: sets of 64-bit keys that forget keys again.

A key has a 16-bit fingerprint and two buckets of four places; the second
bucket follows from the first and the fingerprint, so that an entry can move
without its key.  All operations take many keys at once.  A filter answers
"held" for every key it holds and, rarely, for one it does not hold; a key may
only be removed if it is held.
"""

from __future__ import annotations

import numpy as np

from seawake.llm.common import mixed

PLACES = 4
#: Filters are made for at most this share of their places.
LOAD = 0.85
ROUNDS = 500


class Cuckoo:
    def __init__(self, places: np.ndarray):
        """``places``: one row of fingerprints for each bucket, 0 where free; a power of two of rows."""
        self.places = places
        self.mask = np.uint64(len(places) - 1)

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        """An empty filter with room for so many keys."""
        buckets = max(2, 1 << (int(max(1, keys) / (LOAD * PLACES))).bit_length())
        return cls(np.zeros((buckets, PLACES), np.uint16))

    @classmethod
    def from_bytes(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, "<u2").reshape(-1, PLACES).astype(np.uint16))

    def to_bytes(self) -> bytes:
        return self.places.astype("<u2").tobytes()

    @property
    def held(self) -> int:
        return int(np.count_nonzero(self.places))

    def has_room(self, more: int) -> bool:
        return self.held + more <= LOAD * self.places.size

    def _entries(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mixed(keys.astype(np.uint64, copy=False))
        marks = (h >> np.uint64(48)).astype(np.uint16)
        marks[marks == 0] = 1
        return marks, (h & self.mask).astype(np.int64)

    def _other(self, marks: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        return buckets ^ (mixed(marks.astype(np.uint64)) & self.mask).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        marks, one = self._entries(keys)
        two = self._other(marks, one)
        return (self.places[one] == marks[:, None]).any(axis=1) | (self.places[two] == marks[:, None]).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """Add keys that are not held; False if there was no place, and the filter is of no use any more."""
        marks, at = self._entries(keys)
        for turn in range(ROUNDS):
            for _ in range(2):  # a free place in this bucket, else in the other one
                marks, at = self._settled(marks, at)
                if not len(marks):
                    return True
                at = self._other(marks, at)
            # one entry of each bucket makes room and goes to its other bucket
            buckets, first = np.unique(at, return_index=True)
            out = self.places[buckets, turn % PLACES]
            self.places[buckets, turn % PLACES] = marks[first]
            waiting = np.ones(len(marks), bool)
            waiting[first] = False
            marks = np.r_[marks[waiting], out]
            at = np.r_[at[waiting], self._other(out, buckets)]
        return False

    def _settled(self, marks: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fill free places; what is left."""
        order = np.argsort(at, kind="stable")
        marks, at = marks[order], at[order]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
        free = self.places[at] == 0
        fits = rank < free.sum(axis=1)
        nth = np.cumsum(free[fits], axis=1) == rank[fits, None] + 1
        place = np.argmax(nth & free[fits], axis=1)
        self.places[at[fits], place] = marks[fits]
        return marks[~fits], at[~fits]

    def remove(self, keys: np.ndarray) -> None:
        """Forget keys that are held."""
        marks, one = self._entries(keys)
        while len(marks):
            # equal entries of one bucket go one after the other
            two = self._other(marks, one)
            first = np.unique(np.minimum(one, two) << 16 | marks, return_index=True)[1]
            m, a, b = marks[first], one[first], two[first]
            here = (self.places[a] == m[:, None]).any(axis=1)
            bucket = np.where(here, a, b)
            found = self.places[bucket] == m[:, None]
            if not found.any(axis=1).all():
                raise ValueError("a key is removed that is not held")
            self.places[bucket, np.argmax(found, axis=1)] = 0
            rest = np.ones(len(marks), bool)
            rest[first] = False
            marks, one = marks[rest], one[rest]

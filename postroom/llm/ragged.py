"""Slices of different lengths in one growing numpy array."""

from __future__ import annotations

import numpy as np


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of ``pool`` in a row."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class Column:
    """A numpy array that grows at its end."""

    def __init__(self, dtype: type) -> None:
        self.room = np.zeros(1024, dtype)
        self.size = 0

    def extend(self, more: np.ndarray) -> None:
        if self.size + len(more) > len(self.room):
            room = np.zeros(max(2 * len(self.room), self.size + len(more)), self.room.dtype)
            room[: self.size] = self.values
            self.room = room
        self.room[self.size : self.size + len(more)] = more
        self.size += len(more)

    @property
    def values(self) -> np.ndarray:
        return self.room[: self.size]


class Slices:
    """Slice ``i`` is ``pool[start[i]:][:length[i]]``."""

    def __init__(self, dtype: type = np.int32) -> None:
        self.pool = Column(dtype)
        self.start = Column(np.int64)
        self.length = Column(np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> int:
        """Append slices; returns the number of the first one."""
        first = self.start.size
        self.start.extend(self.pool.size + np.cumsum(lengths) - lengths)
        self.length.extend(lengths)
        self.pool.extend(flat)
        return first

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The named slices in a row, and their lengths."""
        lengths = self.length.values[which]
        return gather(self.pool.values, self.start.values[which], lengths), lengths

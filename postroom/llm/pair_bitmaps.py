"""Which documents hold a pair, and how often: compressed bitmaps with planes.

The documents of a block have slots 0, 1, 2, ... For each pair, plane ``k`` is the
set of slots whose multiplicity has bit ``k``; the union of its planes is the set
of documents that hold the pair. A set is kept as the shorter of two forms: its
slots as 16-bit numbers, or a bitmap over the block. Blocks have different
documents, so over blocks sets are joined by putting them side by side, and
counts are added.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Slots of a block at most: they are 16-bit numbers.
SLOTS = 1 << 14


@dataclass
class PairSets:
    """The sets of a block, ordered by pair and plane."""

    n_slots: int
    pair: np.ndarray  # one entry for each set
    plane: np.ndarray
    size: np.ndarray  # slots of the set; a bitmap is as long as the block needs
    data: bytes

    @property
    def width(self) -> int:
        """Bytes of a bitmap over the block."""
        return -(-self.n_slots // 8)


def build(pair: np.ndarray, slot: np.ndarray, times: np.ndarray, n_slots: int) -> PairSets:
    """Sets from distinct (pair, slot) with their multiplicities."""
    if n_slots > 1 << 16:
        raise ValueError("a block has more slots than 16 bits can number")
    parts = []
    for k in range(int(times.max(initial=0)).bit_length()):
        has = (times >> k) & 1 == 1
        parts.append((pair[has], np.full(int(has.sum()), k, np.int8), slot[has]))
    if not parts:
        nothing = np.zeros(0, np.int64)
        return PairSets(n_slots, nothing, nothing.astype(np.int8), nothing.astype(np.int32), b"")
    pair, plane, slot = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((slot, plane, pair))
    pair, plane, slot = pair[order], plane[order], slot[order]
    first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (plane[1:] != plane[:-1])])
    size = np.diff(np.r_[first, len(pair)])
    sets = PairSets(n_slots, pair[first], plane[first], size.astype(np.int32), b"")
    as_map = 2 * size > sets.width
    raw, pieces, done = slot.astype("<u2"), [], 0
    for i in np.flatnonzero(as_map):
        start, end = first[i], first[i] + size[i]
        pieces.append(raw[done:start].tobytes())
        bits = np.zeros(8 * sets.width, np.uint8)
        bits[slot[start:end]] = 1
        pieces.append(np.packbits(bits, bitorder="little").tobytes())
        done = end
    sets.data = b"".join([*pieces, raw[done:].tobytes()])
    return sets


def _spans(sets: PairSets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each set is a bitmap, and where its bytes start and end."""
    as_map = 2 * sets.size.astype(np.int64) > sets.width
    length = np.where(as_map, sets.width, 2 * sets.size.astype(np.int64))
    ends = np.cumsum(length)
    return as_map, ends - length, ends


def members(sets: PairSets) -> tuple[np.ndarray, np.ndarray]:
    """The postings: number of the set and slot, for every member."""
    as_map, start, end = _spans(sets)
    data = np.frombuffer(sets.data, np.uint8)
    of_map = [
        np.flatnonzero(np.unpackbits(data[start[i] : end[i]], bitorder="little"))
        for i in np.flatnonzero(as_map)
    ]
    in_list = np.repeat(~as_map, end - start)
    listed = data[in_list].view("<u2")
    number = np.repeat(np.flatnonzero(~as_map), sets.size[~as_map])
    mapped = np.repeat(np.flatnonzero(as_map), [len(m) for m in of_map])
    slots = np.concatenate([listed.astype(np.int64), *of_map])
    return np.concatenate([number, mapped]).astype(np.int64), slots


def popcounts(sets: PairSets) -> np.ndarray:
    """Members of each set, counted in the sets themselves."""
    as_map, start, end = _spans(sets)
    data = np.frombuffer(sets.data, np.uint8)
    found = (end - start) // 2
    for i in np.flatnonzero(as_map):
        found[i] = np.bitwise_count(data[start[i] : end[i]]).sum()
    return found


def totals(sets: PairSets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each pair with its documents and links in the block.

    Links are the planes' popcounts by place value; documents the popcount of the
    planes' union, which is needed only where a pair has more than one plane.
    """
    if not len(sets.pair):
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    first = np.flatnonzero(np.r_[True, sets.pair[1:] != sets.pair[:-1]])
    counts = popcounts(sets)
    links = np.add.reduceat(counts << sets.plane.astype(np.int64), first)
    docs = counts[first].copy()
    planes = np.diff(np.r_[first, len(sets.pair)])
    number, slots = members(sets)
    group = np.repeat(np.arange(len(first)), planes)[number]
    several = planes[group] > 1
    union = np.unique(group[several] << 16 | slots[several])
    docs[planes > 1] = np.bincount(union >> 16, minlength=len(first))[planes > 1]
    return sets.pair[first], docs, links


def spread(sets: PairSets, pair: np.ndarray, scores: list[np.ndarray]) -> list[np.ndarray]:
    """For every slot the sum of its pairs' scores, by multiplicity.

    ``pair`` is sorted and holds all pairs of the sets.
    """
    if not len(sets.pair):
        return [np.zeros(sets.n_slots, np.int64) for _ in scores]
    number, slots = members(sets)
    times = np.int64(1) << sets.plane.astype(np.int64)[number]
    at = np.searchsorted(pair, sets.pair)[number]
    out = []
    for score in scores:
        sums = np.zeros(sets.n_slots, np.int64)
        np.add.at(sums, slots, score[at] * times)
        out.append(sums)
    return out

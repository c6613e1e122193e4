"""Cheapest edits of a sequence of roles, by tables over blocks of symbols.

The roles that are left must read ``(s?(ua)+)?``. Four states say what has been
given so far: nothing, a system turn, a user turn, an assistant turn. The cost
vector of a place holds, for each state, the least cost of all that follows.
Less its smallest entry such a vector is one of a few dozen, so a table over
(vector, block of symbols) can be worked out once: a whole block is then one
lookup, and the costs add up beside it (the method of the Four Russians).

Which edits are cheapest is read from the front. Each block is expanded back
from the vector behind it, and at every row the ASCII-least edit that keeps to
the least cost is taken. Edit and state settle the next state, so that gives
the least of all cheapest edit strings. Expanded blocks are remembered.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Rows of a block.
BLOCK = 4

# Symbols of a row: its role, +4 when truncated; to be deleted; no row at all.
ROLES = "sua"
OTHER, CUT, DROP, PAD = 3, 4, 8, 9
N_SYMBOLS = 10

# States: nothing, system, user, assistant; what keeping a row of role s, u, a
# leads to, and what an inserted or changed row leads to (user or assistant).
_KEPT = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
GIVEN = (2, 2, 3, 2)
ROLE_OF = (None, None, "user", "assistant")
N_STATES = 4
ACCEPTED = (True, False, False, True)

NEVER = 1 << 20
Vector = tuple[int, ...]


def symbol(initial: str, truncated: bool, to_delete: bool) -> int:
    if to_delete:
        return DROP
    at = ROLES.find(initial) if initial else -1
    return (at if at >= 0 else OTHER) + (CUT if truncated else 0)


def _uses(row: int, state: int) -> list[tuple[str, int, int]]:
    """Edits that use up a row: initial, cost, state after it."""
    found = [("D", DELETE, state)]
    if row != DROP:
        extra = TRUNCATED if row >= CUT else 0
        kept = _KEPT[state].get(row % CUT)
        if kept is not None:
            found.append(("K", extra, kept))
        found.append(("R", REROLE + extra, GIVEN[state]))
    return found


def _with_inserts(costs: list[int]) -> Vector:
    for _ in range(2):  # more than two rows in a place are never needed
        costs = [min(c, INSERT + costs[GIVEN[q]], NEVER) for q, c in enumerate(costs)]
    return tuple(costs)


def before(row: int, after: Vector) -> Vector:
    """The cost vector before a row from the one behind it."""
    if row == PAD:
        return after
    return _with_inserts([min(c + after[n] for _, c, n in _uses(row, q)) for q in range(N_STATES)])


def normalised(costs: Vector) -> tuple[Vector, int]:
    low = min(costs)
    return tuple(c - low if c < NEVER else NEVER for c in costs), low


#: Behind the last row: nothing more, or rows that complete the last pair.
END = _with_inserts([0 if a else NEVER for a in ACCEPTED])
#: Vectors that ask for one certain state, for stretches of a sequence.
UNITS = tuple(tuple(0 if i == q else NEVER for i in range(N_STATES)) for q in range(N_STATES))


class Tables:
    """Transitions of normalised cost vectors for every block of symbols."""

    def __init__(self, block: int = BLOCK) -> None:
        self.block = block
        self.vectors: list[Vector] = []
        self.number: dict[Vector, int] = {}
        for v in (END, *UNITS):
            self._add(normalised(v)[0])
        step, cost, v = [], [], 0
        while v < len(self.vectors):
            found = [normalised(before(s, self.vectors[v])) for s in range(N_SYMBOLS)]
            step.append([self._add(n) for n, _ in found])
            cost.append([c for _, c in found])
            v += 1
        one, paid = np.array(step, np.int16), np.array(cost, np.int32)
        self.to, self.paid = one, paid
        for _ in range(block - 1):  # one more symbol in front
            v, s = len(self.vectors), self.to.shape[1]
            self.paid = (self.paid[:, None, :] + paid[self.to].transpose(0, 2, 1)).reshape(v, N_SYMBOLS * s)
            self.to = one[self.to].transpose(0, 2, 1).reshape(v, N_SYMBOLS * s)

    def _add(self, v: Vector) -> int:
        if v not in self.number:
            self.number[v] = len(self.vectors)
            self.vectors.append(v)
        return self.number[v]

    def blocks(self, rows: list[int]) -> list[int]:
        """Codes of the blocks of a sequence, padded in front."""
        rows = [PAD] * (-len(rows) % self.block) + rows
        codes = [0] * (len(rows) // self.block)
        for i, s in enumerate(rows):
            codes[i // self.block] = codes[i // self.block] * N_SYMBOLS + s
        return codes

    def behind(self, codes: list[int], last: Vector) -> tuple[list[int], Vector]:
        """The number of the vector behind each block, and the costs before the first."""
        least, total = normalised(last)
        v, numbers = self._known(least), []
        for code in reversed(codes):
            numbers.append(v)
            total += int(self.paid[v, code])
            v = int(self.to[v, code])
        first = tuple(c + total if c < NEVER else NEVER for c in self.vectors[v])
        return numbers[::-1], first

    def _known(self, v: Vector) -> int:
        if v not in self.number:
            raise ValueError(f"{v} is no vector of costs that can come about")
        return self.number[v]

    def expand(self, code: int, v: int, state: int) -> tuple[str, int]:
        """Edits of a block that is entered in ``state`` and followed by vector ``v``."""
        rows = [code // N_SYMBOLS**k % N_SYMBOLS for k in range(self.block)][::-1]
        costs = [self.vectors[v]]
        for s in reversed(rows):
            costs.append(before(s, costs[-1]))
        costs.reverse()
        audit = ""
        for i, s in enumerate(rows):
            while s != PAD:
                here = costs[i][state]
                ways = [(e, c, n, costs[i + 1]) for e, c, n in _uses(s, state)]
                ways.append(("I", INSERT, GIVEN[state], costs[i]))
                edit, _, state, _ = next(w for w in sorted(ways) if w[1] + w[3][w[2]] == here)
                audit += edit
                if edit != "I":
                    break
        return audit, state

    def edits(self, codes: list[int], numbers: list[int], state: int) -> tuple[str, int]:
        """Edits of a sequence of blocks and the state after it."""
        audit = []
        for code, v in zip(codes, numbers):
            piece, state = _expanded(self, code, v, state)
            audit.append(piece)
        return "".join(audit), state


@cache
def tables(block: int = BLOCK) -> Tables:
    """The tables of a worker; they depend on nothing but the block's length."""
    return Tables(block)


@cache
def _expanded(made: Tables, code: int, v: int, state: int) -> tuple[str, int]:
    return made.expand(code, v, state)


def closing(state: int) -> str:
    """Rows inserted behind the last one."""
    audit = ""
    while not ACCEPTED[state]:
        audit, state = audit + "I", GIVEN[state]
    return audit


def cheapest(rows: list[int], block: int = BLOCK) -> tuple[int, str]:
    """Cost and edits of a whole sequence."""
    made = tables(block)
    codes = made.blocks(rows)
    numbers, costs = made.behind(codes, END)
    audit, state = made.edits(codes, numbers, 0)
    return costs[0], audit + closing(state)


def repaired(turns: list[tuple[str, str]], audit: str, state: int = 0) -> list[tuple[str, str]]:
    """Role and text of the rows that a string of edits leaves."""
    out, at = [], 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else turns[at]
        at += edit != "I"
        if edit == "D":
            continue
        if edit == "K":
            state = _KEPT[state][ROLES.find(role[:1])]
        else:
            state = GIVEN[state]
            role = ROLE_OF[state]
        out.append((role, text))
    return out

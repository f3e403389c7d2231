"""Cheapest edits of a sequence of messages, as a shortest path in min-plus algebra over runs of equal symbols.

A symbol is a message's role initial (s, u, a or another) with a fault mark. Four states say what has been written so
far: nothing, a system message, an open question, a closed answer. A row of a symbol is a 4 x 4 min-plus matrix of
costs between states; a run of n equal rows is the n-th power, of which the binary powers are cached. Costs to the end
are known at the borders of runs first; inside a run they are found by halving, as its choices are unrolled.

Choices are the letters D (delete), I (insert before), K (keep) and R (give the role that is due). From a state each
letter leads to one state, so taking the first letter that is still cheapest gives the least of all cheapest audits.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
FAR = 1 << 60
STATES = range(4)
#: The state after the message that is due in each state, and that message's role.
DUE = (2, 2, 3, 2)
DUE_ROLE = ("user", "user", "assistant", "user")
#: Where keeping a message of each initial leads from each state.
KEEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
INITIALS = "sua"
#: Symbols: 2 * initial + truncated, and one for messages that must go.
GONE = 8
ACCEPT: Vector = (0, FAR, FAR, 0)


def symbol(initial: str, gone: bool, truncated: bool) -> int:
    """Symbol of a message by the first character of its role and its fault."""
    if gone:
        return GONE
    place = INITIALS.find(initial) if initial else -1
    return 2 * (place if place >= 0 else 3) + truncated


def times(a: Matrix, b: Matrix) -> Matrix:
    columns = tuple(zip(*b, strict=True))
    return tuple(tuple(min(FAR, *(x + y for x, y in zip(row, col, strict=True))) for col in columns) for row in a)


def apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(FAR, *(x + y for x, y in zip(row, v, strict=True))) for row in a)


UNIT: Matrix = tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)


def _inserts() -> Matrix:
    once = tuple(tuple(0 if i == j else INSERT if DUE[i] == j else FAR for j in STATES) for i in STATES)
    return times(once, times(once, once))


INSERTS = _inserts()
END: Vector = apply(INSERTS, ACCEPT)


def _choices(sym: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a row, in the order of the letters."""
    out = [("D", DELETE, state)]
    if sym != GONE:
        extra = TRUNCATED * (sym % 2)
        kept = KEEP.get("sua?"[sym // 2], {}).get(state)
        if kept is not None:
            out.append(("K", extra, kept))
        out.append(("R", REROLE + extra, DUE[state]))
    return out


@lru_cache(maxsize=None)
def power(sym: int, k: int) -> Matrix:
    """Costs of 2 ** k rows of a symbol, with inserts before each."""
    if k:
        half = power(sym, k - 1)
        return times(half, half)
    rows = [[FAR] * 4 for _ in STATES]
    for state in STATES:
        for _, cost, after in _choices(sym, state):
            rows[state][after] = min(rows[state][after], cost)
    return times(INSERTS, tuple(map(tuple, rows)))


def before(sym: int, n: int, after: Vector) -> Vector:
    """Costs to the end before a run, from those after it."""
    k = 0
    while n:
        if n & 1:
            after = apply(power(sym, k), after)
        n >>= 1
        k += 1
    return after


def run_matrix(sym: int, n: int) -> Matrix:
    out, k = UNIT, 0
    while n:
        if n & 1:
            out = times(out, power(sym, k))
        n >>= 1
        k += 1
    return out


def matrix(runs: Iterable[tuple[int, int]]) -> Matrix:
    """Costs of a sequence of runs between states."""
    out = UNIT
    for sym, n in runs:
        out = times(out, run_matrix(sym, n))
    return out


@lru_cache(maxsize=1 << 14)
def _unrolled(sym: int, n: int, state: int, after: Vector) -> tuple[str, int]:
    if n == 1:
        costs, letters = before(sym, 1, after), []
        while True:
            options = _choices(sym, state)
            options.insert(1, ("I", INSERT, -1))
            for letter, cost, then in options:
                rest = costs[DUE[state]] if letter == "I" else after[then]
                if cost + rest == costs[state]:
                    letters.append(letter)
                    break
            if letter != "I":
                return "".join(letters), then
            state = DUE[state]
    half = n // 2
    first, state = _unrolled(sym, half, state, before(sym, n - half, after))
    second, state = _unrolled(sym, n - half, state, after)
    return first + second, state


def _lifted(after: Vector) -> tuple[Vector, int]:
    """A vector less its least entry, so that equal shapes share what is cached."""
    least = min(after)
    return tuple(x if x >= FAR else x - least for x in after), least


def unroll(runs: list[tuple[int, int]], state: int, after: Vector) -> tuple[str, int]:
    """Letters of the cheapest way through the runs from a state, and the state it ends in.

    The letters of inserts after the last row are not among them, see ``ending``.
    """
    costs = [_lifted(after)[0]]
    for sym, n in reversed(runs):
        costs.append(_lifted(before(sym, n, costs[-1]))[0])
    costs.pop()
    letters = []
    for sym, n in runs:
        part, state = _unrolled(sym, n, state, costs.pop())
        letters.append(part)
    return "".join(letters), state


def ending(state: int) -> str:
    """Inserts that close an open question."""
    out = ""
    while ACCEPT[state]:
        out += "I"
        state = DUE[state]
    return out


def cheapest(runs: list[tuple[int, int]]) -> tuple[int, str]:
    """Cost and audit of a whole sequence."""
    after = END
    for sym, n in reversed(runs):
        after = before(sym, n, after)
    letters, state = unroll(runs, 0, END)
    return after[0], letters + ending(state)

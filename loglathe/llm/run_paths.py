"""Cheapest edits of a role sequence, by powers of min-plus matrices over runs of equal symbols.

The repaired roles read ``(s?(ua)+)?``: nothing, or an optional system turn and then pairs of user and assistant.  What has been
read so far is one of four states, and at each of them only one role can be made, so an edit's letter tells all:

    K  keep the row (0), if its role may come here
    R  give it the role that is due (2)
    D  delete it (3); rows that must go allow nothing else
    I  insert an empty row of the role that is due (2), before any row or at the end

A cut-off row that stays costs 1 more.  A row is a symbol: ``x`` (must go), or its role's class, in capitals if it is cut off.
One symbol is a 4 x 4 matrix of cheapest costs from state to state; a run of n equal symbols is its n-th power, put together from
the powers 1, 2, 4, .. that are kept for each symbol.  Matrices of neighbouring pieces multiply, so a long sequence can be cut anywhere.
"""

from __future__ import annotations

from functools import lru_cache

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
INSERT_COST, REROLE_COST, DELETE_COST, CUT_COST = 2, 2, 3, 1
GONE = "x"
FAR = 1 << 60

#: states: nothing yet, after system, after user, after assistant
STATES = range(4)
_DUE = (2, 2, 3, 2)
DUE_ROLE = ("user", "user", "assistant", "user")
_KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]
Run = tuple[str, int]


def symbol(initial: str, gone: bool, cut: bool) -> str:
    """The symbol of a row; a role that starts with no s, u or a can't be kept."""
    if gone:
        return GONE
    known = initial if initial in ("s", "u", "a") else "o"
    return known.upper() if cut else known


def moves(sym: str, state: int) -> list[tuple[str, int, int]]:
    """What can be done with the row itself, ``(letter, cost, next state)`` in the order of letters."""
    out = [(DELETE, DELETE_COST, state)]
    if sym != GONE:
        extra = CUT_COST if sym.isupper() else 0
        kept = _KEPT.get((sym.lower(), state))
        if kept is not None:
            out.append((KEEP, extra, kept))
        out.append((REROLE, REROLE_COST + extra, _DUE[state]))
    return out


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in STATES)) for j in STATES) for i in STATES)


def ahead(a: Matrix, v: Vector) -> Vector:
    """Cheapest cost from each state through ``a`` and on, if ``v`` is what remains behind it."""
    return tuple(min(a[i][k] + v[k] for k in STATES) for i in STATES)


IDENTITY: Matrix = tuple(tuple(0 if i == j else FAR for j in STATES) for i in STATES)


def _inserts() -> Matrix:
    one = tuple(tuple(0 if i == j else INSERT_COST if j == _DUE[i] else FAR for j in STATES) for i in STATES)
    return times(one, one)  # a third insert leads back to where one was


_INSERTS = _inserts()
#: what is left to pay at the end: inserts until the sequence is empty or ends with an assistant
LAST: Vector = tuple(min(_INSERTS[i][0], _INSERTS[i][3]) for i in STATES)


@lru_cache(maxsize=None)
def power(sym: str, k: int) -> Matrix:
    """The matrix of 2^k equal symbols; 9 symbols and at most 63 powers are ever kept."""
    if k:
        half = power(sym, k - 1)
        return times(half, half)
    row = [[FAR] * 4 for _ in STATES]
    for state in STATES:
        for _, cost, to in moves(sym, state):
            row[state][to] = min(row[state][to], cost)
    return times(_INSERTS, tuple(map(tuple, row)))


def _powers(run: Run):
    sym, n = run
    return (power(sym, k) for k in range(n.bit_length()) if n >> k & 1)


def matrix(runs: list[Run]) -> Matrix:
    """All runs as one matrix."""
    out = IDENTITY
    for run in runs:
        for p in _powers(run):
            out = times(out, p)
    return out


def borders(runs: list[Run], end: Vector) -> list[Vector]:
    """What remains to pay before each run, and at the end."""
    out = [end]
    for run in reversed(runs):
        v = out[-1]
        for p in _powers(run):
            v = ahead(p, v)
        out.append(v)
    return out[::-1]


def unroll(runs: list[Run], end: Vector, state: int, last: bool) -> tuple[str, int]:
    """The letters of the cheapest edits, least in ASCII order among equally cheap ones, and the state they lead to.

    ``end`` is what remains to pay behind the runs; ``last`` says that nothing follows, so missing rows are inserted.
    Inside a run the costs are taken step by step from its far border; no more than one run's costs are held.
    """
    letters: list[str] = []
    marks = borders(runs, end)
    for (sym, n), behind in zip(runs, marks[1:], strict=True):
        step = power(sym, 0)
        costs = [behind]
        for _ in range(n):
            costs.append(ahead(step, costs[-1]))
        choices = [moves(sym, s) for s in STATES]
        here = costs.pop()
        while costs:
            after = costs.pop()
            while True:
                _, cost, to = choices[state][0]  # deleting comes first in the order
                if cost + after[to] == here[state]:
                    letters.append(DELETE)
                    break
                if INSERT_COST + here[_DUE[state]] == here[state]:
                    letters.append(INSERT)
                    state = _DUE[state]
                    continue
                letter, _, state = next(m for m in choices[state][1:] if m[1] + after[m[2]] == here[state])
                letters.append(letter)
                break
            here = after
    while last and LAST[state]:
        letters.append(INSERT)
        state = _DUE[state]
    return "".join(letters), state


def due(state: int) -> tuple[str, int]:
    """The role that can be made at a state, and the state after it."""
    return DUE_ROLE[state], _DUE[state]


def kept(initial: str, state: int) -> int:
    """The state after keeping a row."""
    return _KEPT[initial, state]

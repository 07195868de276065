"""Probabilistic automata by grammar inference: a prefix tree of examples whose statistically compatible states are merged.

Credentials are random in most places, and a tree of their characters would have a branch for each of them. ``FormatAutomaton`` therefore keeps a
character of its own only where nearly all examples that come to a state have it, as in a fixed prefix; else it goes on by the smallest kind
of characters that holds those seen there, of which each has the same probability.  A fixed format then is a chain, and its length is
learned, since states near the end differ from those before them.

A tree is grown from counts: how many of the examples that come to a state have which character at which place behind it.  As long as they all go the
same way, these counts give state after state; where some go another way, those of the two parts are asked for.  So whoever holds the examples counts them
a few times, and neither counts nor states follow their number.
"""

from __future__ import annotations

import math
import string
from collections import Counter, deque
from collections.abc import Iterable
from dataclasses import dataclass, field


@dataclass
class State:
    visits: int = 0
    ends: int = 0
    to: dict[str, int] = field(default_factory=dict)
    taken: Counter = field(default_factory=Counter)


def _differ(n1: int, a1: int, n2: int, a2: int, bound: float) -> bool:
    """Hoeffding: the two frequencies can't come from one probability."""
    return bool(n1 and n2) and abs(a1 / n1 - a2 / n2) > bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))


class Automaton:
    """States are visited in breadth-first order; each joins the first settled state that behaves like it, or settles itself."""

    def __init__(self, examples: list[str], alpha: float = 0.01) -> None:
        self.states = [State()]
        for text in examples:
            self._add(text)
        self._merge(alpha)

    def _merge(self, alpha: float) -> None:
        bound = math.sqrt(0.5 * math.log(2 / alpha))
        settled = [0]
        queue = deque((0, c) for c in sorted(self.states[0].to))
        while queue:
            parent, symbol = queue.popleft()
            child = self.states[parent].to[symbol]
            if child in settled:
                continue
            twin = next((s for s in settled if self._alike(s, child, bound)), None)
            if twin is None:
                settled.append(child)
                queue.extend((child, c) for c in sorted(self.states[child].to))
            else:
                self.states[parent].to[symbol] = twin
                self._fold(twin, child)
                # what the fold brought to settled states waits its turn too
                waiting = set(queue)
                queue.extend((s, c) for s in settled for c in sorted(self.states[s].to) if self.states[s].to[c] not in settled and (s, c) not in waiting)
        self.settled = settled

    def _add(self, text: str) -> None:
        at = 0
        for symbol in text:
            state = self.states[at]
            state.visits += 1
            state.taken[symbol] += 1
            if symbol not in state.to:
                self.states.append(State())
                state.to[symbol] = len(self.states) - 1
            at = state.to[symbol]
        self.states[at].visits += 1
        self.states[at].ends += 1

    def _alike(self, one: int, other: int, bound: float) -> bool:
        """Whether no pair of states that the same symbols lead to differs; pairs are looked at once, however deep the tree is."""
        pairs, seen = [(one, other)], {(one, other)}
        while pairs:
            a, b = pairs.pop()
            x, y = self.states[a], self.states[b]
            if _differ(x.visits, x.ends, y.visits, y.ends, bound):
                return False
            for symbol in {*x.to, *y.to}:
                if _differ(x.visits, x.taken[symbol], y.visits, y.taken[symbol], bound):
                    return False
                if symbol in x.to and symbol in y.to:
                    pair = x.to[symbol], y.to[symbol]
                    if pair[0] != pair[1] and pair not in seen:
                        seen.add(pair)
                        pairs.append(pair)
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add a subtree's counts; what it has beyond the other is taken over as it is."""
        pairs = [(into, tree)]
        while pairs:
            a, b = pairs.pop()
            x, y = self.states[a], self.states[b]
            x.visits += y.visits
            x.ends += y.ends
            x.taken.update(y.taken)
            for symbol, child in y.to.items():
                if symbol in x.to:
                    pairs.append((x.to[symbol], child))
                else:
                    x.to[symbol] = child

    def log2(self, text: str, floor: float = 2.0**-12) -> float:
        """Log2 probability of the text; a step that no example took costs the floor and goes back to the start."""
        at, total = 0, 0.0
        for symbol in text:
            state = self.states[at]
            if symbol in state.to:
                total += math.log2(max(floor, state.taken[symbol] / state.visits))
                at = state.to[symbol]
            else:
                total += math.log2(floor)
                at = 0
        state = self.states[at]
        return total + math.log2(max(floor, state.ends / state.visits if state.visits else 0))


#: kinds of characters, smaller ones first
CLASSES = {
    "D": string.digits,
    "h": string.digits + "abcdef",
    "H": string.digits + "ABCDEF",
    "l": string.ascii_lowercase,
    "U": string.ascii_uppercase,
    "n": string.digits + string.ascii_lowercase,
    "N": string.digits + string.ascii_uppercase,
    "a": string.ascii_letters,
    "w": string.digits + string.ascii_letters,
    "s": string.digits + string.ascii_letters + "+/_.=-",
}
_SETS = {k: frozenset(v) for k, v in CLASSES.items()}
_BITS = {k: math.log2(len(v)) for k, v in CLASSES.items()}
#: a character stands for itself where it is this part of at least so many examples, and so large a part of all examples of the tree
OWN_SHARE, OWN_COUNT, OWN_PART = 0.8, 8, 1 / 200
#: a tree has no deeper states; longer examples teach by what they have up to there
DEEPEST = 256
#: bits that a step or an end costs which no example took
UNSEEN = 32.0

#: by state and place the number of examples with a character there, or, for ``""``, that end there
Counts = Counter[tuple[int, int, str]]


class FormatAutomaton(Automaton):
    """An automaton of whole characters and kinds of them; symbols are ``=c`` for a character and ``#k`` for a kind."""

    def __init__(self, examples: list[str] | None = None, alpha: float = 0.01) -> None:
        self.states = [State()]
        #: states whose examples are still to be counted, with their depth and the kind before them
        self.open: dict[int, tuple[int, str]] = {0: (0, "")}
        self.total = 0
        if examples is not None:
            while self.open:
                self.grow(self.count(examples))
            self.finish(alpha)

    def count(self, examples: Iterable[str]) -> Counts:
        """Characters and ends behind the open states that the examples come to."""
        out: Counts = Counter()
        for e in examples:
            at, i = 0, 0
            while at not in self.open and i < len(e):
                to = self.states[at].to
                at, i = to.get(f"={e[i]}", -1) if f"={e[i]}" in to else next((t for s, t in to.items() if s[0] == "#"), -1), i + 1
                if at < 0:
                    break
            if at in self.open:
                out.update((at, k, e[k]) for k in range(i, min(len(e), DEEPEST)))
                out[at, min(len(e), DEEPEST + 1), ""] += 1
        return out

    def grow(self, counts: Counts) -> None:
        """States behind the open ones, up to where examples part, from counts of all examples; these states are open then."""
        at_place: dict[tuple[int, int], dict[str, int]] = {}
        for (state, place, c), n in counts.items():
            at_place.setdefault((state, place), {})[c] = n
        arrived: Counter = Counter()
        for (state, _, c), n in counts.items():
            arrived[state] += n if c == "" else 0
        self.total = self.total or arrived[0]
        waiting, self.open = self.open, {}
        for first, (depth, before) in waiting.items():
            at, here = first, arrived[first]
            while True:
                by = dict(at_place.get((first, depth), {}))
                state = self.states[at]
                state.visits, state.ends = here, by.pop("", 0)
                here -= state.ends
                if not by:
                    break
                most = max(by, key=lambda c: (by[c], c))
                own = {most} if by[most] >= max(OWN_COUNT, OWN_SHARE * here, OWN_PART * self.total) else set()
                rest = {c for c in by if c not in own}
                kind = _kind(rest, before if here < OWN_COUNT * 4 else "") if rest else ""
                ways = [(f"={c}", by[c], before) for c in sorted(own)] + ([(f"#{kind}", here - sum(by[c] for c in own), kind)] if rest else [])
                depth += 1
                for symbol, n, behind in ways:
                    self.states.append(State())
                    state.to[symbol] = len(self.states) - 1
                    state.taken[symbol] = n
                    if len(ways) == 2:
                        self.open[len(self.states) - 1] = depth, behind
                if len(ways) == 2:
                    break
                at, before = len(self.states) - 1, ways[0][2]

    def finish(self, alpha: float = 0.01) -> None:
        self._merge(alpha)
        self._arcs = [_arcs(s) for s in self.states]

    def bits(self, text: str, most: float = math.inf) -> float:
        """How many bits the text takes, or some number above ``most`` if it is more; after a step that no example took it starts anew."""
        at, total = 0, 0.0
        for c in text:
            step = self._arcs[at].get(c)
            if step is None:
                total += UNSEEN
                at = 0
            else:
                total += step[1]
                at = step[0]
            if total > most:
                return total
        state = self.states[at]
        return total + (-math.log2(state.ends / state.visits) if state.ends else UNSEEN)


def _kind(characters: set[str], before: str) -> str:
    """The smallest kind that holds the characters; with few examples not a smaller one than that of the state before."""
    fits = [k for k, v in _SETS.items() if characters <= v and (not before or _SETS[before] <= v or not _SETS[before] >= characters)]
    return fits[0] if fits else "s"


def _arcs(state: State) -> dict[str, tuple[int, float]]:
    """For each character where it leads and what it costs: the cheaper way where it has two."""
    out: dict[str, tuple[int, float]] = {}
    for symbol, to in state.to.items():
        cost = -math.log2(state.taken[symbol] / state.visits) + (_BITS[symbol[1:]] if symbol[0] == "#" else 0.0)
        for c in CLASSES[symbol[1:]] if symbol[0] == "#" else symbol[1:]:
            if c not in out or cost < out[c][1]:
                out[c] = to, cost
    return out

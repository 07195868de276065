"""A trie over letter-group counts, and the words in it that are one edit apart.

Letters are dealt to a fixed number of groups; a word is the list of how many letters of each group it has, and the trie has one level
a group.  One inserted letter raises one count, a deleted one lowers one, a replaced one does both or neither, so two words that are near lie at
most one above and one below each other.  Both sides of a search are tries, and they are walked together, depth first: a pair
of nodes goes on to the children of equal count, and while the budget lasts to those one above and one below.  Pairs of leaves that are
reached have their words compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np

LEVELS = 16
#: more pairs than this between two leaves are not tried one by one, but looked up by equal halves
TRIED = 32


def letter_groups(counts: np.ndarray) -> np.ndarray:
    """For each of 256 letters its group: the commonest first, each to the group with the fewest letters so far."""
    groups, loads = np.zeros(256, np.int64), np.zeros(LEVELS)
    for letter in np.argsort(-counts, kind="stable").tolist():
        at = int(loads.argmin())
        groups[letter] = at
        loads[at] += counts[letter] + 1e-9
    return groups


def vectors(words: list[str], groups: np.ndarray) -> np.ndarray:
    """Letters of each group, one row a word; all letters are below U+0100."""
    data = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    return np.bincount(owner * LEVELS + groups[data], minlength=len(words) * LEVELS).reshape(len(words), LEVELS)


class Leaf:
    """Words of equal counts."""

    __slots__ = ("halves", "number", "words")

    def __init__(self, number: int) -> None:
        self.number, self.words, self.halves = number, [], {}

    def by_half(self, at: int, size: int) -> dict[tuple[bool, str], list[str]]:
        """Words by their first ``at`` letters and by what follows the first ``size`` (``at`` for equal lengths, one more for a longer word)."""
        found = self.halves.get((at, size))
        if found is None:
            found = self.halves[at, size] = {}
            for w in self.words:
                found.setdefault((True, w[:at]), []).append(w)
                found.setdefault((False, w[size:]), []).append(w)
        return found


def trie(words: list[str], groups: np.ndarray) -> dict:
    root: dict = {}
    leaves = 0
    for word, counts in zip(words, vectors(words, groups).tolist(), strict=True):
        node = root
        for c in counts[:-1]:
            node = node.setdefault(c, {})
        leaf = node.get(counts[-1])
        if leaf is None:
            leaf = node[counts[-1]] = Leaf(leaves)
            leaves += 1
        leaf.words.append(word)
    return root


def search(a: dict, b: dict, reach: Callable[[Leaf, Leaf], None]) -> None:
    """Call ``reach`` for all leaves of ``a`` and ``b`` with at most one surplus and one deficit in their counts."""

    def step(x: dict, y: dict, depth: int, surplus: bool, deficit: bool) -> None:
        deeper = depth + 1
        act = reach if deeper == LEVELS else None
        for count, child in x.items():
            other = y.get(count)
            if other is not None:
                act(child, other) if act else step(child, other, deeper, surplus, deficit)
            if surplus:
                other = y.get(count + 1)
                if other is not None:
                    act(child, other) if act else step(child, other, deeper, False, deficit)
            if deficit:
                other = y.get(count - 1)
                if other is not None:
                    act(child, other) if act else step(child, other, deeper, surplus, False)

    step(a, b, 0, True, True)


def one_edit(x: str, y: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes the one of the other; lengths differ by one at most."""
    if len(x) > len(y):
        x, y = y, x
    longer = len(y) - len(x)
    half = len(x) >> 1
    at = half
    if x[:half] != y[:half]:
        if x[half:] != y[half + longer :]:
            return False
        at = 0
    end = len(x)
    while at < end and x[at] == y[at]:
        at += 1
    return x[at + (1 - longer) :] == y[at + 1 :] and x != y


def near_words(a: Leaf, b: Leaf) -> Iterable[tuple[str, str]]:
    """Pairs of a word of ``a`` and one of ``b`` that are one edit apart; for one and the same leaf each pair once."""
    if len(a.words) * len(b.words) <= TRIED:
        if a is b:
            return [(x, y) for i, x in enumerate(a.words) for y in a.words[i + 1 :] if one_edit(x, y)]
        return [(x, y) for x in a.words for y in b.words if one_edit(x, y)]
    if len(a.words[0]) > len(b.words[0]):
        return [(y, x) for x, y in near_words(b, a)]
    # words of a leaf have one length; near ones agree in the first half of the shorter or in the rest
    half, longer = len(a.words[0]) >> 1, len(b.words[0]) - len(a.words[0])
    table, out = b.by_half(half, half + longer), []
    for x in a.words:
        first, rest = table.get((True, x[:half]), ()), table.get((False, x[half:]), ())
        found = {y for y in (*first, *rest) if one_edit(x, y)}
        out += [(x, y) for y in found if a is not b or x < y]
    return out

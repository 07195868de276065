"""Which stretches of a text are taken."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable


class Taken:
    """Disjoint stretches in order; asking and adding take the logarithm of their number."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def free(self, start: int, end: int) -> bool:
        """Whether a stretch meets none of those taken."""
        at = bisect_right(self.ends, start)
        return at == len(self.starts) or end <= self.starts[at]

    def add(self, start: int, end: int) -> None:
        """Take a free stretch."""
        at = bisect_right(self.ends, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)

"""Gradient boosted trees for a yes/no label.

Trees are grown from sums of gradients over (node, feature, bin), whose number doesn't follow that of the rows.  Whoever holds the rows makes the
sums: ``fit`` for arrays in memory, ``fit_rows`` with Spark for a table.  Gradients are added as whole numbers, so that neither the order of the rows nor the
way they are dealt changes a tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: the unit that gradients are added in
UNIT = 1 << 20
#: so many different rows are summed where they are collected, more by tasks; the sums are the same
FEW = 50_000

Tree = tuple[np.ndarray, np.ndarray, np.ndarray]
#: gradients and weights by cell, for a level of a tree that has features and cuts above it
Sums = Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray]]


@dataclass
class Boosted:
    """Additive trees of a fixed depth over binned features; each node splits one feature at one bin edge."""

    depth: int = 3
    rounds: int = 40
    rate: float = 0.3
    bins: int = 32
    ridge: float = 1.0
    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[Tree] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.prepare([np.unique(x[:, j], return_counts=True) for j in range(x.shape[1])], y.mean())
        return self.grow(self.sums_of(self.binned(x), y, np.ones(len(y), np.int64)))

    def prepare(self, counted: list[tuple[np.ndarray, np.ndarray]], share: float) -> None:
        """``counted``: for each feature its values in order, and how many rows have each; ``share``: that of the rows whose label is yes."""
        quantiles = np.linspace(0, 1, self.bins + 1)[1:-1]
        for values, counts in counted:
            upto = np.cumsum(counts)
            self.edges.append(np.unique(values[np.searchsorted(upto, np.floor(quantiles * (upto[-1] - 1)), "right")]))
        share = np.clip(share, 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))

    def fit_rows(self, rows: DataFrame) -> Boosted:
        """Grow trees, after ``prepare``, over all of ``rows`` (bins binary: a byte a feature, label int, n long: how often the row stands)."""
        if rows.count() <= FEW:
            table = rows.select("bins", "label", "n").toArrow()
            return self.grow(self.sums_of(bins_of(table["bins"].to_pylist(), len(self.edges)), table["label"].to_numpy(), table["n"].to_numpy()))
        return self.grow(lambda feature, cut, level: self._row_sums(rows, feature, cut, level))

    def _row_sums(self, rows: DataFrame, feature: np.ndarray, cut: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        cells = self._cells(level)
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            g, h = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
            for batch in batches:
                if batch.num_rows:
                    binned = bins_of(batch["bins"].to_pylist(), len(model.edges))
                    one = model.sums_of(binned, batch["label"].to_numpy(), batch["n"].to_numpy())(feature, cut, level)
                    g += one[0]
                    h += one[1]
            at = np.flatnonzero((g != 0) | (h != 0))
            yield pa.record_batch([pa.array(at, pa.int32()), pa.array(g[at]), pa.array(h[at])], names=["cell", "g", "h"])

        parts = rows.select("bins", "label", "n").mapInArrow(run, "cell int, g long, h long")
        found = parts.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        g, h = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
        g[found["cell"].to_numpy()], h[found["cell"].to_numpy()] = found["g"].to_numpy(), found["h"].to_numpy()
        return g, h

    def _cells(self, level: int) -> int:
        return (1 << level) * len(self.edges) * (self.bins + 1)

    def sums_of(self, binned: np.ndarray, y: np.ndarray, n: np.ndarray) -> Sums:
        """Sums over rows in memory, whose logits follow the trees as they are added."""
        done, logit = 0, np.full(len(binned), self.base)
        columns = np.arange(binned.shape[1])

        def sums(feature: np.ndarray, cut: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
            nonlocal done
            for tree in self.trees[done:]:
                logit[:] += self._leaf(tree, binned)
            done = len(self.trees)
            p = 1 / (1 + np.exp(-logit))
            gradient, weight = np.rint((y - p) * UNIT) * n, np.rint(p * (1 - p) * UNIT) * n
            place = self._place(feature, cut, binned, level) - ((1 << level) - 1)
            cell = ((place[:, None] * len(columns) + columns) * (self.bins + 1) + binned).ravel()
            parts = [np.bincount(cell, np.repeat(v, len(columns)), self._cells(level)) for v in (gradient, weight)]
            return np.rint(parts[0]).astype(np.int64), np.rint(parts[1]).astype(np.int64)

        return sums

    def grow(self, sums: Sums) -> Boosted:
        for _ in range(self.rounds):
            self.trees.append(self._tree(sums))
        return self

    def _tree(self, sums: Sums) -> Tree:
        nodes = (1 << self.depth) - 1
        feature, cut = np.zeros(nodes, np.int64), np.full(nodes, self.bins, np.int64)
        for level in range(self.depth):
            offset, width = (1 << level) - 1, 1 << level
            g, h = (v.reshape(width, len(self.edges), -1) / UNIT for v in sums(feature, cut, level))
            gl, hl = g.cumsum(2), h.cumsum(2)
            g_all, h_all = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + self.ridge) + (g_all - gl) ** 2 / (h_all - hl + self.ridge) - g_all**2 / (h_all + self.ridge)
            flat = gain.reshape(width, -1)
            at = flat.argmax(1)
            better = flat[np.arange(width), at] > 1e-9
            feature[offset : offset + width][better] = at[better] // (self.bins + 1)
            cut[offset : offset + width][better] = at[better] % (self.bins + 1)
        # what goes to each leaf stands in the sums of the last level
        above = np.arange(width)
        j, c = feature[offset : offset + width], cut[offset : offset + width]
        left = gl[above, j, c], hl[above, j, c]
        right = g_all[above, j, 0] - left[0], h_all[above, j, 0] - left[1]
        g, h = (np.stack(pair, 1).ravel() for pair in zip(left, right, strict=True))
        return feature, cut, self.rate * g / (h + self.ridge)

    def _place(self, feature: np.ndarray, cut: np.ndarray, binned: np.ndarray, levels: int) -> np.ndarray:
        place = np.zeros(len(binned), np.int64)
        for _ in range(levels):
            place = 2 * place + 1 + (binned[np.arange(len(binned)), feature[place]] > cut[place])
        return place

    def _leaf(self, tree: Tree, binned: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        return value[self._place(feature, cut, binned, self.depth) - len(feature)]

    def logit(self, binned: np.ndarray) -> np.ndarray:
        return sum((self._leaf(tree, binned) for tree in self.trees), np.full(len(binned), self.base))

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        return 1 / (1 + np.exp(-self.logit(self.binned(np.asarray(x, float)))))


def bins_of(rows: list[bytes], features: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, features).astype(np.int64)


def calibrated_threshold(scores: np.ndarray, labels: np.ndarray, precision: float) -> float:
    """A score from which on up the labels reach the precision, as low as can be; above 1 when none does."""
    return threshold_of(scores, scores, labels, np.ones(len(scores)), precision)


def threshold_of(low: np.ndarray, high: np.ndarray, good: np.ndarray, n: np.ndarray, precision: float) -> float:
    """The same for groups of neighbouring scores: the least and greatest of each, how many labels say yes, and how many there are.

    It lies midway between the lowest score that does and the next lower one: the same labelled rows are above it.
    """
    order = np.argsort(-low, kind="stable")
    low, high = low[order], high[order]
    right = np.cumsum(good[order]) / np.cumsum(n[order])
    last = np.concatenate([low[1:] != low[:-1], [True]]) if len(order) else np.zeros(0, bool)
    fits = np.flatnonzero((right >= precision) & last)
    if not len(fits):
        return 2.0
    lower = high[fits[-1] + 1 :]
    return float((low[fits[-1]] + (lower[0] if len(lower) else 0.0)) / 2)

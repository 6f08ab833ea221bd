"""Gradient-boosted trees for a yes-or-no question, small enough to be sent to every task.

They are grown on sums: each block of rows adds up its gradients by node, feature and bin, blocks are added to each other by
the tasks (those of few partitions by the driver), and the driver, which sees nothing else, chooses the splits.  The sums are
whole numbers, so that they, and the trees, do not hang on how the rows lie in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
from pyspark import RDD, StorageLevel

ONE = 1 << 30  # a gradient of 1 in the sums
DIRECT = 64  # partitions whose sums (about 100 KB each) go straight to the driver; those of more are added up by tasks first
AFRESH = 10  # trees after which the rows' scores are stored anew; those of later trees are worked out on the way

Tree = list[tuple]  # of nodes (feature or -1, cut, low child, high child, value)
Block = tuple[np.ndarray, ...]  # bins of the features, truth, weight and number of equal rows; then their score, too


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def coded(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of every value: the number of cuts below it."""
    return np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], axis=1).astype(np.uint8)


def _places(tree: Tree, x: np.ndarray, steps: int) -> np.ndarray:
    """The node that each row comes to."""
    at, table, rows = np.zeros(len(x), np.int64), np.array(tree, float), np.arange(len(x))
    feature, children = table[:, 0].astype(np.int64), table[:, 2:4].astype(np.int64)
    for _ in range(steps):
        f = feature[at]
        side = (x[rows, np.maximum(f, 0)] > table[at, 1]).astype(np.int64)
        at = np.where(f >= 0, children[at, side], at)
    return at


def _walked(trees: Sequence[Tree], x: np.ndarray, steps: int, score: np.ndarray) -> np.ndarray:
    for tree in trees:
        score = score + np.array(tree, float)[_places(tree, x, steps), 4]
    return score


def _totals(block: Block) -> np.ndarray:
    _, y, w, _ = block
    return np.array([np.rint(w * ONE).sum(), np.rint(w * y * ONE).sum()]).astype(np.int64)


def _scored(block: Block, trees: Sequence[Tree], steps: int, start: float) -> Block:
    codes, y, w, n = block
    return codes, y, w, n, _walked(trees, codes, steps, np.full(len(y), start))


def _sums(block: Block, trees: Sequence[Tree], tree: Tree, level: Sequence[int], steps: int, bins: int) -> np.ndarray:
    """Gradients, their slopes and rows, by open node of the growing tree, feature and bin."""
    codes, y, w, n, score = block
    p = _sigmoid(_walked(trees, codes, steps, score))
    slots = np.full(len(tree), -1)
    slots[list(level)] = range(len(level))
    slot = slots[_places(tree, codes, steps)]
    open_ = slot >= 0
    codes, y, w, n, p, slot = codes[open_], y[open_], w[open_], n[open_], p[open_], slot[open_]
    width = codes.shape[1]
    cells = ((slot[:, None] * width + np.arange(width)) * bins + codes).ravel()
    size = len(level) * width * bins
    of = (np.rint(w * (y - p) * ONE), np.rint(w * p * (1 - p) * ONE), n)
    sums = [np.bincount(cells, np.repeat(v, width), size) for v in of]  # exact below a weight of 2 ** 23 in a block
    return np.stack(sums).astype(np.int64).reshape(3, len(level), width, bins)


class _Here(list):
    """Blocks in memory, added up as an RDD's are."""

    def map(self, f: Callable) -> _Here:
        return _Here(map(f, self))

    def getNumPartitions(self) -> int:  # noqa: N802
        return 1

    def reduce(self, f: Callable) -> np.ndarray:
        return reduce(f, self)

    def persist(self, _: StorageLevel) -> _Here:
        return self

    def unpersist(self) -> None:
        pass


def _added(sums: RDD[np.ndarray]) -> np.ndarray:
    """The sum over all blocks.  A tree takes one for each level, so few partitions are not shuffled for it."""
    return sums.reduce(np.add) if sums.getNumPartitions() <= DIRECT else sums.treeReduce(np.add)


@dataclass
class Boosted:
    """Logistic loss, trees of a fixed depth over at most `bins` bins of each feature, Newton leaves."""

    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    ridge: float = 1.0
    start: float = 0.0
    nodes: list[Tree] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        """From rows in memory."""
        if not len(y):
            self.start, self.nodes = 0.0, []
            return self
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1], method="inverted_cdf")) for c in x.T]
        return self.fit_blocks(_Here([(coded(x, cuts), y, np.ones(len(y)), np.ones(len(y)))]), cuts)

    def fit_blocks(self, blocks: RDD[Block], cuts: Sequence[np.ndarray]) -> Boosted:
        """From all rows of all blocks, their features told in bins between the cuts; sums alone come to the driver."""
        weight, true = _added(blocks.map(_totals)) / ONE
        mean = np.clip(true / weight if weight else 0.5, 1e-3, 1 - 1e-3)
        self.start, self.nodes = float(np.log(mean / (1 - mean))), []
        grown: list[Tree] = []  # their cuts told in bins
        scored = None
        for i in range(self.trees if 0 < true < weight else 0):
            if i % AFRESH == 0:
                if scored:
                    scored.unpersist()
                scored = blocks.map(partial(_scored, trees=list(grown), steps=self.depth, start=self.start))
                scored.persist(StorageLevel.MEMORY_AND_DISK)
            grown.append(self._grown(scored, grown[i - i % AFRESH :], cuts))
        if scored:
            scored.unpersist()
        self.nodes = [[(f, float(cuts[f][k]) if f >= 0 else 0.0, *rest) for f, k, *rest in tree] for tree in grown]
        return self

    def _grown(self, scored: RDD[Block], trees: list[Tree], cuts: Sequence[np.ndarray]) -> Tree:
        """A tree, level by level."""
        tree: Tree = [(-1, 0, 0, 0, 0.0)]
        level = [0]
        bins = max(map(len, cuts), default=0) + 1
        for depth in range(self.depth):
            sums = _added(
                scored.map(partial(_sums, trees=list(trees), tree=list(tree), level=level, steps=self.depth, bins=bins))
            )
            below: list[int] = []
            for at, (g, h, n) in zip(level, sums.transpose(1, 0, 2, 3)):
                if not depth:
                    tree[0] = self._leaf(g[0].sum() / ONE, h[0].sum() / ONE)
                split = self._split(g / ONE, h / ONE) if n[0].sum() >= 8 else None
                if split:
                    f, k, low, high = split
                    tree[at] = (f, k, len(tree), len(tree) + 1, 0.0)
                    below += [len(tree), len(tree) + 1]
                    tree += [self._leaf(*low), self._leaf(*high)]
            level = below
            if not level:
                break
        return tree

    def _leaf(self, g: float, h: float) -> tuple:
        return (-1, 0, 0, 0, float(self.rate * g / (h + self.ridge)))

    def _split(self, g: np.ndarray, h: np.ndarray) -> tuple | None:
        """Feature, bin, and the sums of both sides; None if nothing is gained."""
        left_g, left_h = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
        right_g, right_h = g[0].sum() - left_g, h[0].sum() - left_h
        whole = g[0].sum() ** 2 / (h[0].sum() + self.ridge)
        gain = left_g**2 / (left_h + self.ridge) + right_g**2 / (right_h + self.ridge) - whole
        gain[(left_h < 0.5) | (right_h < 0.5)] = 0
        if not gain.size or gain.max() <= 1e-6:
            return None
        f, k = map(int, np.unravel_index(gain.argmax(), gain.shape))
        return f, k, (left_g[f, k], left_h[f, k]), (right_g[f, k], right_h[f, k])

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities, not calibrated."""
        return _sigmoid(_walked(self.nodes, x, self.depth, np.full(len(x), self.start)))


def provable(true: float, precision: float) -> bool:
    """Whether so many true rows, all of them right, can reach the precision in `threshold`."""
    return true / (true + 1) >= precision


def threshold(p: np.ndarray, y: np.ndarray, precision: float, w: np.ndarray | None = None) -> float:
    """The least score at and above which the share of true rows, less a margin for their number, is at least `precision`.

    The margin counts one more wrong row than was seen; rows of one score may come as one, with their weight.  Above 1 if no
    score will do.
    """
    order = np.argsort(-p, kind="stable")
    p, y, w = p[order], y[order], np.ones(len(p)) if w is None else w[order]
    last = np.flatnonzero(np.append(p[1:] != p[:-1], True)) if len(p) else np.zeros(0, int)
    true, rows = np.cumsum(y * w)[last], np.cumsum(w)[last]
    good = np.flatnonzero(true / (rows + 1) >= precision)
    return float(p[last[good[-1]]]) if len(good) else 2.0

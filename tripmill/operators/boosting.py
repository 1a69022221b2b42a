"""Boosted trees on a grid of cells, with squared error.

Two binned features make a grid. With squared error the gradient of a row is its margin less its label,
and rows of one cell share a margin, so counts and label sums per cell are all that a tree needs: the
trees are the same as those grown on the rows. The grid has a fixed size whatever the number of rows.

A split gains ``score(left) + score(right) - score(parent)`` with ``score = soft(G) ** 2 / (H + l2)``,
where G and H are the sums of gradients and rows and ``soft`` draws G towards zero by ``l1``. A leaf's
value is ``-soft(G) / (H + l2)``. Of equal splits the first feature's lowest gap is taken, in its middle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LEAF = -1


@dataclass
class Tree:
    """Nodes in the order of their making: feature (-1: leaf), last bin that goes left, children,
    value and rows."""

    features: list[int] = field(default_factory=list)
    bins: list[int] = field(default_factory=list)
    lefts: list[int] = field(default_factory=list)
    rights: list[int] = field(default_factory=list)
    values: list[float] = field(default_factory=list)
    rows: list[float] = field(default_factory=list)
    depth: int = 0

    def add(self, value: float, rows: float) -> int:
        for column, x in ((self.features, LEAF), (self.bins, -1), (self.lefts, -1),
                          (self.rights, -1), (self.values, value), (self.rows, rows)):
            column.append(x)
        return len(self.features) - 1


def soft(gradient: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0.0)


def score(gradient: np.ndarray, rows: np.ndarray, l1: float, l2: float) -> np.ndarray:
    return soft(gradient, l1) ** 2 / np.maximum(rows + l2, 1e-300)


def leaf_value(gradient: np.ndarray, rows: np.ndarray, l1: float, l2: float) -> np.ndarray:
    return -soft(gradient, l1) / np.maximum(rows + l2, 1e-300)


def grow(gradient: np.ndarray, rows: np.ndarray, depth: int, child_weight: float, l1: float,
         l2: float) -> tuple[Tree, np.ndarray]:
    """A tree on a grid (first feature, second feature), level by level, and the value of each cell.

    Cells without rows go where the splits send them.
    """
    shape = gradient.shape
    place = [np.repeat(np.arange(shape[0]), shape[1]), np.tile(np.arange(shape[1]), shape[0])]
    g, h = gradient.ravel(), rows.ravel().astype(float)
    tree = Tree()
    total_g, total_h = g.sum(), h.sum()
    tree.add(float(leaf_value(total_g, total_h, l1, l2)), float(total_h))
    node = np.zeros(g.size, np.int64)
    active = np.array([0])
    for level in range(depth):
        # Number of each cell's node among the active ones.
        number = np.full(len(tree.features), -1)
        number[active] = np.arange(len(active))
        here = number[node]
        cells = np.flatnonzero(here >= 0)
        best_gain = np.zeros(len(active))
        best = np.full((len(active), 2), -1)
        sums = None
        for feature, bins in enumerate(shape):
            key = here[cells] * bins + place[feature][cells]
            left_g, left_h = (np.cumsum(np.bincount(key, x[cells], len(active) * bins).reshape(
                -1, bins), axis=1) for x in (g, h))
            sums = left_g[:, -1], left_h[:, -1]
            right_g, right_h = sums[0][:, None] - left_g, sums[1][:, None] - left_h
            gain = (score(left_g, left_h, l1, l2) + score(right_g, right_h, l1, l2)
                    - score(*sums, l1, l2)[:, None])
            gain[(left_h < child_weight) | (right_h < child_weight)] = 0.0
            first = gain.argmax(axis=1)
            most = gain[np.arange(len(active)), first]
            # Bins without rows split alike: the middle of such a gap.
            alike = (gain == most[:, None]) | (np.arange(bins) < first[:, None])
            last = np.where(alike.all(axis=1), bins, alike.argmin(axis=1)) - 1
            at = (first + last) // 2
            better = most > best_gain * (1 + 1e-9) + 1e-9
            best[better] = np.column_stack([np.full(len(active), feature), at])[better]
            best_gain = np.where(better, most, best_gain)
        splits = np.flatnonzero(best[:, 0] >= 0)
        if not len(splits):
            break
        tree.depth = level + 1
        child = np.full((len(active), 2), -1)
        goes_left = np.zeros(g.size, bool)
        split_feature = best[here[cells], 0]
        for feature in range(2):
            mine = cells[split_feature == feature]
            goes_left[mine] = place[feature][mine] <= best[here[mine], 1]
        moved = cells[split_feature >= 0]
        side = (~goes_left[moved]).astype(np.int64)
        key = here[moved] * 2 + side
        child_g, child_h = (np.bincount(key, x[moved], len(active) * 2) for x in (g, h))
        values = leaf_value(child_g, child_h, l1, l2)
        for i in splits:
            parent = int(active[i])
            tree.features[parent], tree.bins[parent] = map(int, best[i])
            child[i] = [tree.add(float(values[2 * i + s]), float(child_h[2 * i + s]))
                        for s in range(2)]
            tree.lefts[parent], tree.rights[parent] = map(int, child[i])
        node[moved] = child[here[moved], side]
        active = child[splits].ravel()
    return tree, np.array(tree.values)[node].reshape(shape)


def squared_error(rows: np.ndarray, labels: np.ndarray, squares: np.ndarray,
                  margins: np.ndarray) -> float:
    """Mean squared error of margins, from the counts, sums and sums of squares of each cell."""
    n = rows.sum()
    if not n:
        return float("nan")
    return float(max((squares - 2 * margins * labels + rows * margins ** 2).sum() / n, 0.0))

"""Gradient-boosted trees for binary labels over a Spark table, with Platt calibration.

A row is a string of bytes, one for each feature: the number of ``CUTS`` below
its value. Every level of every tree is one aggregation over all rows: tasks
sum gradients and curvatures by node, feature and byte, Spark adds these up,
and the driver sees as many sums as there are nodes, features and bytes. Sums
are of whole numbers (``UNIT`` to one), so they do not depend on the order of
rows, and reruns give the same trees. Margins are rounded to ``GRID`` steps to
one; calibration and thresholds read the number of rows at each step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = "code binary, y int, held boolean, n long"
#: Splits of every feature lie here, whatever the data.
CUTS = np.array([*range(17), 18, 20, 22, 24, 28, 32, 48, 64, 99, 128, 255, 512, 999, 1899, 2099, 9999, 99999], dtype=np.float64)
SLOTS = len(CUTS) + 1
UNIT = 1 << 20
GRID = 64


def encoded(x: np.ndarray) -> np.ndarray:
    """One byte for each value: how many cuts lie below it."""
    return np.searchsorted(CUTS, x, side="left").astype(np.uint8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows by features), labels and numbers of rows alike."""
    code = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1)
    return code, batch.column("y").to_numpy(), batch.column("n").to_numpy()


class Tree:
    """Node i has the children 2 i + 1 and, for codes over ``slot``, 2 i + 2; a leaf has no feature."""

    def __init__(self, depth: int):
        size = 2 ** (depth + 1) - 1
        self.feature, self.slot, self.value = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)

    def place(self, code: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(code), np.int64), np.arange(len(code))
        while True:
            inner = self.feature[node] >= 0
            if not inner.any():
                return node
            over = code[rows, self.feature[node]] > self.slot[node]
            node = np.where(inner, 2 * node + 1 + over, node)


class BoostedTrees:
    """Logistic loss, second-order leaf values."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.2, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.ridge = trees, depth, rate, ridge
        self.start, self.nodes, self.platt = 0.0, [], (1.0, 0.0)

    def _sums(self, rows: DataFrame, tree: Tree, level: int, features: int) -> np.ndarray:
        """Gradients and curvatures by node of the level, feature and code, over all rows."""
        first, size = 2**level - 1, 2**level * features * SLOTS
        margin, columns = self.margin, np.arange(features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, size), dtype=np.int64)
            for batch in batches:
                code, y, n = _columns(batch)
                node = tree.place(code) - first
                some = node >= 0            # others are in leaves above
                code, y, n, node = code[some], y[some], n[some], node[some]
                p = sigmoid(margin(code))
                at = ((node[:, None] * features + columns) * SLOTS + code).ravel()
                for i, part in enumerate((p - y, p * (1 - p))):
                    weight = np.rint(part * UNIT) * n
                    total[i] += np.bincount(at, np.repeat(weight, features), size).astype(np.int64)
            some = np.flatnonzero(total.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])],
                                             names=["at", "g", "h"])

        found = (rows.mapInArrow(run, "at long, g long, h long").groupBy("at")
                 .agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
        out = np.zeros((2, size))
        for r in found:
            out[:, r["at"]] = r["g"] / UNIT, r["h"] / UNIT
        return out.reshape(2, 2**level, features, SLOTS)

    def _value(self, g: float, h: float) -> float:
        return -g / (h + self.ridge) * self.rate

    def _grow(self, rows: DataFrame, features: int) -> Tree:
        tree = Tree(self.depth)
        for level in range(self.depth):
            split = False
            for i, (grad, hess) in enumerate(zip(*self._sums(rows, tree, level, features), strict=True)):
                node = 2**level - 1 + i
                g, h = grad[0].sum(), hess[0].sum()
                tree.value[node] = self._value(g, h)
                gl, hl = np.cumsum(grad, axis=1)[:, :-1], np.cumsum(hess, axis=1)[:, :-1]
                gain = gl**2 / (hl + self.ridge) + (g - gl) ** 2 / (h - hl + self.ridge) - g * g / (h + self.ridge)
                gain[(hl < 1e-3) | (h - hl < 1e-3)] = 0
                f, k = divmod(int(np.argmax(gain)), SLOTS - 1)
                if gain[f, k] > 1e-6:
                    tree.feature[node], tree.slot[node], split = f, k, True
                    tree.value[2 * node + 1] = self._value(gl[f, k], hl[f, k])
                    tree.value[2 * node + 2] = self._value(g - gl[f, k], h - hl[f, k])
            if not split:
                break
        return tree

    def fit(self, rows: DataFrame, positive: float, features: int) -> BoostedTrees:
        """Over ``rows`` (:data:`ROWS`), of which the share ``positive`` is labelled 1."""
        share = min(max(positive, 1e-3), 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        for _ in range(self.trees):
            tree = self._grow(rows, features)
            self.nodes.append(tree)
            if tree.feature[0] < 0:         # no split gains anything
                break
        return self

    def margin(self, code: np.ndarray) -> np.ndarray:
        return sum((t.value[t.place(code)] for t in self.nodes), np.full(len(code), self.start))

    def step(self, code: np.ndarray) -> np.ndarray:
        """The margin in steps of 1 / GRID, at most 32 from zero."""
        return np.rint(np.clip(self.margin(code), -32, 32) * GRID).astype(np.int64)

    def steps(self, rows: DataFrame) -> np.ndarray:
        """Rows by first feature: ``feature, step, negative rows, positive rows``, over all rows."""
        step = self.step

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                code, y, n = _columns(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code[:, 0].astype(np.int64)), pa.array(step(code)), pa.array(n * (1 - y)), pa.array(n * y)],
                    names=["kind", "step", "n0", "n1"])

        found = (rows.mapInArrow(run, "kind long, step long, n0 long, n1 long").groupBy("kind", "step")
                 .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect())
        return np.array(sorted(tuple(r) for r in found), dtype=np.int64).reshape(-1, 4)

    def calibrate(self, steps: np.ndarray, rounds: int = 50) -> BoostedTrees:
        """Fit probability = sigmoid(a * margin + b) by Newton steps to :meth:`steps` of held-back rows."""
        theta = np.array([1.0, 0.0])
        design = np.stack((steps[:, 1] / GRID, np.ones(len(steps))), axis=1)
        n, ones = steps[:, 2] + steps[:, 3], steps[:, 3]
        for _ in range(rounds):
            p = sigmoid(design @ theta)
            hess = design.T @ (design * (n * p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
            theta -= np.linalg.solve(hess, design.T @ (n * p - ones) + 1e-2 * (theta - [1.0, 0.0]))
        self.platt = (float(theta[0]), float(theta[1]))
        return self

    def at_step(self, step: np.ndarray) -> np.ndarray:
        return sigmoid(self.platt[0] * step / GRID + self.platt[1])

    def probability(self, code: np.ndarray) -> np.ndarray:
        return self.at_step(self.step(code))

"""Linear support vector machines, one against the rest, for several costs at once.

Minimises ``|w|^2 / 2 + C * sum(max(0, 1 - y * w.x)^2)`` with the intercept as a further weight. All classes
and costs are trained together by L-BFGS (Liu and Nocedal, 1989): one pass over the data returns loss and
gradient of every machine that has not converged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallyloom.operators.blocks import matrix
from tallyloom.operators.passes import sums_by_slot

MEMORY = 10
ARMIJO = 1e-4
SMALLEST_STEP = 2.0 ** -30


@dataclass
class LinearSvm:
    """``weights`` is costs x classes x (dimensions + 1); the last weight is the intercept."""

    costs: list[float]
    classes: list
    weights: np.ndarray
    passes: int


@dataclass
class _Search:
    """State of one machine's line search."""

    cost: float
    target: int
    x: np.ndarray
    loss: float = np.inf
    gradient: np.ndarray | None = None
    direction: np.ndarray | None = None
    step: float = 0.0
    limit: float = 0.0
    history: list = field(default_factory=list)

    def candidate(self) -> np.ndarray:
        return self.x if self.direction is None else self.x + self.step * self.direction

    def offer(self, hinge: float, slope: np.ndarray, tol: float) -> bool:
        """Take loss and gradient at the candidate; False when the machine is done."""
        at = self.candidate()
        loss = 0.5 * float(at @ at) + self.cost * hinge
        gradient = at + self.cost * slope
        if self.direction is None:
            self.limit = tol * float(np.linalg.norm(gradient))
        else:
            if loss > self.loss + ARMIJO * self.step * float(self.gradient @ self.direction):
                self.step *= 0.5
                return self.step > SMALLEST_STEP
            s, y = at - self.x, gradient - self.gradient
            if float(s @ y) > 1e-12 * float(y @ y):
                self.history = [*self.history, (s, y)][-MEMORY:]
        first = self.direction is None
        self.x, self.loss, self.gradient = at, loss, gradient
        size = float(np.linalg.norm(gradient))
        if size <= self.limit or size == 0.0:
            return False
        self.direction = -self._curved(gradient)
        self.step = min(1.0, 1.0 / size) if first else 1.0
        return True

    def _curved(self, gradient: np.ndarray) -> np.ndarray:
        """The gradient multiplied by the approximate inverse curvature."""
        q, used = gradient.copy(), []
        for s, y in reversed(self.history):
            a = (s @ q) / (s @ y)
            q -= a * y
            used.append(a)
        if self.history:
            s, y = self.history[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(self.history, reversed(used), strict=True):
            q += (a - (y @ q) / (s @ y)) * s
        return q


def fit_linear_svm(
    df: DataFrame, array: str, label: str, costs: Sequence[float], max_passes: int = 2_000, tol: float = 1e-3
) -> LinearSvm:
    """One machine per cost and class. Stops when each gradient has shrunk to ``tol`` of its first length; a machine
    that has not got there in ``max_passes`` passes raises an error."""
    classes = [r[0] for r in df.select(label).distinct().orderBy(label).collect()]
    code = F.coalesce(F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)), F.lit(0)) - 1
    data = df.select(F.col(array).cast("array<double>").alias("v"), code.cast("double").alias("y")).persist()
    try:
        d = data.select(F.max(F.size("v"))).first()[0]
        partitions = data.rdd.getNumPartitions()
        searches = [_Search(float(c), k, np.zeros(d + 1)) for c in costs for k in range(len(classes))]
        moving, passes = list(searches), 0
        while moving and passes < max_passes:
            found = _losses(data, partitions, np.array([s.candidate() for s in moving]), np.array([s.target for s in moving]))
            moving = [s for s, row in zip(moving, found, strict=True) if s.offer(float(row[0]), row[1:], tol)]
            passes += 1
    finally:
        data.unpersist()
    if moving:
        raise RuntimeError(f"{len(moving)} of {len(searches)} machines did not converge in {max_passes} passes")
    weights = np.array([s.x for s in searches]).reshape(len(costs), len(classes), d + 1)
    return LinearSvm([float(c) for c in costs], classes, weights, passes)


def _losses(data: DataFrame, partitions: int, points: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Squared hinge loss and its gradient for every machine: machines x (1 + weights)."""
    shape = (len(points), points.shape[1] + 1)

    def partial(blocks: Iterator[list[np.ndarray]]) -> np.ndarray:
        sums = np.zeros(shape)
        for x, y in blocks:
            side = np.where(y[:, None] == targets[None, :], 1.0, -1.0)
            slack = np.maximum(0.0, 1.0 - side * (x @ points[:, :-1].T + points[:, -1]))
            pull = side * slack
            sums[:, 0] += (slack * slack).sum(0)
            sums[:, 1:-1] -= 2.0 * pull.T @ x
            sums[:, -1] -= 2.0 * pull.sum(0)
        return sums

    return sums_by_slot(data, partial, shape, partitions)


def predict(df: DataFrame, array: str, fitted: LinearSvm, out: str = "predictions") -> DataFrame:
    """The class with the largest margin under every cost, as an array in the order of the costs."""
    weights, classes = fitted.weights, fitted.classes

    @pandas_udf("array<int>")
    def choose(v: pd.Series) -> pd.Series:
        x = matrix(v)
        if not len(x):
            return pd.Series([], dtype=object)
        margins = np.einsum("nd,ckd->nck", x, weights[:, :, :-1]) + weights[None, :, :, -1]
        return pd.Series(list(margins.argmax(2).astype(np.int32)))

    named = F.array(*[F.lit(c) for c in classes])
    return df.withColumn(out, F.transform(choose(F.col(array).cast("array<double>")), lambda i: named[i]))

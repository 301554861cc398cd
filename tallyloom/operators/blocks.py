"""Block-wise comparison of two vector sets.

Rows are dealt into blocks of bounded size; a task receives one block of each side, compares them with
matrix arithmetic and returns a reduced result (the nearest few, or sums). Neither a product of the rows
nor a list of all pairs is ever built.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

# Rows per block: two blocks of 64 doubles per row and their distances in strips stay under 100 MB.
BLOCK_ROWS = 16_384
# Distances held at once within a task.
STRIP_CELLS = 2_000_000


def matrix(column: pd.Series) -> np.ndarray:
    """An array column as a 2-D matrix."""
    if len(column) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in column.to_numpy()])


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by the expanded form; fast, accurate to about 1e-12 of the squared lengths."""
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d2, 0.0)


def strips(rows: int, columns: int):
    """Row ranges whose distance matrix stays within STRIP_CELLS."""
    height = max(1, STRIP_CELLS // max(1, columns))
    for start in range(0, rows, height):
        yield slice(start, min(rows, start + height))


def nearest_in_block(a: np.ndarray, b: np.ndarray, b_rank: np.ndarray, k: int, digits: int):
    """The k nearest rows of ``b`` for every row of ``a``: (row of a, row of b, distance).

    The expanded form only narrows the field; the distances compared and returned are computed from the
    differences and rounded to ``digits``, equal ones ordered by ``b_rank``.
    """
    out = ([], [], [])
    k = min(k, len(b))
    lengths = (a * a).sum(1).max(initial=0.0) + (b * b).sum(1).max(initial=0.0)
    slack = 1e-9 * max(lengths, 1e-12) + 10.0 ** (-digits) * 4
    for rows in strips(len(a), len(b)):
        part = a[rows]
        d2 = squared_distances(part, b)
        kth = np.partition(d2, k - 1, axis=1)[:, k - 1]
        limit = (np.sqrt(kth) + slack) ** 2 + slack * 1e-3
        ri, bi = np.nonzero(d2 <= limit[:, None])
        # Many equal rows may pass; take them in portions that end at a row boundary.
        ends = np.searchsorted(ri, np.arange(len(part)), side="right")
        first = 0
        while first < len(part):
            begin = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, begin + STRIP_CELLS // max(1, a.shape[1]), side="right")))
            r, c = ri[begin:ends[last - 1]], bi[begin:ends[last - 1]]
            exact = np.round(np.sqrt(((part[r] - b[c]) ** 2).sum(1)), digits)
            order = np.lexsort((b_rank[c], exact, r))
            r, c, exact = r[order], c[order], exact[order]
            position = np.arange(len(r)) - np.searchsorted(r, r, side="left")
            keep = position < k
            out[0].append(r[keep] + rows.start)
            out[1].append(c[keep])
            out[2].append(exact[keep])
            first = last
    if not out[0]:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(x) for x in out)

"""A metric index over feature vectors with gaps: pivots, cells around them, and bounds on the distance from a query to any row of a cell.

Distance: sqrt(features / shared * sum of squared differences over the features present on both sides). For one gap pattern of the query and
one of the row that is a scaled Euclidean distance over the shared features, so the triangle inequality holds there. Every cell has one
indexed gap pattern, a pivot over its features, the greatest distance of its rows from the pivot over these features, and a bounding box. Leaving
features out only shortens distances, so the radius also bounds them for queries that lack some of the features.

A row whose own pattern is not indexed goes to the largest indexed pattern inside its own. Such a cell is bounded from below with the
features it is indexed by and the least factor that any of its rows can have. The empty pattern is always indexed: one cell that bounds nothing."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bounds on what the index holds: gap patterns, cells, rows that pivots are learned from.
MAX_PATTERNS, MAX_CELLS, SAMPLE_ROWS = 256, 1024, 1 << 14
#: Rows that a cell should have, and rounds of K-means.
CELL_ROWS, ROUNDS = 256, 4


def squared_sums(a: np.ndarray, b: np.ndarray, features) -> np.ndarray:
    """Squared differences of all rows of a and b summed over the features, one feature at a time."""
    total = np.zeros((len(a), len(b)))
    for f in features:
        diff = a[:, f, None] - b[None, :, f]
        total += diff * diff
    return total


def pivots_of(rows: np.ndarray, wanted: int) -> np.ndarray:
    """K-means centres of rows without gaps, begun from rows spread over the order of their first features."""
    wanted = min(wanted, len(rows))
    order = np.lexsort(rows.T[::-1]) if rows.shape[1] else np.arange(len(rows))
    centres = rows[order[np.linspace(0, len(rows) - 1, wanted).astype(int)]].copy()
    for _ in range(ROUNDS if wanted > 1 else 0):
        near = nearest_pivot(rows, centres)
        count = np.bincount(near, minlength=wanted)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres


def nearest_pivot(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre of every row, in slices of bounded size."""
    out = np.zeros(len(rows), np.int64)
    step = max(1, 2_000_000 // max(len(centres), 1))
    for at in range(0, len(rows), step):
        out[at : at + step] = squared_sums(rows[at : at + step], centres, range(rows.shape[1])).argmin(1)
    return out


@dataclass
class Pivots:
    """Gap patterns (1: present) in the order of more features first, the empty one last, and their cells."""

    patterns: np.ndarray
    centres: list[np.ndarray]
    first: np.ndarray  # first cell of every pattern

    @classmethod
    def learn(cls, sample: np.ndarray, counts: dict[tuple[bool, ...], int], cell_rows: int = CELL_ROWS, max_cells: int = MAX_CELLS) -> Pivots:
        """From a sample of rows and how many rows each of the commonest gap patterns has."""
        width = sample.shape[1]
        present = ~np.isnan(sample)
        names = sorted((p for p in counts if any(p)), key=lambda p: (-sum(p), p))
        scale = max(1.0, sum(counts.values()) / cell_rows / max(1, max_cells - len(names) - 1))
        patterns, centres = [], []
        for p in names:
            rows = np.where(np.array(p), np.nan_to_num(sample), 0.0)[(present == np.array(p)).all(1)]
            if len(rows):
                patterns.append(p)
                centres.append(pivots_of(rows, max(1, int(counts[p] / cell_rows / scale))))
        patterns.append((False,) * width)
        centres.append(np.zeros((1, width)))
        first = np.concatenate([[0], np.cumsum([len(c) for c in centres])])
        return cls(np.array(patterns, bool).reshape(len(patterns), width), centres, first)

    @property
    def cells(self) -> int:
        return int(self.first[-1])

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, distance to its pivot over the cell's features, whether the cell's pattern is the row's) of every row."""
        cell, distance, own = np.zeros(len(rows), np.int64), np.zeros(len(rows)), np.zeros(len(rows), bool)
        present = ~np.isnan(rows)
        filled = np.nan_to_num(rows)
        kinds, kind = np.unique(present, axis=0, return_inverse=True) if len(rows) else (present[:0], np.zeros(0, int))
        for i, have in enumerate(kinds):
            at = np.flatnonzero(kind.ravel() == i)
            number = int(np.flatnonzero((~self.patterns | have).all(1))[0])
            pattern = self.patterns[number]
            part = np.where(pattern, filled[at], 0.0)
            near = nearest_pivot(part, self.centres[number])
            cell[at] = self.first[number] + near
            gap = part - self.centres[number][near]
            distance[at] = np.sqrt((gap * gap).sum(1))
            own[at] = (pattern == have).all()
        return cell, distance, own


@dataclass
class Cells:
    """What is known of the rows of every cell: usable rows per target, rows, radius, box over the cell's features, and whether all rows have its pattern."""

    pattern: np.ndarray
    pivot: np.ndarray
    usable: np.ndarray
    rows: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray
    pure: np.ndarray

    @classmethod
    def empty(cls, pivots: Pivots, targets: int) -> Cells:
        n, width = pivots.cells, pivots.patterns.shape[1]
        pattern = np.repeat(pivots.patterns, [len(c) for c in pivots.centres], axis=0)
        return cls(
            pattern, np.concatenate(pivots.centres), np.zeros((n, targets), np.int64), np.zeros(n, np.int64), np.zeros(n), np.full((n, width), np.inf), np.full((n, width), -np.inf), np.ones(n, bool)
        )

    def add(self, cell: np.ndarray, distance: np.ndarray, own: np.ndarray, vectors: np.ndarray, usable: np.ndarray) -> None:
        """Takes rows up; cells of several tasks can be merged with ``merge``."""
        np.add.at(self.usable, cell, usable.astype(np.int64))
        np.add.at(self.rows, cell, 1)
        np.maximum.at(self.radius, cell, distance)
        np.logical_and.at(self.pure, cell, own)
        inside = self.pattern[cell]
        np.minimum.at(self.low, cell, np.where(inside, vectors, np.inf))
        np.maximum.at(self.high, cell, np.where(inside, vectors, -np.inf))

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) scaled squared distance between each query and any row of each cell; queries share one gap pattern. A cell that can hold no row with a
        shared feature is infinitely far; where nothing bounds a cell from above, ``most`` is infinite."""
        have = ~np.isnan(q[0])
        width = q.shape[1]
        both = self.pattern & have
        shared = both.sum(1)
        square, outside, across = (np.zeros((len(q), len(self.rows))) for _ in range(3))
        for f in np.flatnonzero(have):
            on = both[:, f]
            if not on.any():
                continue
            x = q[:, f, None]
            gap = (x - self.pivot[None, on, f]) ** 2
            low, high = self.low[None, on, f], self.high[None, on, f]
            square[:, on] += gap
            with np.errstate(invalid="ignore"):
                outside[:, on] += np.nan_to_num(np.maximum(np.maximum(low - x, x - high), 0.0), posinf=0.0) ** 2
                across[:, on] += np.maximum(high - x, x - low) ** 2
        away = np.sqrt(square)
        # What subtraction may have lost is given back.
        inner = np.maximum(away - self.radius - 1e-9 * (away + self.radius), 0.0)
        least = np.maximum(inner * inner, outside * (1 - 1e-9))
        most = np.minimum((away + self.radius) ** 2, across) * (1 + 1e-9)
        # A row of a wider pattern shares at least these features and at most all that the query has.
        factor = np.where(self.pure, width / np.maximum(shared, 1), width / max(int(have.sum()), 1))
        least = least * factor
        most = np.where(self.pure & (shared > 0), most * factor, np.inf)
        never = (self.pure & (shared == 0)) | (self.rows == 0) | (not have.any())
        return np.where(never, np.inf, least), np.where(never, np.inf, most)

    def enough(self, most: np.ndarray, wanted: list[int], k: int) -> np.ndarray:
        """Per query the cells of its first search: for every wanted target those nearest by their far end that together have k usable rows."""
        picked = np.zeros(most.shape, bool)
        order = np.argsort(most, axis=1, kind="stable")
        finite = np.isfinite(np.take_along_axis(most, order, 1))
        for t in wanted:
            have = self.usable[:, t][order] * finite
            before = np.cumsum(have, axis=1) - have
            first = (have > 0) & (before < k)
            rows, at = np.nonzero(first)
            picked[rows, order[rows, at]] = True
        return picked

    def reached(self, least: np.ndarray, edge: np.ndarray, wanted: list[int]) -> np.ndarray:
        """Cells that may hold a row as near as ``edge`` (queries x wanted), the k-th distance found so far."""
        out = np.zeros(least.shape, bool)
        for i, t in enumerate(wanted):
            out |= (least <= edge[:, i, None] * (1 + 1e-7)) & (self.usable[:, t] > 0) & np.isfinite(least)
        return out

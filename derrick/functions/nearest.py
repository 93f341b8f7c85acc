"""Distance helpers that run inside tasks on small numeric blocks.

The distance is nan-Euclidean: sqrt(p / common * sum of squared differences over
the coordinates both points have), p being the number of columns.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa

DIST_DIGITS = 9


def matrix_of(columns: list[pa.Array]) -> np.ndarray:
    """Rows by columns, NaN where a value is missing."""
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype("float64") for c in columns])


def rough_squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by matrix products, and a bound on their error per row
    of ``x``. Pairs without a common coordinate are infinitely far."""
    has_x, has_y = ~np.isnan(x), ~np.isnan(y)
    x0, y0 = np.where(has_x, x, 0.0), np.where(has_y, y, 0.0)
    wx, wy = has_x.astype("float64"), has_y.astype("float64")
    squares = (x0 * x0) @ wy.T + wx @ (y0 * y0).T - 2.0 * (x0 @ y0.T)
    common = wx @ wy.T
    p = x.shape[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        squares = np.where(common > 0, np.maximum(squares, 0.0) * p / common, np.inf)
    largest = (y0 * y0).sum(axis=1).max(initial=0.0)
    error = 1e-13 * p * p * ((x0 * x0).sum(axis=1) + largest)
    return squares, error


def with_slack(limit: np.ndarray, error: np.ndarray) -> np.ndarray:
    """A squared limit widened by the rough error and by the rounding of distances."""
    return limit * (1 + 1e-12) + 2 * error + 8e-9 * np.sqrt(limit) + 1e-16


def kth_square(squares: np.ndarray, k: int) -> np.ndarray:
    """k-th smallest value of each row, infinite where there are fewer."""
    if squares.shape[1] < k:
        return np.full(len(squares), np.inf)
    return np.partition(squares, k - 1, axis=1)[:, k - 1]


def exact_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Rounded distance of each row of ``x`` to the same row of ``y``."""
    total = np.zeros(len(x))
    common = np.zeros(len(x))
    for j in range(x.shape[1]):
        gap = x[:, j] - y[:, j]
        both = ~np.isnan(gap)
        total += np.where(both, gap * gap, 0.0)
        common += both
    return np.round(np.sqrt(x.shape[1] / common * total), DIST_DIGITS)


def block_nearest(receivers: np.ndarray, donors: np.ndarray, k: int, centre: np.ndarray, known: np.ndarray | None = None):
    """The k nearest donors of every missing cell of the receivers.

    Yields ``(column, receiver index, donor index, distance)`` arrays per column.
    Ties go to the earlier donor. Matrix products select the candidates with a
    proven margin; their distances are then computed exactly. ``known`` holds, per receiver and
    column, a distance that its k-th nearest doesn't exceed, where one is known; donors beyond it are left out.
    """
    filled = ~np.isnan(donors)
    if len(donors) and (filled == filled[0]).all() and np.isfinite(centre).all():
        yield from _even_nearest(receivers, donors, k, centre, known)
        return
    squares, error = rough_squares(receivers - centre, donors - centre)
    for column in range(receivers.shape[1]):
        rows = np.flatnonzero(np.isnan(receivers[:, column]))
        able = np.flatnonzero(~np.isnan(donors[:, column]))
        if not len(rows) or not len(able):
            continue
        part = squares if len(rows) == len(receivers) and len(able) == len(donors) else squares[np.ix_(rows, able)]
        limit = np.full(len(rows), np.inf) if known is None else known[rows, column] ** 2
        open_ = np.flatnonzero(~np.isfinite(limit))
        if len(open_):
            limit[open_] = kth_square(part[open_], min(k, len(able)))
        i, j = np.nonzero((part <= with_slack(limit, error[rows])[:, None]) & np.isfinite(part))
        receiver, donor = rows[i], able[j]
        yield column, *_first_k(receiver, donor, exact_distances(receivers[receiver], donors[donor]), k)


def _first_k(receiver: np.ndarray, donor: np.ndarray, distance: np.ndarray, k: int) -> tuple:
    order = np.lexsort((donor, distance, receiver))
    receiver, donor, distance = receiver[order], donor[order], distance[order]
    starts = np.r_[0, np.flatnonzero(np.diff(receiver)) + 1] if len(receiver) else np.array([], dtype=int)
    place = np.arange(len(receiver)) - np.repeat(starts, np.diff(np.r_[starts, len(receiver)]))
    keep = place < k
    return receiver[keep], donor[keep], distance[keep]


def _even_nearest(receivers: np.ndarray, donors: np.ndarray, k: int, centre: np.ndarray, known: np.ndarray | None):
    """``block_nearest`` for donors that lack the same columns. What a receiver has in common with one of them it has with
    all, so limits are scaled instead of squares, and one comparison serves all columns."""
    n, p = receivers.shape
    filled = ~np.isnan(donors[0])
    columns = np.flatnonzero(filled & np.isnan(receivers).any(axis=0))
    if not len(columns):
        return
    x, y0 = receivers - centre, donors[:, filled] - centre[filled]
    x0, w = np.where(np.isnan(x), 0.0, x), (~np.isnan(x))[:, filled].astype("float64")
    error = 1e-13 * p * p * ((x0 * x0).sum(axis=1) + (y0 * y0).sum(axis=1).max(initial=0.0))
    x0, common = x0[:, filled], w.sum(axis=1)
    own = (x0 * x0).sum(axis=1)
    # Squared distances, but for what is the same in a row: its own square, and the share of columns in common.
    rest = np.hstack([w, -2.0 * x0]) @ np.hstack([y0 * y0, y0]).T
    limit = np.full((n, len(columns)), np.inf) if known is None else known[:, columns] ** 2
    open_ = np.flatnonzero((np.isnan(receivers[:, columns]) & ~np.isfinite(limit)).any(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        if len(open_):
            kth = np.maximum(kth_square(rest[open_], min(k, len(donors))) + own[open_], 0.0) * p / common[open_]
            limit[open_] = np.where(np.isfinite(limit[open_]), limit[open_], kth[:, None])
        bound = np.minimum(with_slack(limit, error[:, None]) * (common / p)[:, None] - own[:, None], np.finfo("float64").max)
    # Nothing is below a bound that is no number.
    bound[~np.isnan(receivers[:, columns]) | ((common == 0) | ~np.isfinite(own))[:, None]] = np.nan
    widest = np.fmax.reduce(bound, axis=1)
    receiver, donor = np.divmod(np.flatnonzero(rest <= widest[:, None]), len(donors))
    near, distance = rest[receiver, donor], exact_distances(receivers[receiver], donors[donor])
    for at, column in enumerate(columns):
        mine = np.flatnonzero(near <= bound[receiver, at])
        yield int(column), *_first_k(receiver[mine], donor[mine], distance[mine], k)


def _slices(n: int, size: int = 1 << 18):
    return (slice(at, at + size) for at in range(0, n, size))


def _masks(filled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of a boolean matrix, and which of them each row is."""
    packed = np.ascontiguousarray(np.packbits(filled, axis=1))
    whole = packed.view(f"V{packed.shape[1]}").reshape(-1) if packed.shape[1] > 8 else _whole_numbers(packed)
    _, first, which = np.unique(whole, return_index=True, return_inverse=True)
    return filled[first], which.reshape(-1)


def _whole_numbers(packed: np.ndarray) -> np.ndarray:
    return np.pad(packed, ((0, 0), (0, 8 - packed.shape[1]))).view("uint64").reshape(-1)


class CellTree:
    """Donor cells as a tree: a root for each common missing pattern and one for the rest, whose nodes are halved.

    It is grown on some donors and then places all of them; which ones it was grown on decides how even
    the cells are, never which neighbours are found. A row without the column of a cut goes to the lower half.
    """

    def __init__(self, sample: np.ndarray, masks: np.ndarray, total: int, target: int, most: int):
        roots = {mask.tobytes(): node for node, mask in enumerate(masks)}
        self.roots, self.column, self.cut = roots, [-1] * (len(masks) + 1), [0.0] * (len(masks) + 1)
        self.lower, self.upper = [-1] * len(self.column), [-1] * len(self.column)
        self.opened = [False] * len(masks) + [True]
        start = self._start(sample)
        weight = total / max(1, len(sample))
        heap = [(-np.count_nonzero(start == node), node) for node in range(len(self.column))]
        parts = {node: np.flatnonzero(start == node) for _, node in heap}
        heapq.heapify(heap)
        leaves = len(heap)
        while heap and leaves < most and -heap[0][0] * weight > target:
            _, node = heapq.heappop(heap)
            rows = parts.pop(node)
            split = _halves(sample[rows])
            if split is None:
                continue
            self.column[node], self.cut[node], low = split
            for side, chosen in ((self.lower, rows[low]), (self.upper, rows[~low])):
                side[node] = len(self.column)
                heapq.heappush(heap, (-len(chosen), len(self.column)))
                parts[len(self.column)] = chosen
                for field, value in ((self.column, -1), (self.cut, 0.0), (self.lower, -1), (self.upper, -1), (self.opened, self.opened[node])):
                    field.append(value)
            leaves += 1
        self.column, self.lower, self.upper = (np.array(x, dtype="int32") for x in (self.column, self.lower, self.upper))
        self.cut, self.opened = np.array(self.cut), np.array(self.opened)

    @classmethod
    def of(cls, fields: dict) -> CellTree:
        """The tree with these ``vars``; a broadcast carries them, as it can't carry the class."""
        tree = cls.__new__(cls)
        vars(tree).update(fields)
        return tree

    def _start(self, x: np.ndarray) -> np.ndarray:
        masks, which = _masks(~np.isnan(x))
        nodes = [self.roots.get(mask.tobytes(), len(self.roots)) for mask in masks]
        return np.array(nodes, dtype="int32")[which] if len(x) else np.zeros(0, "int32")

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        node = self._start(x)
        rows = np.flatnonzero(self.column[node] >= 0)
        while len(rows):
            at = node[rows]
            upper = x[rows, self.column[at]] > self.cut[at]
            node[rows] = np.where(upper, self.upper[at], self.lower[at])
            rows = rows[self.column[node[rows]] >= 0]
        return node

    def boxes(self, leaves: np.ndarray, low: np.ndarray, high: np.ndarray, rows: np.ndarray) -> tuple:
        """Bounding boxes and rows of all nodes from those of the leaves that hold rows."""
        lows, highs = (np.full((len(self.column), low.shape[1]), np.nan) for _ in range(2))
        counts = np.zeros(len(self.column), dtype="int64")
        lows[leaves], highs[leaves], counts[leaves] = low, high, rows
        for node in range(len(self.column) - 1, -1, -1):  # children come after their parents
            if self.column[node] >= 0:
                below = [self.lower[node], self.upper[node]]
                lows[node], highs[node] = np.fmin(*lows[below]), np.fmax(*highs[below])
                counts[node] = counts[below].sum()
        return lows, highs, counts


def _halves(x: np.ndarray):
    """Column, cut and the rows not above it: along the column that spreads most, at its median; None if all rows agree."""
    filled = ~np.isnan(x)
    n = np.maximum(filled.sum(axis=0), 1)
    x0 = np.where(filled, x, 0.0)
    mean = x0.sum(axis=0) / n
    spread = (np.where(filled, x - mean, 0.0) ** 2).sum(axis=0) / n
    for column in np.argsort(-spread, kind="stable"):
        values = np.sort(x[filled[:, column], column])
        if not len(values) or values[0] == values[-1]:
            continue
        cut = values[(len(values) - 1) // 2]
        if cut == values[-1]:
            cut = values[np.searchsorted(values, cut) - 1]
        return int(column), float(cut), ~(x[:, column] > cut)
    return None


class CellIndex:
    """Bounding boxes of the donor cells and a few real donors.

    For a receiver, the k-th nearest of those donors bounds the distance of its
    k-th nearest donor overall, so only cells whose box comes that near can
    matter. The rows of an ``open`` cell may lack any of the box's columns: their mean
    square gap is at least the smallest of the gaps to the box, whichever they have.
    """

    def __init__(self, low, high, opened, landmarks, centre, k, tree=None, rows=None):
        """``low`` and ``high`` are those of the cells, or of all nodes of the tree with these ``vars``, whose ``rows`` are given then."""
        self.low, self.high, self.opened, self.rows = low, high, opened, rows
        self.tree = tree and CellTree.of(tree)
        self.landmarks, self.centre, self.k = landmarks, centre, k
        self.filled = ~np.isnan(low)
        self.patterns, self.pattern_of = _masks(self.filled)
        # By column; what isn't filled bounds nothing.
        self.lows, self.highs = np.where(self.filled, low, -np.inf).T.copy(), np.where(self.filled, high, np.inf).T.copy()

    def _reach(self, x: np.ndarray) -> np.ndarray:
        """Squared distance within which the k nearest donors lie, per row and column."""
        squares, error = rough_squares(x - self.centre, self.landmarks - self.centre)
        reach = np.full(x.shape, -np.inf)
        for column in range(x.shape[1]):
            rows = np.flatnonzero(np.isnan(x[:, column]))
            able = ~np.isnan(self.landmarks[:, column])
            if len(rows):
                limit = kth_square(squares[np.ix_(rows, np.flatnonzero(able))], self.k)
                reach[rows, column] = with_slack(limit, error[rows])
        return reach

    def _points(self, x: np.ndarray) -> tuple:
        """Rows as ``_gaps`` takes them: by column, a missing value as one that is in every box, and per row and
        pattern of a cell the number of columns in common."""
        has = ~np.isnan(x)
        masks, which = _masks(has)
        common = masks.astype("float64") @ self.patterns.astype("float64").T
        return x, np.where(has, x, np.inf).T.copy(), np.where(has, x, -np.inf).T.copy(), which, common

    def _gaps(self, points: tuple, row: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """What the squared distance of each row to any donor of the cell beside it can't be below."""
        out = np.empty(len(row))
        x, above, below, which, shared = points
        p = x.shape[1]
        for part in _slices(len(row), 1 << 14):
            r, c = row[part], cell[part]
            gaps = np.zeros(len(r))
            for j in range(p):
                gap = np.maximum(self.lows[j].take(c) - above[j].take(r), below[j].take(r) - self.highs[j].take(c))
                np.maximum(gap, 0.0, out=gap)
                gap *= gap
                gaps += gap
            common = shared[which.take(r), self.pattern_of.take(c)]
            with np.errstate(divide="ignore", invalid="ignore"):
                out[part] = np.where(common > 0, gaps * p / common, np.inf)
            loose = np.flatnonzero(self.opened.take(c) & (common > 0))
            if len(loose):
                out[part][loose] = self._smallest(x[r[loose]], c[loose]) * p
        return out

    def _smallest(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """The smallest squared gap over the columns that a row has in common with the cell beside it."""
        gap = np.maximum(np.maximum(self.low[cell] - x, x - self.high[cell]), 0.0)
        return np.fmin.reduce(gap * gap, axis=1, initial=np.inf)

    def pairs(self, x: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(row, cell)``: which cells each receiver has to see. ``known`` as in ``block_nearest``."""
        if known is None:
            reach = self._reach(x)
        else:
            reach = np.where(np.isnan(x), with_slack(known**2, 0.0), -np.inf)
            lost = np.flatnonzero((np.isnan(x) & ~np.isfinite(known)).any(axis=1))
            if len(lost):
                reach[lost] = np.minimum(np.where(np.isnan(reach[lost]), np.inf, reach[lost]), self._reach(x[lost]))
        farthest = np.column_stack([np.where(pattern[None, :], reach, -np.inf).max(axis=1) for pattern in self.patterns])
        points = self._points(x)
        first = np.arange(len(self.low) if self.tree is None else len(self.tree.roots) + 1)
        row, cell = np.repeat(np.arange(len(x)), len(first)), np.tile(first, len(x))
        found = []
        while len(row):
            near = self._gaps(points, row, cell)
            seen = (near <= farthest[row, self.pattern_of[cell]] * (1 + 1e-9)) & np.isfinite(near)
            row, cell = row[seen], cell[seen]
            inner = np.zeros(len(cell), bool) if self.tree is None else self.tree.column[cell] >= 0
            found.append((row[~inner], cell[~inner]))
            row, cell = row[inner], cell[inner]
            if len(row):
                row, cell = np.tile(row, 2), np.concatenate([self.tree.lower[cell], self.tree.upper[cell]])
        return tuple(np.concatenate(part) for part in zip(*found, strict=True)) if found else (first[:0], first[:0])

    def visits(self, x: np.ndarray) -> np.ndarray:
        """Boolean rows by cells: which cells each receiver has to see."""
        seen = np.zeros((len(x), len(self.low)), bool)
        seen[self.pairs(x)] = True
        return seen

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, cell)``: for every missing column of a row a cell near to it whose donors fill the column,
        found by going down the tree, in the largest pattern that fills it. Rows stand together."""
        tops = np.arange(len(self.tree.roots) + 1)
        order = tops[np.argsort(-self.rows[tops], kind="stable")]
        masks, which = _masks(~np.isnan(x))
        rows, cells = [], []
        for number, mask in enumerate(masks):
            mine = np.flatnonzero(which == number)
            fit = [[top for top in order if self.filled[top, j] and (self.filled[top] & mask).any()] for j in np.flatnonzero(~mask)]
            for top in sorted({tops[0] for tops in fit if tops}):
                rows.append(mine)
                cells.append(np.full(len(mine), top))
        if not rows:
            return tops[:0], tops[:0]
        row, cell, points = np.concatenate(rows), np.concatenate(cells), self._points(x)
        inner = np.flatnonzero(self.tree.column[cell] >= 0)
        while len(inner):
            sides = [side[cell[inner]] for side in (self.tree.lower, self.tree.upper)]
            lower, upper = (self._gaps(points, row[inner], side) for side in sides)
            tied = np.flatnonzero(lower == upper)
            lower[tied], upper[tied] = (self._to_middle(x, row[inner[tied]], side[tied]) for side in sides)
            cell[inner] = np.where(lower <= upper, *sides)
            inner = inner[self.tree.column[cell[inner]] >= 0]
        by_row = np.argsort(row, kind="stable")
        return row[by_row], cell[by_row]

    def _to_middle(self, x: np.ndarray, row: np.ndarray, cell: np.ndarray) -> np.ndarray:
        gap = x[row] - (self.low[cell] + self.high[cell]) / 2
        return np.where(np.isnan(gap), 0.0, gap * gap).sum(axis=1)

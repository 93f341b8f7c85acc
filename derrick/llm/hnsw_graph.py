"""A navigable small-world graph over one shard of vectors, in flat arrays, with numpy alone.

Nodes are numbered by falling level, so level ``l`` holds the nodes below ``sizes[l]`` and its edges are one
flat array of ``sizes[l]`` rows of neighbour numbers, -1 where a row is short. Vectors are stretched by one
more component to a common length, which turns the largest inner product into the nearest neighbour.

Both building and searching walk the graph for many vectors at once: each keeps a beam of the best
nodes seen, expands the best unexpanded ones, and ends when none is left in the beam.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEGREE = 16  # edges of a node on upper levels; twice as many at the bottom
BUILD_BEAM = 64
SHRINK = 16  # nodes of a level for one of the next
EXPANDED = 4
BATCH = 512
FIRST = 64  # nodes that are joined with each other before the graph is searched


@dataclass
class Graph:
    sizes: list[int]
    edges: list[np.ndarray]  # int32, one flat array per level

    def level(self, number: int) -> np.ndarray:
        return self.edges[number].reshape(self.sizes[number], -1)


def stretched(vectors: np.ndarray) -> np.ndarray:
    """Vectors scaled and stretched to length 1, in single precision."""
    scaled = vectors / max(float(np.abs(vectors).max(initial=0)), 1e-300)
    square = np.einsum("ij,ij->i", scaled, scaled)
    top = max(float(square.max(initial=0)), 1e-300)
    rest = np.sqrt(np.maximum(top - square, 0))
    return (np.column_stack([scaled, rest]) / np.sqrt(top)).astype(np.float32)


def level_sizes(n: int) -> list[int]:
    """How many nodes each level holds; which ones is left to the caller's numbering."""
    sizes = [n]
    while sizes[-1] > FIRST:
        sizes.append(-(-sizes[-1] // SHRINK))
    return sizes


def beam_search(x: np.ndarray, edges: np.ndarray, q: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Node numbers (-1: none) and similarities of the beams of all rows of ``q``, unordered.

    ``entries`` has at least one node for each row; -1 and repeats are passed over."""
    n_rows = len(q)
    ids = np.full((n_rows, width), -1, np.int32)
    score = np.full((n_rows, width), -np.inf, np.float32)
    done = np.zeros((n_rows, width), bool)
    seen = np.zeros((n_rows, len(edges)), bool)

    def add(rows: np.ndarray, found: np.ndarray) -> None:
        """Merge the nodes ``found`` into the beams of ``rows``."""
        found = np.sort(found, axis=1)
        new = found >= 0
        new[:, 1:] &= found[:, 1:] != found[:, :-1]
        new &= ~seen[rows[:, None], found]
        line, column = np.nonzero(new)
        node = found[line, column]
        seen[rows[line], node] = True
        value = np.full(found.shape, -np.inf, np.float32)
        value[line, column] = np.einsum("ij,ij->i", q[rows[line]], x[node])
        all_ids = np.concatenate([ids[rows], np.where(new, found, -1)], axis=1)
        all_score = np.concatenate([score[rows], value], axis=1)
        all_done = np.concatenate([done[rows], np.zeros(found.shape, bool)], axis=1)
        best = np.argpartition(-all_score, width - 1, axis=1)[:, :width]
        ids[rows] = np.take_along_axis(all_ids, best, 1)
        score[rows] = np.take_along_axis(all_score, best, 1)
        done[rows] = np.take_along_axis(all_done, best, 1)

    rows = np.arange(n_rows)
    add(rows, entries)
    while len(rows):
        open_score = np.where(done[rows] | (ids[rows] < 0), -np.inf, score[rows])
        some = min(EXPANDED, width)
        top = np.argpartition(-open_score, some - 1, axis=1)[:, :some] if some < width else np.broadcast_to(np.arange(width), open_score.shape)
        is_open = np.take_along_axis(open_score, top, 1) > -np.inf
        alive = is_open.any(axis=1)
        rows, top, is_open = rows[alive], top[alive], is_open[alive]
        if not len(rows):
            break
        nodes = np.where(is_open, np.take_along_axis(ids[rows], top, 1), -1)
        line, column = np.nonzero(is_open)
        done[rows[line], top[line, column]] = True
        found = np.where(nodes[:, :, None] >= 0, edges[nodes], -1)
        add(rows, found.reshape(len(rows), -1))
    return ids, score


def choose(x: np.ndarray, own: np.ndarray, ids: np.ndarray, score: np.ndarray, degree: int) -> np.ndarray:
    """The edges of each row of ``own`` out of its candidates: the near ones that no chosen edge is nearer to, filled up with the nearest others."""
    order = np.argsort(-score, axis=1, kind="stable")[:, : 3 * degree]
    ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
    valid = (ids >= 0) & (ids != own[:, None]) & (score > -np.inf)
    near = x[ids]
    among = near @ near.transpose(0, 2, 1)
    taken = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        hidden = (taken & (among[:, c, :] > score[:, c, None])).any(axis=1)
        taken[:, c] = valid[:, c] & ~hidden & (taken.sum(axis=1) < degree)
    # Chosen ones first, then the others by nearness.
    rank = np.where(taken, 0, np.where(valid, 1, 2))
    first = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    picked = np.where(np.take_along_axis(rank, first, 1) < 2, np.take_along_axis(ids, first, 1), -1)
    if picked.shape[1] < degree:
        picked = np.pad(picked, ((0, 0), (0, degree - picked.shape[1])), constant_values=-1)
    return picked.astype(np.int32)


def _backward(x: np.ndarray, edges: np.ndarray, sources: np.ndarray, targets: np.ndarray) -> None:
    """Give the targets of new edges an edge back, and choose anew where a node gets too many."""
    degree = edges.shape[1]
    score = np.einsum("ij,ij->i", x[sources], x[targets])
    order = np.lexsort((-score, targets))
    sources, targets, score = sources[order], targets[order], score[order]
    node, first, n = np.unique(targets, return_index=True, return_counts=True)
    place = np.arange(len(targets)) - np.repeat(first, n)
    near = place < degree
    added = np.full((len(node), int(min(n.max(), degree))), -1, np.int32)
    added[np.repeat(np.arange(len(node)), n)[near], place[near]] = sources[near]
    for at in range(0, len(node), BATCH):
        some = node[at : at + BATCH]
        ids = np.concatenate([edges[some], added[at : at + BATCH]], axis=1)
        value = np.where(ids >= 0, np.einsum("ij,ikj->ik", x[some], x[ids]), -np.inf)
        edges[some] = choose(x, some, ids, value, degree)


def _entries(x: np.ndarray, graph: list[np.ndarray], q: np.ndarray, first: int = 1) -> np.ndarray:
    """Where to enter the level below ``graph``, whose levels are given from the top; the top one is entered at its ``first`` nodes."""
    entries = np.tile(np.arange(first, dtype=np.int32), (len(q), 1))
    for edges in graph:
        ids, score = beam_search(x, edges, q, entries, 8)
        best = np.argsort(-score, axis=1)[:, :EXPANDED]
        entries = np.take_along_axis(ids, best, 1)
    return entries


def build(vectors: np.ndarray) -> Graph:
    """The graph over vectors that stand in the order of their nodes."""
    x = stretched(vectors)
    sizes = level_sizes(len(x))
    above: list[np.ndarray] = []
    for number in range(len(sizes) - 1, -1, -1):
        size, degree = sizes[number], DEGREE * (2 if number == 0 else 1)
        edges = np.full((size, degree), -1, np.int32)
        inner = sizes[number + 1] if number + 1 < len(sizes) else 0  # nodes that the levels above hold too
        at = min(size, FIRST)
        start = np.arange(at, dtype=np.int32)
        score = x[:at] @ x[:at].T
        edges[:at] = choose(x, start, np.tile(start, (at, 1)), score, degree)
        line, column = np.nonzero(edges[:at] >= 0)
        if at > 1:
            _backward(x, edges, start[line], edges[:at][line, column])
        while at < size:
            end = min(size, at + min(at, BATCH), max(inner, at + 1) if at < inner else size)
            new = np.arange(at, end, dtype=np.int32)
            q = x[at:end]
            # A node of the level above could be its own entry; those enter at the first node.
            entries = _entries(x, above, q) if at >= inner else np.zeros((len(q), 1), np.int32)
            ids, score = beam_search(x, edges, q, entries, BUILD_BEAM)
            beside = q @ q.T
            np.fill_diagonal(beside, -np.inf)
            n_beside = min(DEGREE, len(new))
            near = np.argpartition(-beside, n_beside - 1, axis=1)[:, :n_beside]
            ids = np.concatenate([ids, new[near]], axis=1)
            score = np.concatenate([score, np.take_along_axis(beside, near, 1)], axis=1)
            edges[new] = choose(x, new, ids, score, degree)
            line, column = np.nonzero(edges[new] >= 0)
            _backward(x, edges, new[line], edges[new][line, column])
            at = end
        above.append(edges)
    above.reverse()
    return Graph(sizes, [e.ravel() for e in above])


def search(vectors: np.ndarray, graph: Graph, queries: np.ndarray, width: int) -> np.ndarray:
    """Nodes found for each query, -1 where a beam is short; ``width`` sets the beam at the bottom. A graph of one level is entered at all its nodes."""
    x = stretched(vectors)
    scale = np.abs(queries).max(axis=1, initial=0)[:, None]
    flat = queries / np.maximum(scale, 1e-300)
    q = np.column_stack([flat, np.zeros(len(flat))]).astype(np.float32)
    levels = [graph.level(k) for k in range(len(graph.sizes) - 1, -1, -1)]
    first = 1 if len(levels) > 1 else len(x)
    found = [beam_search(x, levels[-1], q[a : a + BATCH], _entries(x, levels[:-1], q[a : a + BATCH], first), width)[0] for a in range(0, len(q), BATCH)]
    return np.concatenate(found) if found else np.zeros((0, width), np.int32)

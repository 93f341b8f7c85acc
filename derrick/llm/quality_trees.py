"""Quality rules: base rules on document counts, then gradient-boosted trees.

The trees are fitted in numpy on a bounded sample of labelled rows
(``common.LABEL_SAMPLE``), with monotonic constraints: more symbols, repeats or stress
marks never raise a score. They are flattened into node arrays, and a batch of
documents walks all trees level by level.

Base rules: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT`` percent of
the words in repeated windows, fail a document whatever the trees say.

Cases: null and empty texts have no words and fail. Without labels of both
kinds the trees keep everything that passes the base rules (drop it if all labels are
0). Equal texts get equal verdicts. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from derrick.llm.common import LABEL_SAMPLE
from derrick.llm.quality_gam import sample
from derrick.llm.statistics import COUNTS, FEATURES, measure

MIN_WORDS = 20
MAX_REPEAT = 30
KEEP = 0.5
TREES = 80
DEPTH = 3
BINS = 64
RATE = 0.15
RIDGE = 3.0
LEAST = 5.0

# -1: a higher value may only lower the score; 0: free.
MONOTONE = {
    "symbols_per_word": -1,
    "stress_per_word": -1,
    "bar_per_word": -1,
    "same_as_last_share": -1,
    "repeat_share": -1,
    "dup_line_share": -1,
}


@dataclass
class Forest:
    """All trees in one set of arrays. A leaf points to itself, so that every walk may take ``depth`` steps."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray, block: int = 4096) -> np.ndarray:
        out = np.empty(len(x))
        for at in range(0, len(x), block):
            rows = x[at : at + block]
            node = np.repeat(self.roots[None, :], len(rows), 0)
            pick = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                node = np.where(rows[pick, self.feature[node]] < self.cut[node], self.low[node], self.high[node])
            out[at : at + block] = self.base + self.value[node].sum(1)
        return 1.0 / (1.0 + np.exp(-np.clip(out, -30, 30)))


class _Grower:
    """Grows one tree after the other on histograms of binned features."""

    def __init__(self, x: np.ndarray, signs: list[int]):
        self.x, self.signs = x, signs
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        self.binned = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)]
        self.nodes: list[list[float]] = []  # feature, cut, low, high, value

    def leaf(self, value: float) -> int:
        at = len(self.nodes)
        self.nodes.append([0, np.inf, at, at, value])
        return at

    def split(self, rows, g, h, lowest, highest):
        best = None
        gs, hs = g[rows].sum(), h[rows].sum()
        for f, edges in enumerate(self.edges):
            if not len(edges):
                continue
            b = self.binned[f][rows]
            gl = np.cumsum(np.bincount(b, g[rows], len(edges) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, h[rows], len(edges) + 1))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=len(edges) + 1))[:-1]
            left = np.clip(gl / (hl + RIDGE), lowest, highest)
            right = np.clip((gs - gl) / (hs - hl + RIDGE), lowest, highest)
            gain = gl**2 / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs**2 / (hs + RIDGE)
            fine = (nl >= LEAST) & (len(rows) - nl >= LEAST)
            if self.signs[f]:
                fine &= (right - left) * self.signs[f] >= 0
            gain = np.where(fine, gain, -1.0)
            k = int(np.argmax(gain))
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = (gain[k], f, k, left[k], right[k])
        return best

    def grow(self, rows, g, h, depth, lowest=-np.inf, highest=np.inf) -> int:
        value = float(np.clip(g[rows].sum() / (h[rows].sum() + RIDGE), lowest, highest)) * RATE
        found = self.split(rows, g, h, lowest, highest) if depth else None
        if found is None:
            return self.leaf(value)
        _, f, k, left, right = found
        at = self.leaf(0.0)
        goes_low = self.binned[f][rows] <= k
        low_range, high_range = (lowest, highest), (lowest, highest)
        if self.signs[f]:
            middle = (left + right) / 2
            low_range, high_range = ((middle, highest), (lowest, middle)) if self.signs[f] < 0 else ((lowest, middle), (middle, highest))
        low = self.grow(rows[goes_low], g, h, depth - 1, *low_range)
        high = self.grow(rows[~goes_low], g, h, depth - 1, *high_range)
        self.nodes[at] = [f, self.edges[f][k], low, high, 0.0]
        return at


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, monotone: dict[str, int] = MONOTONE) -> Forest:
    """Boosted trees on the logistic loss; every leaf of a constrained tree lies within the bounds of its ancestors."""
    share = float(y.mean()) if len(y) else 1.0
    grower = _Grower(x, [monotone.get(name, 0) for name in FEATURES[: x.shape[1]]]) if len(y) else None
    one_kind = share in (0.0, 1.0)
    base = (30.0 if share else -30.0) if one_kind else float(np.log(share / (1 - share)))
    roots = []
    if not one_kind:
        total, rows = np.full(len(y), base), np.arange(len(y))
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))
            roots.append(grower.grow(rows, y - p, p * (1 - p), depth))
            one = _flat(0.0, depth, roots[-1:], grower.nodes)
            total += one.value[_walk(one, x)]
    return _flat(base, depth, roots, grower.nodes if grower else [])


def _walk(forest: Forest, x: np.ndarray) -> np.ndarray:
    node = np.full(len(x), forest.roots[0])
    for _ in range(forest.depth):
        node = np.where(x[np.arange(len(x)), forest.feature[node]] < forest.cut[node], forest.low[node], forest.high[node])
    return node


def _flat(base: float, depth: int, roots: list[int], nodes: list[list[float]]) -> Forest:
    table = np.array(nodes, float).reshape(-1, 5)
    ints = table[:, [0, 2, 3]].astype(np.int64)
    return Forest(base, depth, np.array(roots, np.int64), ints[:, 0], table[:, 1], ints[:, 1], ints[:, 2], table[:, 4])


def train(docs: DataFrame, labels: DataFrame, limit: int = LABEL_SAMPLE) -> Forest:
    stats, y = sample(docs, labels, limit)
    return fit(np.column_stack([stats[name] for name in FEATURES]), y)


def judge(texts: pa.Array, forest: Forest) -> dict[str, np.ndarray]:
    """Base counts, verdict of the base rules, score of the trees and the final verdict of each text."""
    stats = measure(texts)
    failed = (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT * stats["n_words"])
    score = forest.score(np.column_stack([stats[name] for name in FEATURES]))
    return {name: stats[name] for name in COUNTS} | {"base_failed": failed, "kept": ~failed & (score >= KEEP), "score": score}


def verdicts(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, base counts, base_failed, kept and score of every document."""

    def judged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = judge(batch.column("text"), forest)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, found.values())], names=["doc_id", *found])

    counts = ", ".join(f"{name} long" for name in COUNTS)
    return docs.select("doc_id", "text").mapInArrow(judged, f"doc_id long, {counts}, base_failed boolean, kept boolean, score double")


def keep_passing(docs: DataFrame, forest: Forest) -> DataFrame:
    """The documents with a favourable verdict, with all their columns."""

    def passing(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(judge(batch.column("text"), forest)["kept"]))

    return docs.mapInArrow(passing, docs.schema)

"""Quality classifier: an additive model with pairwise interactions.

Shallow trees are boosted in turn over one feature at a time, so that each
feature ends up with one table of contributions per bin; the strongest pairs get a
two-way table in the same manner. A score is the logistic of the sum of looked-up
bins. The model is a few small arrays, fitted in numpy on a bounded sample of
labelled rows (``common.LABEL_SAMPLE``), and travels to the tasks as a closure.

Cases: null and empty texts have zero statistics and get the score of those
bins; without labels of both kinds the score is the share of label 1 (1.0
without any label). Equal texts get equal scores. Only ``doc_id`` and ``text``
are read, so further columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.llm.common import LABEL_SAMPLE, held_out, labelled
from derrick.llm.statistics import COUNTS, FEATURES, SCHEMA, measure, measured

THRESHOLD = 0.7
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
RATE = 0.15
RIDGE = 5.0


@dataclass
class AdditiveModel:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of the feature matrix."""
        total = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, f], "right")]
        for a, b, cut_a, cut_b, table in self.pairs:
            total += table[np.searchsorted(cut_a, x[:, a], "right"), np.searchsorted(cut_b, x[:, b], "right")]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree_1d(gradient: np.ndarray, weight: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Best piecewise-constant step over the bins with at most ``leaves`` pieces, found greedily."""
    g, h = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    cuts = [0, len(gradient)]

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + RIDGE)

    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a > 1:
                m = np.arange(a + 1, b)
                gain = worth(a, m) + worth(m, b) - worth(a, b)
                k = int(np.argmax(gain))
                best = max(best, (float(gain[k]), int(m[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(gradient))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + RIDGE)
    return out


def _tree_2d(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The best quadrant split of a two-way table: one cut on each axis."""
    g = np.pad(gradient.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h = np.pad(weight.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    rows, cols = gradient.shape
    best, where = -1.0, (rows, cols)
    for i in range(1, rows + 1):
        for j in range(1, cols + 1):
            quads = [(0, i, 0, j), (i, rows, 0, j), (0, i, j, cols), (i, rows, j, cols)]
            gain = sum((g[b, d] - g[a, d] - g[b, c] + g[a, c]) ** 2 / (h[b, d] - h[a, d] - h[b, c] + h[a, c] + RIDGE) for a, b, c, d in quads)
            if gain > best:
                best, where = gain, (i, j)
    i, j = where
    out = np.zeros(gradient.shape)
    for rs, cs in ((slice(0, i), slice(0, j)), (slice(i, None), slice(0, j)), (slice(0, i), slice(j, None)), (slice(i, None), slice(j, None))):
        out[rs, cs] = gradient[rs, cs].sum() / (weight[rs, cs].sum() + RIDGE)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> AdditiveModel:
    """Cyclic boosting on the logistic loss: main effects first, then the strongest pairs."""
    share = float(y.mean()) if len(y) else 1.0
    if not len(y) or share in (0.0, 1.0):
        return AdditiveModel(30.0 if share == 1.0 else -30.0, [np.zeros(0)] * x.shape[1], [np.zeros(1)] * x.shape[1])
    model = AdditiveModel(float(np.log(share / (1 - share))))
    model.edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)

    def slopes():
        p = 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for b, t in zip(binned, model.tables, strict=True):
            g, h = slopes()
            step = RATE * _tree_1d(np.bincount(b, g, len(t)), np.bincount(b, h, len(t)))
            t += step
            total += step[b]

    found = []
    cuts = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(cuts)]
    g, h = slopes()
    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            shape = (len(cuts[a]) + 1, len(cuts[b]) + 1)
            cell = coarse[a] * shape[1] + coarse[b]
            gs, hs = np.bincount(cell, g, shape[0] * shape[1]), np.bincount(cell, h, shape[0] * shape[1])
            found.append((float((gs**2 / (hs + RIDGE)).sum()), a, b, shape, cell))
    found.sort(key=lambda x: (-x[0], x[1], x[2]))
    chosen = [(a, b, shape, cell, np.zeros(shape)) for _, a, b, shape, cell in found[:pairs]]
    for _ in range(rounds // 4):
        for _, _, shape, cell, t in chosen:
            g, h = slopes()
            size = shape[0] * shape[1]
            step = RATE * _tree_2d(np.bincount(cell, g, size).reshape(shape), np.bincount(cell, h, size).reshape(shape))
            t += step
            total += step.ravel()[cell]
    model.pairs = [(a, b, cuts[a], cuts[b], t) for a, b, _, _, t in chosen]
    return model


def sample(docs: DataFrame, labels: DataFrame, limit: int = LABEL_SAMPLE) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Statistics and labels of the bounded learning sample, in the order of the ids."""
    chosen = labelled(labels, limit)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    stats = texts.mapInArrow(measured, f"doc_id long, quality int, {SCHEMA}")
    one = stats.groupBy("doc_id", "quality").agg(F.min(F.struct(*COUNTS, *FEATURES)).alias("s"))  # an id with several texts counts once
    rows = one.select("doc_id", "quality", "s.*").toArrow().sort_by("doc_id")
    return {name: rows.column(name).to_numpy() for name in rows.column_names}, rows.column("quality").to_numpy().astype(float)


def train(docs: DataFrame, labels: DataFrame, limit: int = LABEL_SAMPLE) -> AdditiveModel:
    stats, y = sample(docs, labels, limit)
    return fit(np.column_stack([stats[name] for name in FEATURES]), y)


def classify(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = measure(batch.column("text"))
            score = model.score(np.column_stack([stats[name] for name in FEATURES]))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    source = docs.select("doc_id", held_out().alias("held_out"), "text")
    return source.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""

    def accepted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = measure(batch.column("text"))
            yield batch.filter(pa.array(model.score(np.column_stack([stats[name] for name in FEATURES])) >= threshold))

    return docs.mapInArrow(accepted, docs.schema)

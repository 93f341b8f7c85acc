"""Random forests of many candidates, folds and targets, grown together.

Features are cut into bins once. A fit is one candidate on one fold for one target, and all trees of all fits grow in
the same passes. While a node holds more than ``LOCAL_ROWS`` training rows, a level is one pass: tasks walk their
rows down every tree and count them by (tree, node, feature, bin), Spark adds the counts up and picks the best split
of each node with a window over its bins. Rows of smaller nodes then go to tasks by (tree, node), where the subtrees are finished, many nodes at a
time; no group is larger than ``LOCAL_ROWS`` rows and those to be scored. Only the splits of large nodes reach the driver: at most
trees x rows / ``LOCAL_ROWS``.

Bootstrap weights, feature choices and ties follow hashes of row, tree and node, so a forest doesn't depend
on how rows are dealt to tasks. Rows to be scored walk along without weight, so a fit's predictions come out of the same passes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrick.session import cut_lineage, shuffle_width

BINS = 32
LOCAL_ROWS = 1000
TREES_AT_ONCE = 256
ROWS_AT_ONCE = 1024
FINISHED_ROWS = 1 << 15  # rows whose subtrees a task grows at a time
LEAST_GAIN = 1e-9
NODES = "fit int, tree int, node long, feature int, bin int, value double"

_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


@dataclass(frozen=True)
class Fit:
    """Trees of one candidate for one target, trained on the blocks before ``fold`` and scored on that block."""

    candidate: int
    fold: int
    target: int
    trees: int
    depth: int
    least: int
    features: int  # tried at each node
    bootstrap: bool = True
    keep_nodes: bool = False
    step: float | None = None  # of boosted trees (``operators.boosting``)
    rate: float = 1.0  # rows drawn for a boosted tree


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bootstrap_weights(row: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """How often each row stands in the sample of each tree (rows x trees)."""
    h = _mix(_mix(row.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))[:, None] ^ _mix(tree.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(1))[None, :])
    return np.searchsorted(_POISSON, (h >> np.uint64(11)) * 2.0**-53, "right").astype(np.int64)


def chosen_features(tree: np.ndarray, node: np.ndarray, n_features: int, n_chosen: int) -> np.ndarray:
    """Features to try at each node, in an order given by a hash."""
    seed = _mix(_mix(tree.astype(np.uint64) + np.uint64(77)) ^ node.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    h = _mix(seed[:, None] ^ _mix(np.arange(1, n_features + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))[None, :])
    return np.argsort(h, axis=1)[:, :n_chosen]


class Plan:
    """The trees of all fits: number, fit and parameters of each."""

    def __init__(self, fits: list[Fit], n_features: int) -> None:
        self.fits, self.n_features = fits, n_features
        self.fit = np.repeat(np.arange(len(fits)), [f.trees for f in fits])
        self.fold, self.target, self.depth, self.least, self.chosen = (np.array([getattr(f, name) for f in fits])[self.fit] for name in ("fold", "target", "depth", "least", "features"))
        self.kept, self.sampled = (np.array([getattr(f, name) for f in fits])[self.fit] for name in ("keep_nodes", "bootstrap"))
        self.most_chosen = int(self.chosen.max())
        # Trees of a fit are numbered from 0, so that two folds draw by the same hashes.
        self.within = np.concatenate([np.arange(f.trees) for f in fits])

    def __len__(self) -> int:
        return len(self.fit)

    def tried(self, tree: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Features to try at nodes of the trees."""
        return chosen_features(self.within[tree], node, self.n_features, self.most_chosen)

    def weights(self, row: np.ndarray, block: np.ndarray, trees: np.ndarray) -> np.ndarray:
        """Weight of each row in each tree; rows that a tree doesn't train on have none."""
        drawn = np.where(self.sampled[trees], bootstrap_weights(row, self.within[trees]), 1)
        return drawn * (block[:, None] < self.fold[trees][None, :])


@dataclass
class Splits:
    """Splits of large nodes by tree and node, sorted."""

    key: np.ndarray
    feature: np.ndarray
    bin: np.ndarray

    def walk(self, bins: np.ndarray, trees: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row reaches in each tree (rows x trees)."""
        node = np.ones((len(bins), len(trees)), np.int64)
        if not len(self.key):
            return node
        line = np.arange(len(bins))[:, None]
        for _ in range(levels):
            key = _key(trees[None, :], node)
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            right = bins[line, self.feature[at]] > self.bin[at]
            node = np.where(self.key[at] == key, 2 * node + right, node)
        return node


def _key(tree: np.ndarray, node: np.ndarray) -> np.ndarray:
    return (np.asarray(tree, np.int64) << 32) | node


def bin_cuts(train: DataFrame, features: list[str]) -> list[list[float]]:
    """Cut points of every feature: approximate quantiles of the training rows, one pass."""
    shares = [i / BINS for i in range(1, BINS)]
    row = train.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10_000).alias(str(i)) for i, c in enumerate(features)]).first()
    return [sorted(set(row[str(i)] or [])) for i in range(len(features))]


def with_bins(df: DataFrame, features: list[str], cuts: list[list[float]]) -> DataFrame:
    """``bins``: a byte per feature, the number of cut points below the value."""

    def one(c: str, points: list[float]):
        below = F.size(F.filter(F.array(*[F.lit(float(p)) for p in points]).cast("array<double>"), lambda p: p < F.col(c).cast("double")))
        return F.lpad(F.hex(below), 2, "0")

    return df.withColumn("bins", F.unhex(F.concat(*[one(c, p) for c, p in zip(features, cuts, strict=True)])))


def bytes_of(column: pa.Array, width: int) -> np.ndarray:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].reshape(-1, width)


def _as_binary(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def row_blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """row, bins, targets and block of some rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            some = batch.slice(at, ROWS_AT_ONCE)
            y = np.array(some.column("y").to_pylist(), np.float64)
            yield some.column("row").to_numpy(), bytes_of(some.column("bins"), width), y, some.column("block").to_numpy()


def _histograms(rows: DataFrame, plan: Plan, splits: Splits, frontier: np.ndarray, level: int) -> DataFrame:
    """Weights and weighted targets of the nodes of ``frontier`` (sorted keys) by feature and bin."""
    tree, node = frontier >> 32, frontier & 0xFFFFFFFF
    tried = plan.tried(tree, node)
    busy = np.unique(tree)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, bins, y, block in row_blocks(batches, plan.n_features):
            for at in range(0, len(busy), TREES_AT_ONCE):
                trees = busy[at : at + TREES_AT_ONCE]
                weight = plan.weights(row, block, trees)
                key = _key(trees[None, :], splits.walk(bins, trees, level))
                place = np.minimum(np.searchsorted(frontier, key), len(frontier) - 1)
                line, column = np.nonzero((weight > 0) & (frontier[place] == key))
                place, w = place[line, column], weight[line, column].astype(np.float64)
                wy = w * y[line, plan.target[trees[column]]]
                for j in range(plan.most_chosen):
                    used = plan.chosen[tree[place]] > j
                    if not used.any():
                        continue
                    p, feature = place[used], tried[place[used], j]
                    code, inverse = np.unique(p * BINS + bins[line[used], feature], return_inverse=True)
                    own = code // BINS
                    columns = [tree[own].astype(np.int32), node[own], tried[own, j].astype(np.int32), (code % BINS).astype(np.int32), plan.least[tree[own]].astype(np.int32)]
                    sums = [np.bincount(inverse, v[used]) for v in (w, wy)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns, *sums)], names=["tree", "node", "feature", "bin", "least", "w", "wy"])

    counted = rows.select("row", "bins", "y", "block").mapInArrow(count, "tree int, node long, feature int, bin int, least int, w double, wy double")
    return counted.groupBy("tree", "node", "feature", "bin").agg(F.sum("w").alias("w"), F.sum("wy").alias("wy"), F.max("least").alias("least"))


def _best_splits(histograms: DataFrame) -> DataFrame:
    """The split of each node that lowers the squared error most; of equals the first feature and bin."""
    bins = Window.partitionBy("tree", "node", "feature")
    below = bins.orderBy("bin")
    sides = histograms.select(
        "tree", "node", "feature", "bin", "least",
        F.sum("w").over(below).alias("wl"), F.sum("wy").over(below).alias("sl"), F.sum("w").over(bins).alias("w"), F.sum("wy").over(bins).alias("s"),
    ).withColumns({"wr": F.col("w") - F.col("wl"), "sr": F.col("s") - F.col("sl")})
    allowed = sides.filter((F.col("wl") >= F.col("least")) & (F.col("wr") >= F.col("least")))
    gain = F.expr("sl * sl / wl + sr * sr / wr - s * s / w")
    scored = allowed.withColumn("gain", gain).filter(F.col("gain") > LEAST_GAIN)
    best = F.max_by(F.struct("feature", "bin", "wl", "wr"), F.struct(F.round("gain", 9), -F.col("feature"), -F.col("bin")))
    return scored.groupBy("tree", "node").agg(best.alias("best")).select("tree", "node", "best.*")


def large_nodes(rows: DataFrame, plan: Plan, more_than: float) -> Splits:
    """Split all nodes of more than so many rows, a level at a time."""
    sizes = {r.block: r["count"] for r in rows.groupBy("block").count().collect()}
    n_train = np.array([sum(n for block, n in sizes.items() if block < f.fold) for f in plan.fits], np.int64)[plan.fit]
    splits = Splits(*[np.zeros(0, np.int64)] * 3)
    frontier = _key(np.flatnonzero((n_train > more_than) & (plan.depth > 0)), np.int64(1))
    level = 0
    while len(frontier):
        found = _best_splits(_histograms(rows, plan, splits, frontier, level)).toPandas()
        level += 1
        tree, node = found.tree.to_numpy(np.int64), found.node.to_numpy(np.int64)
        key = np.concatenate([splits.key, _key(tree, node)])
        order = np.argsort(key)
        splits = Splits(key[order], *[np.concatenate([old, found[c].to_numpy(np.int64)])[order] for old, c in ((splits.feature, "feature"), (splits.bin, "bin"))])
        deeper = plan.depth[tree] > level
        frontier = np.sort(np.concatenate([_key(tree, 2 * node + side)[deeper & (found[w].to_numpy() > more_than)] for side, w in ((0, "wl"), (1, "wr"))]))
    return splits


def _pairs(rows: DataFrame, plan: Plan, splits: Splits) -> DataFrame:
    """Every row in every tree that trains on it or scores it, at the node where its subtree begins."""
    levels = int(np.log2((splits.key & 0xFFFFFFFF).max(initial=1))) + 1 if len(splits.key) else 0

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, bins, y, block in row_blocks(batches, plan.n_features):
            for at in range(0, len(plan), TREES_AT_ONCE):
                trees = np.arange(at, min(at + TREES_AT_ONCE, len(plan)))
                fold = plan.fold[trees][None, :]
                weight = plan.weights(row, block, trees)
                node = splits.walk(bins, trees, levels)
                line, column = np.nonzero((weight > 0) | (block[:, None] == fold))
                tree = trees[column]
                columns = [pa.array(c) for c in (tree.astype(np.int32), node[line, column], row[line], weight[line, column].astype(np.int32), y[line, plan.target[tree]])]
                yield pa.RecordBatch.from_arrays([*columns, _as_binary(bins[line])], names=["tree", "node", "row", "w", "y", "bins"])

    return rows.select("row", "bins", "y", "block").mapInArrow(deal, "tree int, node long, row long, w int, y double, bins binary")


def grow_subtrees(tree: np.ndarray, node: np.ndarray, w: np.ndarray, y: np.ndarray, bins: np.ndarray, plan: Plan) -> tuple[np.ndarray, pd.DataFrame]:
    """Finish the subtrees below all (tree, node) that occur, level by level over all of them.

    Returns each row's prediction and the nodes made: inner ones have a feature, leaves -1."""
    start, at = np.unique(_key(tree, node), return_inverse=True)
    of, heap = start >> 32, start & 0xFFFFFFFF
    value = np.full(len(tree), np.nan)
    rows = np.arange(len(tree))
    made = []
    above = np.zeros(len(start))  # a node that no sampled row reaches predicts what its parent does
    k, n_bins = plan.most_chosen, BINS
    while len(of):
        train = rows[w[rows] > 0]
        place = at[w[rows] > 0]
        weight, wy = w[train].astype(np.float64), (w[train] * y[train])
        total = np.bincount(place, weight, len(of))
        sums = np.bincount(place, wy, len(of))
        mean = np.where(total > 0, sums / np.maximum(total, 1), above)
        tried = plan.tried(of, heap)
        depth = np.floor(np.log2(heap)).astype(np.int64)
        able = (total >= 2 * plan.least[of]) & (depth < plan.depth[of])
        use = able[place]
        cell = (place[use, None] * k + np.arange(k)) * n_bins + bins[train[use, None], tried[place[use]]]
        shape = (len(of), k, n_bins)
        wl = np.cumsum(np.bincount(cell.ravel(), np.repeat(weight[use], k), len(of) * k * n_bins).reshape(shape), axis=2)
        sl = np.cumsum(np.bincount(cell.ravel(), np.repeat(wy[use], k), len(of) * k * n_bins).reshape(shape), axis=2)
        wr, sr = total[:, None, None] - wl, sums[:, None, None] - sl
        least = plan.least[of][:, None, None]
        fine = (wl >= least) & (wr >= least) & able[:, None, None] & (np.arange(k)[None, :, None] < plan.chosen[of][:, None, None])
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fine, sl * sl / wl + sr * sr / wr - (sums * sums / np.maximum(total, 1))[:, None, None], -np.inf)
        # Of equal gains the first feature, then the first bin.
        gain = np.round(gain, 9)
        top = gain.reshape(len(of), -1).max(axis=1)
        split = top > LEAST_GAIN
        rank = np.where(gain == top[:, None, None], tried[:, :, None] * n_bins + np.arange(n_bins), plan.n_features * n_bins)
        best = rank.reshape(len(of), -1).min(axis=1)
        feature, cut = np.where(split, best // n_bins, -1), np.where(split, best % n_bins, -1)
        made.append((of, heap, feature, cut, mean))
        ends = ~split[at]
        value[rows[ends]] = mean[at[ends]]
        rows, at = rows[~ends], at[~ends]
        right = bins[rows, feature[at]] > cut[at]
        number = np.cumsum(split) - 1
        at = 2 * number[at] + right
        of, above = np.repeat(of[split], 2), np.repeat(mean[split], 2)
        heap = np.repeat(2 * heap[split], 2) + np.tile([0, 1], int(split.sum()))
    names = ("tree", "node", "feature", "bin", "value")
    return value, pd.DataFrame({name: np.concatenate(parts) for name, parts in zip(names, zip(*made))})


def grow(rows: DataFrame, fits: list[Fit], n_features: int) -> tuple[DataFrame, DataFrame]:
    """Predictions (fit, row, prediction) of the scored rows of every fit, and the nodes of the fits that keep them.

    ``rows`` has ``row`` (a unique number), ``bins``, ``y`` (an array of targets) and ``block``; it should be a written table."""
    plan = Plan(fits, n_features)
    width = shuffle_width(rows.sparkSession)
    rows = rows.repartition(width, "row")
    splits = large_nodes(rows, plan, LOCAL_ROWS)

    def emit(value: np.ndarray, tree: np.ndarray, row: np.ndarray, w: np.ndarray, nodes: pd.DataFrame) -> pa.RecordBatch:
        scored = w == 0
        fit, row, value = plan.fit[tree[scored]], row[scored], value[scored]
        order = np.lexsort((row, fit))
        fit, row, value = fit[order], row[order], value[order]
        first = np.flatnonzero(np.r_[True, (fit[1:] != fit[:-1]) | (row[1:] != row[:-1])]) if len(fit) else np.zeros(0, np.int64)
        sums = np.add.reduceat(value, first) if len(fit) else np.zeros(0)
        kept = nodes[plan.kept[nodes.tree.to_numpy()]] if len(nodes) else pd.DataFrame(columns=["tree", "node", "feature", "bin", "value"])
        n = len(first)
        columns = [
            pa.array(np.r_[fit[first], plan.fit[kept.tree.to_numpy(np.int64)]].astype(np.int32)),
            pa.array(np.r_[np.full(n, -1), plan.within[kept.tree.to_numpy(np.int64)]].astype(np.int32)),
            pa.array(np.r_[row[first], kept.node.to_numpy(np.int64)].astype(np.int64)),
            *[pa.array(np.r_[np.full(n, -1), kept[c].to_numpy(np.int64)].astype(np.int32)) for c in ("feature", "bin")],
            pa.array(np.r_[sums, kept.value.to_numpy(np.float64)]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["fit", "tree", "node", "feature", "bin", "value"])

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tree and node; whole groups are grown, some at a time."""
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            tree, node, row, w, y = (table.column(c).to_numpy() for c in ("tree", "node", "row", "w", "y"))
            bins = bytes_of(table.column("bins").combine_chunks(), plan.n_features)
            value, nodes = grow_subtrees(tree, node, w, y, bins, plan)
            return emit(value, tree, row, w, nodes)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= FINISHED_ROWS:
                table = pa.Table.from_batches(held).combine_chunks()
                key = _key(table.column("tree").to_numpy(), table.column("node").to_numpy())
                whole = int(np.searchsorted(key, key[-1]))  # the last group may go on
                if whole:
                    yield done(table.slice(0, whole))
                held = table.slice(whole).to_batches()
        if held:
            yield done(pa.Table.from_batches(held).combine_chunks())

    dealt = _pairs(rows, plan, splits).repartition(width, "tree", "node").sortWithinPartitions("tree", "node", "row")
    grown = cut_lineage(dealt.mapInArrow(finish, NODES))
    n_trees = F.element_at(F.array(*[F.lit(f.trees) for f in fits]), F.col("fit") + 1)
    found = grown.filter("tree = -1").groupBy("fit", F.col("node").alias("row")).agg(F.sum("value").alias("total"))
    predictions = found.select("fit", "row", (F.col("total") / n_trees).alias("prediction"))
    large = splits.key >> 32
    top = [(int(plan.fit[t]), int(plan.within[t]), int(key & 0xFFFFFFFF), int(f), int(b), 0.0) for t, key, f, b in zip(large, splits.key, splits.feature, splits.bin, strict=True) if plan.kept[t]]
    return predictions, grown.filter("tree >= 0").unionByName(rows.sparkSession.createDataFrame(top, NODES))

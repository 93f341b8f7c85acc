"""Boosted trees of many candidates, folds and targets, on the bins and passes of the shared forest trainer.

Each round fits one tree per fit to what the trees before left over of the target (squared error: the gradient is the
residual, the curvature the weight), on rows drawn by a hash of row and round, with a bag of columns drawn
once for the tree. A fit of at most ``LOCAL_ROWS`` rows is grown in one task, all its rounds in a
row, and the fits of a search spread over tasks. With more rows every round goes through the passes over histograms, for all fits
at once; rows carry their residuals along in a written table. Both ways take the same splits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.operators.forest import NODES, Fit, Plan, Splits, bytes_of, chosen_features, grow_subtrees, large_nodes, row_blocks
from derrick.operators.forest import _key, _mix
from derrick.session import cut_lineage, shuffle_width

LOCAL_ROWS = 10_000


def drawn_rows(row: np.ndarray, number: int, rate: np.ndarray) -> np.ndarray:
    """Whether each row is drawn for the trees of a round (rows x trees)."""
    seed = _mix(np.array([number * 2 + 1], np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    h = _mix(_mix(row.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) ^ seed)
    return ((h >> np.uint64(11)) * 2.0**-53)[:, None] < rate[None, :]


class Round(Plan):
    """One tree of every fit: the tree of round ``number``."""

    def __init__(self, fits: list[Fit], n_features: int, number: int, own_targets: bool = False) -> None:
        single = [Fit(f.candidate, f.fold, i if own_targets else f.target, 1, f.depth if number < f.trees else 0, f.least, f.features, keep_nodes=f.keep_nodes) for i, f in enumerate(fits)]
        super().__init__(single, n_features)
        self.rate = np.array([f.rate for f in fits])
        self.number = number
        self.within = np.full(len(fits), number)

    def tried(self, tree: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The bag of columns of the tree, whatever the node."""
        return chosen_features(self.within[tree], np.zeros_like(node), self.n_features, self.most_chosen)

    def weights(self, row: np.ndarray, block: np.ndarray, trees: np.ndarray) -> np.ndarray:
        return (drawn_rows(row, self.number, self.rate[trees]) & (block[:, None] < self.fold[trees][None, :])).astype(np.int64)


def _grow_in_tasks(rows: DataFrame, fits: list[Fit], bases: list[float], n_features: int) -> DataFrame:
    """Scores (tree -1) and nodes of every fit, a fit being one group."""

    def whole(table: pa.Table) -> pa.Table:
        number = table.column("fit")[0].as_py()
        fit = fits[number]
        order = np.argsort(table.column("row").to_numpy(), kind="stable")
        row, block, y = (table.column(c).to_numpy()[order] for c in ("row", "block", "y"))
        bins = bytes_of(table.column("bins").combine_chunks(), n_features)[order]
        margin = np.full(len(row), bases[number])
        zeros, ones, made = np.zeros(len(row), np.int64), np.ones(len(row), np.int64), []
        for k in range(fit.trees):
            plan = Round([fit], n_features, k)
            w = plan.weights(row, block, zeros[:1])[:, 0]
            value, nodes = grow_subtrees(zeros, ones, w, y - margin, bins, plan)
            margin += fit.step * value
            if fit.keep_nodes:
                made.append(nodes.assign(tree=k, value=nodes.value * fit.step))
        scored = block == fit.fold
        out = pd.DataFrame({"tree": -1, "node": row[scored], "feature": -1, "bin": -1, "value": margin[scored]})
        out = pd.concat([out, *made]).assign(fit=number)[["fit", "tree", "node", "feature", "bin", "value"]]
        kinds = [("fit", pa.int32()), ("tree", pa.int32()), ("node", pa.int64()), ("feature", pa.int32()), ("bin", pa.int32()), ("value", pa.float64())]
        return pa.Table.from_pandas(out, pa.schema(kinds), preserve_index=False)

    folds = F.array(*[F.struct(F.lit(i).alias("fit"), F.lit(f.fold).alias("fold"), F.lit(f.target).alias("target")) for i, f in enumerate(fits)])
    each = rows.select("row", "bins", "y", "block", F.explode(folds).alias("f")).filter(F.col("block") <= F.col("f.fold"))
    dealt = each.select("f.fit", "row", "bins", F.get("y", F.col("f.target")).alias("y"), "block")
    # Groups are small and dear: the width is given, so that they aren't put together into few tasks.
    return cut_lineage(dealt.repartition(max(shuffle_width(rows.sparkSession), len(fits)), "fit").groupBy("fit").applyInArrow(whole, NODES))


def _leaf_sums(rows: DataFrame, plan: Round, splits: Splits, levels: int) -> pd.DataFrame:
    """Weight and weighted residual of every leaf of a round: at most 2^depth a fit."""

    def add(batches):
        trees = np.arange(len(plan))
        for row, bins, y, block in row_blocks(batches, plan.n_features):
            node, w = splits.walk(bins, trees, levels), plan.weights(row, block, trees)
            line, column = np.nonzero(w)
            code, inverse = np.unique(_key(trees[column], node[line, column]), return_inverse=True)
            if len(code):
                sums = [np.bincount(inverse, v).astype(np.float64) for v in (w[line, column], y[line, plan.target[column]])]
                yield pa.RecordBatch.from_arrays([pa.array(code), *map(pa.array, sums)], names=["key", "w", "wy"])

    summed = rows.select("row", "bins", "y", "block").mapInArrow(add, "key long, w double, wy double")
    return summed.groupBy("key").agg(F.sum("w").alias("w"), F.sum("wy").alias("wy")).orderBy("key").toPandas()


def _grow_by_passes(rows: DataFrame, fits: list[Fit], bases: list[float], n_features: int) -> tuple[DataFrame, DataFrame]:
    """Scores and nodes by rounds over all rows: a row's ``y`` holds its residual for each fit."""
    spark = rows.sparkSession
    left = F.array(*[F.get("y", F.lit(f.target)) - F.lit(float(b)) for f, b in zip(fits, bases, strict=True)])
    state = cut_lineage(rows.select("row", "bins", "block", "y", left.alias("left")))
    nodes = []
    for k in range(max(f.trees for f in fits)):
        plan = Round(fits, n_features, k, own_targets=True)
        current = state.select("row", "bins", F.col("left").alias("y"), "block")
        splits = large_nodes(current, plan, 0)
        levels = int(plan.depth.max())
        leaves = _leaf_sums(current, plan, splits, levels)
        key = leaves.key.to_numpy(np.int64)
        step = np.array([f.step if k < f.trees else 0.0 for f in fits])
        value = leaves.wy.to_numpy() / leaves.w.to_numpy() * step[key >> 32]
        for of, at, f, b, v in [*zip(splits.key >> 32, splits.key & 0xFFFFFFFF, splits.feature, splits.bin, np.zeros(len(splits.key))), *zip(key >> 32, key & 0xFFFFFFFF, key * 0 - 1, key * 0 - 1, value)]:
            if fits[of].keep_nodes and k < fits[of].trees:
                nodes.append((int(of), k, int(at), int(f), int(b), float(v)))

        def lower(batches, splits=splits, levels=levels, key=key, value=value):
            trees = np.arange(len(fits))
            for row, bins, y, _ in row_blocks(batches, n_features):
                found = _key(trees[None, :], splits.walk(bins, trees, levels))
                at = np.minimum(np.searchsorted(key, found), len(key) - 1)
                y = y - np.where(key[at] == found, value[at], 0.0)
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(list(y), pa.list_(pa.float64()))], names=["row", "lowered"])

        lowered = current.mapInArrow(lower, "row long, lowered array<double>")
        state = cut_lineage(state.drop("left").join(lowered.withColumnRenamed("lowered", "left"), "row"))
    scores = []
    for i, f in enumerate(fits):
        scores.append(F.struct(F.lit(i).alias("fit"), F.lit(f.fold).alias("fold"), (F.get("y", F.lit(f.target)) - F.get("left", F.lit(i))).alias("prediction")))
    found = state.select("row", "block", F.explode(F.array(*scores)).alias("s")).filter(F.col("block") == F.col("s.fold"))
    return found.select("s.fit", "row", "s.prediction"), spark.createDataFrame(nodes, NODES)


def grow(rows: DataFrame, fits: list[Fit], n_features: int) -> tuple[DataFrame, DataFrame, list[float]]:
    """Predictions (fit, row, prediction) of the scored rows of every fit, the nodes of the fits that keep them (their
    values times the step), and what each fit starts from: the mean of its training rows."""
    targets = sorted({f.target for f in fits})
    per_block = rows.groupBy("block").agg(F.count("*").alias("n"), *[F.sum(F.get("y", F.lit(t))).alias(f"y{t}") for t in targets]).collect()
    counts = [sum(r["n"] for r in per_block if r["block"] < f.fold) for f in fits]
    bases = [sum(r[f"y{f.target}"] for r in per_block if r["block"] < f.fold) / max(n, 1) for f, n in zip(fits, counts, strict=True)]
    if sum(r["n"] for r in per_block) > LOCAL_ROWS:
        found, nodes = _grow_by_passes(rows, fits, bases, n_features)
    else:
        grown = _grow_in_tasks(rows, fits, bases, n_features)
        found = grown.filter("tree = -1").select("fit", F.col("node").alias("row"), F.col("value").alias("prediction"))
        nodes = grown.filter("tree >= 0")
    return found, nodes, bases

"""The shared forest trainer against a plain recursion over the same samples, features and bins."""

import numpy as np
import pytest

from derrick.operators import boosting, forest, forest_stage
from derrick.session import cut_lineage

N, WIDE = 240, 5


def data():
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(N, WIDE)), 2)
    return x, np.column_stack([2 * x[:, 0] + (x[:, 1] > 0) + 0.1 * rng.normal(size=N), x[:, 2] * x[:, 3]])


def table(spark, x, y, parts=3):
    rows = [(i, *map(float, x[i]), list(map(float, y[i])), i // 60 - 1) for i in range(N)]
    names = [f"x{k}" for k in range(WIDE)]
    df = spark.createDataFrame(rows, f"row long, {', '.join(n + ' double' for n in names)}, y array<double>, block int").repartition(parts)
    cuts = forest.bin_cuts(df.filter("block < 2"), names)
    return cut_lineage(forest.with_bins(df, names, cuts).select("row", "bins", "y", "block")), cuts


def brute_tree(bins, y, weight, fit, tree):
    """Nodes of one tree by recursion: node -> (feature, bin, mean)."""
    out = {}

    def grow(node, rows):
        w, wy = weight[rows].astype(float), weight[rows] * y[rows]
        mean = wy.sum() / w.sum()
        best = (forest.LEAST_GAIN, None)
        if w.sum() >= 2 * fit.least and node.bit_length() - 1 < fit.depth:
            for f in sorted(forest.chosen_features(np.array([tree]), np.array([node]), WIDE, fit.features)[0].tolist()):
                for b in range(forest.BINS):
                    left = bins[rows, f] <= b
                    wl, wr = w[left].sum(), w[~left].sum()
                    if min(wl, wr) >= fit.least:
                        gain = round(wy[left].sum() ** 2 / wl + wy[~left].sum() ** 2 / wr - wy.sum() ** 2 / w.sum(), 9)
                        if gain > best[0]:
                            best = (gain, (f, b))
        out[node] = (*(best[1] or (-1, -1)), mean)
        if best[1]:
            left = bins[rows, best[1][0]] <= best[1][1]
            grow(2 * node, rows[left])
            grow(2 * node + 1, rows[~left])

    grow(1, np.flatnonzero(weight))
    return out


FITS = [
    forest.Fit(0, 2, 0, 4, 30, 1, 2, keep_nodes=True),
    forest.Fit(1, 1, 1, 3, 4, 3, 5, keep_nodes=True),
    forest.Fit(2, 2, 1, 1, 2, 5, 5, bootstrap=False, keep_nodes=True),
]


@pytest.mark.parametrize("local", [10**6, 25])
def test_equals_plain_recursion(spark, monkeypatch, local):
    """Grown in tasks at once, and by passes over histograms down to 25 rows a node."""
    monkeypatch.setattr(forest, "LOCAL_ROWS", local)
    x, y = data()
    rows, cuts = table(spark, x, y)
    predictions, nodes = forest.grow(rows, FITS, WIDE)
    bins = np.array([[sum(c < v for c in cuts[k]) for k, v in enumerate(line)] for line in x], np.uint8)
    block = np.arange(N) // 60 - 1
    found = nodes.toPandas()
    got = predictions.toPandas()
    for number, fit in enumerate(FITS):
        want = np.zeros(N)
        for tree in range(fit.trees):
            drawn = forest.bootstrap_weights(np.arange(N), np.array([tree]))[:, 0] if fit.bootstrap else np.ones(N, np.int64)
            made = brute_tree(bins, y[:, fit.target], drawn * (block < fit.fold), fit, tree)
            mine = found[(found.fit == number) & (found.tree == tree)]
            assert {n: (f, b) for n, f, b in zip(mine.node, mine.feature, mine.bin)} == {n: v[:2] for n, v in made.items()}
            assert all(v == pytest.approx(made[n][2]) for n, v, f in zip(mine.node, mine.value, mine.feature) if f < 0)
            for i in range(N):
                node = 1
                while made[node][0] >= 0:
                    node = 2 * node + (bins[i, made[node][0]] > made[node][1])
                want[i] += made[node][2] / fit.trees
        mine = got[got.fit == number].sort_values("row")
        assert mine.row.tolist() == np.flatnonzero(block == fit.fold).tolist()
        assert np.allclose(mine.prediction, want[mine.row])
        flat = forest_stage.flat(found[found.fit == number])
        assert np.allclose(forest_stage.predict(flat, bins), want)


def test_a_forest_does_not_depend_on_the_partitions(spark, monkeypatch):
    x, y = data()
    results = []
    for parts, at_once in ((1, 1 << 15), (7, 100)):
        monkeypatch.setattr(forest, "FINISHED_ROWS", at_once)
        predictions, _ = forest.grow(table(spark, x, y, parts)[0], FITS[:2], WIDE)
        results.append({(r.fit, r.row): round(r.prediction, 9) for r in predictions.collect()})
    assert results[0] == results[1] and len(results[0]) == 120


BOOSTED = [
    forest.Fit(0, 2, 0, 3, 3, 1, 4, keep_nodes=True, step=0.3, rate=0.8),
    forest.Fit(1, 1, 1, 2, 2, 3, 5, keep_nodes=True, step=0.1),
]


def brute_boost(bins, y, block, fit):
    """Rounds of plain recursive trees on the residuals."""
    margin = np.full(N, y[block < fit.fold, fit.target].mean())
    for number in range(fit.trees):
        drawn = boosting.drawn_rows(np.arange(N), number, np.array([fit.rate]))[:, 0] & (block < fit.fold)
        bag = forest.chosen_features(np.array([number]), np.array([0]), WIDE, fit.features)[0]

        def grow(rows, depth, left=y[:, fit.target] - margin, drawn=drawn, bag=bag):
            used = rows[drawn[rows]]
            best = (forest.LEAST_GAIN, None)
            for f in sorted(bag.tolist()) if depth < fit.depth else ():
                for b in range(forest.BINS):
                    low, high = left[used[bins[used, f] <= b]], left[used[bins[used, f] > b]]
                    if min(len(low), len(high)) >= fit.least:
                        gain = round(low.sum() ** 2 / len(low) + high.sum() ** 2 / len(high) - left[used].sum() ** 2 / len(used), 9)
                        if gain > best[0]:
                            best = (gain, (f, b))
            if not best[1]:
                margin[rows] += fit.step * left[used].mean()
                return
            f, b = best[1]
            grow(rows[bins[rows, f] <= b], depth + 1)
            grow(rows[bins[rows, f] > b], depth + 1)

        grow(np.arange(N), 0)
    return margin


@pytest.mark.parametrize("local", [10**6, 10])
def test_boosting_equals_plain_rounds(spark, monkeypatch, local):
    """Fits in tasks of their own, and rounds by passes over all rows."""
    monkeypatch.setattr(boosting, "LOCAL_ROWS", local)
    x, y = data()
    rows, cuts = table(spark, x, y)
    predictions, nodes, bases = boosting.grow(rows, BOOSTED, WIDE)
    bins = np.array([[sum(c < v for c in cuts[k]) for k, v in enumerate(line)] for line in x], np.uint8)
    block = np.arange(N) // 60 - 1
    found, got = nodes.toPandas(), predictions.toPandas()
    for number, fit in enumerate(BOOSTED):
        want = brute_boost(bins, y, block, fit)
        mine = got[got.fit == number].sort_values("row")
        assert mine.row.tolist() == np.flatnonzero(block == fit.fold).tolist()
        assert np.allclose(mine.prediction, want[mine.row])
        flat = forest_stage.flat(found[found.fit == number])
        assert len(flat["roots"]) == fit.trees
        assert np.allclose(bases[number] + fit.trees * forest_stage.predict(flat, bins), want)

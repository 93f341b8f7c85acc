"""Nearest-neighbour imputation against a plain comparison of all rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from derrick import session
from derrick.functions.nearest import CellIndex, CellTree, block_nearest
from derrick.operators import impute
from derrick.operators.impute import knn_impute, knn_pairs

COLS = ["a", "b", "c", "d"]


def sample(rows: int, seed: int, copies: int = 0, step: float = 0.0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(rows, len(COLS))) * [100, 30, 5, 1]
    if step:
        values = np.round(values / step) * step
    values[rng.random(values.shape) < 0.15] = np.nan
    if copies:
        values[:copies] = values[0]
    return [(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(values)]


def brute_pairs(rows: list[tuple], k: int, donors=lambda key: True) -> dict:
    """{(key, column): [(dist, donor, value)..]} by comparing every pair."""
    found = {}
    for key, *mine in rows:
        for j, name in enumerate(COLS):
            if mine[j] is not None or all(v is None for v in mine):
                continue
            near = []
            for other, *theirs in rows:
                both = [(x, y) for x, y in zip(mine, theirs) if x is not None and y is not None]
                if theirs[j] is None or not both or not donors(other):
                    continue
                total = sum((x - y) ** 2 for x, y in both)
                near.append((round((len(COLS) / len(both) * total) ** 0.5, 9), other, theirs[j]))
            found[key, name] = sorted(near)[:k]
    return found


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in COLS))


@pytest.fixture
def small_cells(monkeypatch):
    """Limits small enough that a few hundred rows use cells, chunks and pruning."""
    for name, value in {"CELL_ROWS": 8, "CHUNK_ROWS": 16, "BLOCK_ROWS": 32, "LANDMARKS": 40}.items():
        monkeypatch.setattr(impute, name, value)


def check_pairs(spark, rows, k):
    got = {}
    for r in knn_pairs(frame(spark, rows), COLS, k, ["id"]).collect():
        got.setdefault((r["id"], r["column"]), []).append((r["rank"], r["dist"], r["donor_id"], r["value"]))
    got = {key: [tuple(x[1:]) for x in sorted(found)] for key, found in got.items()}
    want = {key: found for key, found in brute_pairs(rows, k).items() if found}
    assert got.keys() == want.keys()
    for key in want:
        assert [d[1:] for d in got[key]] == [d[1:] for d in want[key]], key
        assert np.allclose([d[0] for d in got[key]], [d[0] for d in want[key]], atol=1e-8)


def test_pairs_equal_brute_force(spark, small_cells):
    check_pairs(spark, sample(300, 1), 5)


def test_pairs_with_ties_go_to_the_smaller_key(spark, small_cells):
    check_pairs(spark, sample(200, 2, step=20.0), 3)


def test_pairs_when_a_third_of_the_rows_are_copies(spark, small_cells):
    check_pairs(spark, sample(240, 3, copies=80), 5)


def test_pairs_with_rare_patterns_in_the_open_cell(spark, small_cells, monkeypatch):
    monkeypatch.setattr(impute, "MAX_PATTERNS", 1)
    check_pairs(spark, sample(150, 4), 4)


def test_pairs_with_default_limits(spark):
    check_pairs(spark, sample(120, 5), 5)


def test_impute_is_the_mean_of_the_nearest(spark, small_cells):
    rows = sample(200, 6)
    rows.append((900, None, None, None, None))
    got = {r["id"]: r for r in knn_impute(frame(spark, rows), COLS, ["id"]).collect()}
    assert len(got) == len(rows)
    near = brute_pairs(rows, 5)
    means = {c: np.mean([r[i + 1] for r in rows if r[i + 1] is not None]) for i, c in enumerate(COLS)}
    for key, *values in rows:
        for c, v in zip(COLS, values):
            if v is not None:
                assert got[key][c] == v
            elif near.get((key, c)):
                assert got[key][c] == pytest.approx(np.mean([d[2] for d in near[key, c]]))
            else:
                assert got[key][c] == pytest.approx(means[c], abs=1e-5)


def test_empty_column_stays_empty_and_fewer_donors_than_k(spark):
    rows = [(1, 1.0, None, None, 2.0), (2, 2.0, 5.0, None, 2.0), (3, 9.0, 7.0, None, None)]
    got = {r["id"]: r for r in knn_impute(frame(spark, rows), COLS, ["id"]).collect()}
    assert [got[i]["c"] for i in (1, 2, 3)] == [None, None, None]
    assert got[1]["b"] == 6.0
    assert got[3]["d"] == 2.0


def test_complete_frame_is_returned_as_it_is(spark):
    rows = [(1, 1.0, 2.0, 3.0, 4.0), (2, 2.0, 5.0, 1.0, 2.0)]
    assert knn_impute(frame(spark, rows), COLS, ["id"]).orderBy("id").collect() == frame(spark, rows).orderBy("id").collect()
    assert knn_pairs(frame(spark, rows), COLS, 5, ["id"]).count() == 0


def test_donors_can_be_restricted(spark, small_cells):
    rows = sample(150, 7)
    got = {r["id"]: r for r in knn_impute(frame(spark, rows), COLS, ["id"], donors=F.col("id") < 100).collect()}
    near = brute_pairs(rows, 5, donors=lambda key: key < 100)
    for (key, c), found in near.items():
        assert got[key][c] == pytest.approx(np.mean([d[2] for d in found]))


def test_same_points_get_the_same_value_and_no_pair_is_a_cross_join(spark):
    filled = knn_impute(frame(spark, sample(100, 8, copies=30)), COLS, ["id"])
    plan = filled._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    first = [tuple(r[c] for c in COLS) for r in filled.filter("id < 30").collect()]
    assert len(set(first)) == 1


def test_a_rarely_filled_column_has_its_own_landmarks(spark, monkeypatch):
    monkeypatch.setattr(impute, "LANDMARKS", 64)
    rows = [(i, float(i % 71), float(i * 37 % 101), float(i % 13) if i % 200 == 0 else None) for i in range(3000)]
    donors = spark.createDataFrame(rows, "_k_id int, a double, b double, c double")
    found = impute._landmarks(donors, ["a", "b", "c"], ["_k_id"], 3)
    assert (~np.isnan(found[:, 2])).sum() == 15 and 64 <= len(found) <= 64 + 15
    # With them a receiver is bounded and passes over the far cells.
    low = np.array([[10.0 * k, 0.0, 0.0] for k in range(8)])
    index = CellIndex(low, low + [10.0, 101.0, 13.0], np.zeros(8, bool), found, np.zeros(3), 3)
    visits = index.visits(np.array([[5.0, 50.0, np.nan], [65.0, 10.0, np.nan]]))
    assert visits.any(axis=1).all() and visits.mean() < 1


def test_open_cells_are_passed_over_only_when_safe():
    rng = np.random.default_rng(3)
    donors = rng.random((400, 4)) * 10
    donors[rng.random(donors.shape) < 0.4] = np.nan
    donors = donors[~np.isnan(donors).all(axis=1)]
    order = np.argsort(np.where(np.isnan(donors[:, 0]), -1, donors[:, 0]))
    cells = np.array_split(donors[order], 20)
    low, high = (np.array([f(c, axis=0) for c in cells]) for f in (np.nanmin, np.nanmax))
    index = CellIndex(low, high, np.ones(len(cells), bool), donors[:100], np.zeros(4), 2)
    receivers = rng.random((50, 4)) * 10
    receivers[:, 1] = np.nan
    visits = index.visits(receivers)
    for r, seen in zip(receivers, visits, strict=True):
        able = donors[~np.isnan(donors[:, 1])]
        both = ~np.isnan(able) & ~np.isnan(r)
        with np.errstate(invalid="ignore", divide="ignore"):
            distance = np.where(both.any(axis=1), 4 / both.sum(axis=1) * np.where(both, (able - r) ** 2, 0).sum(axis=1), np.inf)
        nearest = able[np.argsort(distance, kind="stable")[:2]]
        for point in nearest:
            home = next(k for k, c in enumerate(cells) if any(np.array_equal(point, x, equal_nan=True) for x in c))
            assert seen[home]


def searched(rows: int, patterns: int, target: int = 64, k: int = 3):
    """Points with gaps, their tree and index, and for each receiver its bound from the home cells."""
    rng = np.random.default_rng(rows)
    points = rng.random((rows, 3)) * [100, 60, 30]
    gaps = rng.random(rows)
    points[gaps < 0.1, 2] = np.nan
    points[gaps > 0.95, 0] = np.nan
    masks = np.array([[True, True, True], [True, True, False], [False, True, True]])[:patterns]  # others are in the open cell
    tree = CellTree(points[::2], masks, rows, target, 4096)
    place = tree.place(points)
    leaves, which = np.unique(place, return_inverse=True)
    cells = [points[which == i] for i in range(len(leaves))]
    low, high = (np.array([f(np.where(np.isnan(c), e, c), axis=0) for c in cells]) for f, e in ((np.min, np.inf), (np.max, -np.inf)))
    low[np.isinf(low)] = high[np.isinf(high)] = np.nan
    low, high, sizes = tree.boxes(leaves, low, high, np.array([len(c) for c in cells]))
    index = CellIndex(low, high, tree.opened, points[:20], np.zeros(3), k, vars(tree), sizes)
    receivers = points[np.isnan(points).any(axis=1)][:200]
    known = np.full(receivers.shape, np.nan)
    for r, home in zip(*index.homes(receivers), strict=True):
        for column, _, _, distance in block_nearest(receivers[r : r + 1], points[place == home], k, np.zeros(3)):
            known[r, column] = np.fmin(known[r, column], distance[-1] if len(distance) == k else np.nan)
    return points, place, index, receivers, known


@pytest.mark.parametrize("patterns", [3, 2])
def test_a_receiver_visits_few_cells_of_a_larger_table_and_misses_none(patterns):
    visits = {}
    for rows in (4000, 32000):
        points, place, index, receivers, known = searched(rows, patterns)
        assert np.isfinite(known[np.isnan(receivers)]).mean() > 0.9
        row, cell = index.pairs(receivers, known)
        visits[rows] = len(row) / len(receivers)
        met = set(zip(row.tolist(), cell.tolist()))
        for column, r, donor, _ in block_nearest(receivers, points, 3, np.zeros(3)):
            assert {(int(i), int(place[d])) for i, d in zip(r, donor, strict=True)} <= met
    # Eight times the rows; some donors share a single column with a receiver, so more than one cell is near.
    assert visits[32000] < 3 * visits[4000] < 60, visits
    assert visits[32000] < 0.25 * index.visits(receivers).sum() / len(receivers)


def test_known_bounds_leave_the_nearest_as_they_are():
    points, _, _, receivers, known = searched(4000, 2)
    free, bound = ({c: x for c, *x in block_nearest(receivers, points, 3, np.zeros(3), b)} for b in (None, known))
    assert free.keys() == bound.keys()
    for column in free:
        assert all(np.array_equal(a, b) for a, b in zip(free[column], bound[column], strict=True))


def test_donors_that_lack_the_same_columns_are_compared_as_any_others():
    """An extra donor without a common column takes the general way and changes nothing."""
    rng = np.random.default_rng(5)
    donors = np.round(rng.normal(size=(300, 5)) * [50, 9, 3, 1, 2], 1)
    donors[:, 1] = np.nan
    receivers = np.round(rng.normal(size=(80, 5)) * [50, 9, 3, 1, 2], 1)
    receivers[rng.random(receivers.shape) < 0.4] = np.nan
    mixed = np.vstack([donors, np.full((1, 5), np.nan)])
    known = np.where(np.isnan(receivers), rng.choice([4.0, 30.0, np.nan], receivers.shape), np.nan)
    for bound in (None, known):
        for k in (1, 3, 400):
            even, general = ({c: x for c, *x in block_nearest(receivers, d, k, np.full(5, 0.5), bound)} for d in (donors, mixed))
            assert even.keys() <= general.keys() and 1 not in even
            for column, found in general.items():
                for mine, theirs in zip(even.get(column, [()] * 3), found, strict=True):
                    np.testing.assert_array_equal(mine, theirs)


def test_results_leave_a_task_in_few_batches():
    ones = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([[{"a": float(i)}]])], names=["i", "recv"]) for i in range(500)]
    out = list(impute._gathered(iter(ones)))
    assert len(out) == 1 and out[0].column("i").to_pylist() == list(range(500))
    assert out[0].column("recv").to_pylist()[7] == [{"a": 7.0}]
    assert list(impute._gathered(iter([]))) == []


def test_comparing_is_spread_however_few_bytes_meet(spark):
    rows = spark.range(400).select((F.col("id") % 50).cast("int").alias("_cell"), (F.col("id") % 2).cast("int").alias("_chunk"), "id")
    other = rows.groupBy("_cell", "_chunk").agg(F.count("id").alias("n"))
    met = impute._dealt(rows, 12).hint("merge").join(impute._dealt(other, 12), impute.MEETING)
    assert met.select(F.spark_partition_id()).distinct().count() > 6
    assert met.count() == 400


def test_blocks_of_a_chunk_meet_its_donors_together(spark, monkeypatch):
    monkeypatch.setattr(impute, "BLOCK_ROWS", 30)
    rows = [(cell, 0, [(float(cell * 1000 + 10 * i + j),) for j in range(10)]) for cell in range(3) for i in range(20)]
    met = spark.createDataFrame(rows, "_cell int, _chunk int, recv array<struct<a: double>>")
    merged = impute._merged(impute._dealt(met, 4)).collect()
    assert len(merged) == 21  # seven blocks of at most 30 receivers for each cell
    assert all(len(r.recv) <= 40 for r in merged)
    found = sorted((r._cell, p.a) for r in merged for p in r.recv)
    assert found == sorted((cell, p[0]) for cell, _, points in rows for p in points)


def test_rounds_give_the_same_rows_and_leave_only_the_values_found(spark, tmp_path, monkeypatch):
    """Receivers searched for in several rounds; all tables of the search are gone, those of the values found lie in the given folder."""
    rng = np.random.default_rng(3)
    values = np.round(rng.normal(size=(400, 4)) * [50, 9, 3, 1], 1)
    values[rng.random(values.shape) < 0.2] = np.nan
    values[7] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(values)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double")
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path / "shared"))
    monkeypatch.setattr(impute, "CELL_ROWS", 40)
    found = []
    for most in (1 << 23, 60):
        monkeypatch.setattr(impute, "ROUND_RECEIVERS", most)
        kept = tmp_path / f"kept{most}"
        found.append(sorted(impute.knn_impute(df, list("abcd"), ["id"], 3, within=str(kept)).collect()))
        assert list((tmp_path / "shared").iterdir()) == []
        tables = len(list(kept.iterdir()))
        assert tables == 1 if most > 400 else tables > 2
    assert found[0] == found[1] and len(found[0]) == 400
    assert all(v is not None for row in found[0] for v in row)

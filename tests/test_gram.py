import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from derrick.operators import gram, models
from derrick.operators.split import with_folds
from derrick.schema import TARGETS

CANDIDATES = [{"fitIntercept": i, "regParam": r} for i in (True, False) for r in (0.0, 0.1, 1.0)]
FEATURES = [f"x{i}" for i in range(12)]


def frame(spark, n=160, wells=1, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n * wells, 12))
    y = x @ rng.normal(0, 1, (12, 3)) + rng.normal(0, 2, (n * wells, 3)) + 0.3
    rows = [(f"w{i % wells}", i // wells, *map(float, x[i]), *map(float, y[i])) for i in range(n * wells)]
    names = ["well string", "day long", *[f"{c} double" for c in (*FEATURES, "a", "b", "c")]]
    return spark.createDataFrame(rows, ", ".join(names)), x, y


def by_hand(x, y, candidate):
    """Least squares on the rows themselves, the penalty as further rows."""
    n, p = x.shape
    more = np.sqrt(n * candidate["regParam"]) * np.eye(p)
    if candidate["fitIntercept"]:
        x, more = np.column_stack([np.ones(n), x]), np.column_stack([np.zeros(p), more])
    found = np.linalg.lstsq(np.vstack([x, more]), np.vstack([y, np.zeros((p, y.shape[1]))]), rcond=None)[0]
    return found if candidate["fitIntercept"] else np.vstack([np.zeros(y.shape[1]), found])


def errors_by_hand(x, y, k=3):
    n = len(x)
    size, start = n // (k + 1), n - n // (k + 1) * k
    out = {}
    for c, candidate in enumerate(CANDIDATES):
        for fold in range(k):
            end = start + fold * size
            weights = by_hand(x[:end], y[:end], candidate)
            miss = y[end : end + size] - weights[0] - x[end : end + size] @ weights[1:]
            out[c, fold] = (miss**2).mean()
    return out


def test_twelve_features_fold_scores_and_choice(spark):
    df, x, y = frame(spark)
    want = errors_by_hand(x, y)
    for parts in (1, 5):
        folds = with_folds(df.repartition(parts), 3, "day")
        found = gram.cv_scores(folds, CANDIDATES, FEATURES, ["a", "b", "c"], 3)
        assert {(t["candidate"], t["fold"]): pytest.approx(t["mse"], rel=1e-9) for t in found} == want
        best = min((np.mean([want[c, f] for f in range(3)]), c) for c in range(len(CANDIDATES)))
        assert models.best_candidate(found) == (best[1], pytest.approx(best[0], rel=1e-9))


def test_scores_become_a_frame(spark):
    df, _, _ = frame(spark, 40)
    trials = gram.cv_scores(with_folds(df, 3, "day"), CANDIDATES, FEATURES[:2], ["a"], 3)
    scores = spark.createDataFrame(trials, "candidate int, fold int, mse double")
    assert [r["mse"] for r in scores.collect()] == [t["mse"] for t in trials]


def test_every_series_is_fitted_by_itself(spark):
    df, x, y = frame(spark, 100, 3)
    folds = with_folds(df.repartition(4), 3, "day", ["well"])
    rows = {r["well"]: r for r in gram.fit_series(folds, CANDIDATES, FEATURES, ["a", "b", "c"], ["well"], 3).collect()}
    assert set(rows) == {"w0", "w1", "w2"}
    for i in range(3):
        own = rows[f"w{i}"]
        errors = errors_by_hand(x[i::3], y[i::3])
        mse, best = min((np.mean([errors[c, f] for f in range(3)]), c) for c in range(len(CANDIDATES)))
        assert (own["n_rows"], own["candidate"]) == (100, best) and own["cv_mse"] == pytest.approx(mse, rel=1e-9)
        weights = by_hand(x[i::3], y[i::3], CANDIDATES[best])
        for j, t in enumerate("abc"):
            assert own[f"{t}_intercept"] == pytest.approx(weights[0, j], abs=1e-9)
            assert own[f"{t}_weights"] == pytest.approx(list(weights[1:, j]), abs=1e-9)


def test_fit_equals_the_library_model(spark):
    df, x, y = frame(spark, 90)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
    for candidate in (c for c in CANDIDATES if not c["regParam"]):
        model = models._linear(featuresCol="features", labelCol="a", predictionCol="p", fitIntercept=candidate["fitIntercept"]).fit(assembled)
        weights = by_hand(x, y, candidate)
        assert list(model.coefficients) == pytest.approx(list(weights[1:, 0]), abs=1e-8)
        assert model.intercept == pytest.approx(weights[0, 0], abs=1e-8)


def test_edge_cases(spark):
    df, x, y = frame(spark, 40)
    # Rows with a gap are left out; a column twice shares its weight; a null key is a series.
    holes = df.withColumn("x0", F.when(F.col("day") >= 5, F.col("x0"))).withColumn("x1", F.when(F.col("day") == 7, F.lit(float("nan"))).otherwise(F.col("x1")))
    kept = np.array([i for i in range(40) if i >= 5 and i != 7])
    both = holes.withColumns({"x12": F.col("x0"), "well": F.lit(None).cast("string")})
    row = gram.fit_series(with_folds(both, 3, "day", ["well"]), CANDIDATES[:1], [*FEATURES, "x12"], ["a"], ["well"], 3).first()
    weights = by_hand(x[kept], y[kept], CANDIDATES[0])
    assert (row["well"], row["n_rows"]) == (None, 34)
    assert row["a_weights"][0] == pytest.approx(weights[1, 0] / 2, abs=1e-8) and row["a_weights"][12] == pytest.approx(weights[1, 0] / 2, abs=1e-8)
    # A series too short for folds, and no rows at all.
    short = with_folds(df.filter("day < 2"), 3, "day", ["well"])
    row = gram.fit_series(short, CANDIDATES, ["x0"], ["a"], ["well"], 3).first()
    assert (row["candidate"], row["cv_mse"], row["n_rows"]) == (0, None, 2)
    nothing = with_folds(df.filter("day < 0"), 3, "day", ["well"])
    assert gram.fit_series(nothing, CANDIDATES, FEATURES, ["a"], ["well"], 3).count() == 0
    assert gram.cv_scores(nothing, CANDIDATES, FEATURES, ["a"], 3) == []

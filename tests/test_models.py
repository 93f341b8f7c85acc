import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from derrick.operators import forecast, metrics, models
from derrick.operators.forest_stage import ForestStage
from derrick.plans import jobs
from derrick.schema import MODEL_AI, READINGS, TARGETS
from derrick.sinks import model_store, upsert

START = dt.date(2020, 1, 1)


def daily_frame(spark, n, rule):
    """Daily means with planted targets; ``rule(i, x)`` gives the three targets."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        x = rng.uniform(0, 10, len(READINGS)).tolist()
        rows.append((18_262 * 86_400 + i * 86_400, *[float(v) for v in rule(i, x)], *x))
    columns = ["DAYTIME long", *[f"{c} double" for c in [*TARGETS, *READINGS]]]
    return spark.createDataFrame(rows, ", ".join(columns))


def linear_rule(_i, x):
    return 2 * x[0] + 3 * x[1] + 1, x[2] - x[3], 5 + x[8]


def test_draws_are_distinct_and_small_grids_are_taken_whole():
    assert models.draw_params(models.LINEAR_GRID) == [{"fitIntercept": True}, {"fitIntercept": False}]
    drawn = models.draw_params(models.BOOSTED_GRID)
    assert len(drawn) == 5 and len({tuple(d.items()) for d in drawn}) == 5
    assert drawn == models.draw_params(models.BOOSTED_GRID)
    assert math.prod(len(v) for v in models.BOOSTED_GRID.values()) == 108


@pytest.mark.parametrize("fit_on", ["train", "all"])
def test_planted_line_is_recovered(spark, fit_on):
    fitted = models.train_daily(daily_frame(spark, 120, linear_rule), models.MODELS["linear"], fit_on=fit_on)
    assert fitted.metrics["r2_global"] == pytest.approx(1.0, abs=1e-6)
    assert fitted.params["fitIntercept"] == "True"
    assert fitted.predictions.columns == MODEL_AI.fieldNames()
    rows = fitted.predictions.orderBy("DAYTIME").collect()
    assert len(rows) == math.ceil(0.2 * 120) and rows[-1]["DAYTIME"] == START + dt.timedelta(119)
    assert all(r["OIL_VOL_pred"] == pytest.approx(r["OIL_VOL_test"], abs=1e-6) for r in rows)
    assert len(fitted.trials) == 2 * 3


def test_scaling_statistics_come_from_the_training_rows(spark):
    def rule(i, x):
        return (1000.0 if i >= 80 else 1.0 + x[0], x[1], x[2])

    frame = daily_frame(spark, 100, rule)
    seen = {}
    for fit_on in ("train", "all"):
        fitted = models.train_daily(frame, models.MODELS["linear"], fit_on=fit_on)
        import json

        seen[fit_on] = json.loads(fitted.params["scaler"])["OIL_VOL"][0]
    assert seen["train"] < 12 and seen["all"] > 200


def test_trees_beat_persistence_on_a_non_linear_signal(spark):
    def rule(i, x):
        return (100.0 if x[0] > 5 else 0.0, 50.0 if x[1] > 3 else 10.0, 7.0 if x[2] > 5 else 70.0)

    frame = daily_frame(spark, 200, rule)
    grid = {"numTrees": [20], "maxDepth": [6], "minInstancesPerNode": [2], "featureSubsetStrategy": ["0.5"]}
    forest = models.train_daily(frame, models.MODELS["forest"], grid=grid)
    grid = {"maxIter": [10], "maxDepth": [3], "stepSize": [0.3], "subsamplingRate": [1.0], "featureSubsetStrategy": ["all"]}
    boosted = models.train_daily(frame, models.MODELS["boosted"], grid=grid)
    day = F.to_date(F.timestamp_seconds("DAYTIME"))
    baseline = metrics.evaluate(forecast.persistence(frame.select(day.alias("DAYTIME"), *TARGETS))).first()["mse_global"]
    for fitted in (forest, boosted):
        assert metrics.evaluate(fitted.predictions).first()["mse_global"] < baseline / 4
        assert {"numTrees", "maxIter"} & set(fitted.params)


def wave(spark, n):
    """Daily sums that follow x(t) = 1.5 x(t-1) - 0.9 x(t-2) + 40 exactly."""
    values = [[100.0, 50.0, 10.0], [110.0, 45.0, 12.0]]
    while len(values) < n:
        values.append([1.5 * b - 0.9 * a + 40 for a, b in zip(values[-2], values[-1])])
    rows = [(START + dt.timedelta(i), *v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "DAYTIME date, " + ", ".join(f"{t} double" for t in TARGETS)), values


LOOKBACK = models.ModelSpec("lb2", "LB2", "Lookback2", models._linear, models.LINEAR_GRID, 2, "minmax")


def test_saved_lookback_model_rolls_forward(spark, tmp_path):
    sums, _ = wave(spark, 60)
    fitted = models.train_lookback(sums, LOOKBACK)
    assert fitted.predictions.count() == 58 - int(0.8 * 58)
    model_store.save_model(spark, str(tmp_path), fitted)
    pipeline, params = model_store.load_model(spark, str(tmp_path), fitted.id_model)
    rows = forecast.forecast_saved(pipeline, fitted.id_model, params, sums, 5).orderBy("DAYTIME").collect()
    _, longer = wave(spark, 65)
    assert [r["DAYTIME"] for r in rows] == [START + dt.timedelta(60 + i) for i in range(5)]
    for r, want in zip(rows, longer[60:]):
        assert [r[t] for t in TARGETS] == pytest.approx(want, rel=1e-6)
    # Any other model goes one day at a time; on a linear one both must agree.
    stepped = forecast.roll_model(forecast.recent_frame(sums, 2), pipeline, 2, 5, cut_every=2).orderBy("DAYTIME").collect()
    for r, want in zip(stepped, rows):
        assert [r[t] for t in TARGETS] == pytest.approx([want[t] for t in TARGETS])
    with pytest.raises(LookupError):
        model_store.load_model(spark, str(tmp_path), "unknown")


def test_boosted_lookback_model_rolls_forward(spark):
    sums, _ = wave(spark, 40)
    spec = models.ModelSpec("lbt", "LBT", "LookbackTrees", models._boosted, {"maxIter": [3], "maxDepth": [2]}, 2, "standard")
    fitted = models.train_lookback(sums, spec)
    rows = forecast.forecast_saved(fitted.pipeline, fitted.id_model, fitted.params, sums, 7)
    assert rows.count() == 7 and rows.filter("OIL_VOL IS NULL").count() == 0


@pytest.mark.parametrize("family, grid", [("forest", {"numTrees": [5], "maxDepth": [4], "minInstancesPerNode": [2], "featureSubsetStrategy": ["0.5"]}), ("boosted", {"maxIter": [6], "maxDepth": [3], "stepSize": [0.3]})])
def test_saved_trees_roll_forward_in_one_pass(spark, tmp_path, family, grid):
    sums, _ = wave(spark, 60)
    spec = models.ModelSpec("t", "T", "LookbackTrees", models.MODELS[family].build, grid, 2, "minmax", shared=True)
    fitted = models.train_lookback(sums, spec)
    model_store.save_model(spark, str(tmp_path), fitted)
    pipeline, params = model_store.load_model(spark, str(tmp_path), fitted.id_model)
    rows = forecast.forecast_saved(pipeline, fitted.id_model, params, sums, 5).orderBy("DAYTIME").collect()
    stepped = forecast.roll_model(forecast.recent_frame(sums, 2), pipeline, 2, 5, cut_every=1).orderBy("DAYTIME").collect()
    assert len(rows) == 5 and [r["DAYTIME"] for r in rows] == [r["DAYTIME"] for r in stepped]
    for r, want in zip(rows, stepped):
        assert [r[t] for t in TARGETS] == pytest.approx([want[t] for t in TARGETS], rel=1e-12)
    # Several series at once give what each gives alone.
    two = sums.withColumn("WELL", F.lit("a")).unionByName(sums.withColumn("WELL", F.lit("b")).withColumn("OIL_VOL", F.col("OIL_VOL") / 2))
    stage = next(s for s in pipeline.stages if isinstance(s, ForestStage))
    both = forecast.roll_trees(forecast.recent_frame(two, 2, series_cols=["WELL"]), stage, params, 5, series_cols=["WELL"])
    mine = both.filter("WELL = 'a'").orderBy("DAYTIME").collect()
    assert both.count() == 10 and [[r[t] for t in TARGETS] for r in mine] == [[r[t] for t in TARGETS] for r in rows]


def production(spark, n):
    rows = [
        (START + dt.timedelta(i), w, *[float((i * (j + 3) + k) % 17) for j in range(9)], float(i % 13 + k), float(i % 7 + k), float(i % 5))
        for i in range(n)
        for k, w in enumerate("ab")
    ]
    names = ["DAYTIME date", "WELL_BORE_CODE string", *[f"{c} double" for c in READINGS], "BORE_OIL_VOL double", "BORE_GAS_VOL double", "BORE_WAT_VOL double"]
    return spark.createDataFrame(rows, ", ".join(names))


def test_a_failing_model_is_recorded_and_does_not_stop_the_others(spark, tmp_path):
    from derrick.operators.clean import conform
    from derrick.schema import PWELL_DATA

    home = str(tmp_path)
    upsert.upsert(spark, home, "pwell_data", conform(production(spark, 60), PWELL_DATA, ["DAYTIME"]))

    def trainer(table, spec):
        if spec.name == "forest":
            raise RuntimeError("no luck")
        return models.train(table, spec)

    runs = {r.name: r for r in jobs.run_models(spark, home, ["forest", "linear", "lookback20"], trainer)}
    assert not runs["forest"].ok and "no luck" in runs["forest"].error and runs["forest"].id_model is None
    assert runs["linear"].ok and runs["lookback20"].ok and runs["linear"].seconds > 0
    stored = upsert.read_table(spark, home, "model_ai")
    assert {r["model_type"]: r["n"] for r in stored.groupBy("model_type").agg(F.count("*").alias("n")).collect()} == {"LR": 12, "LB20": 8}
    params = upsert.read_table(spark, home, "model_params").filter(F.col("id_model") == runs["linear"].id_model).first()
    assert params["metrics"]["mse_global"] >= 0 and "scaler" in params["params"]
    jobs.run_forecast(spark, home, runs["lookback20"].id_model, 3)
    jobs.run_forecast(spark, home, runs["lookback20"].id_model, 3)
    assert upsert.read_table(spark, home, "model_pf").count() == 3
    with pytest.raises(ValueError, match="rolled forward"):
        jobs.run_forecast(spark, home, runs["linear"].id_model, 3)

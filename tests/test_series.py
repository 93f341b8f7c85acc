"""Splits, folds, look-back, scaling, encoding, metrics, reports, linear forecasts."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from derrick.operators import encode, forecast, metrics, report, scale, split, window
from derrick.schema import MODEL_AI

START = dt.date(2020, 1, 1)


def days(spark, n, series=("s",)):
    rows = [(s, START + dt.timedelta(i), float(i), 2.0 * i, 3.0 * i) for s in series for i in range(n)]
    return spark.createDataFrame(rows, "s string, DAYTIME date, OIL_VOL double, GAS_VOL double, WAT_VOL double")


@pytest.mark.parametrize("n", [1, 7, 10, 23, 35])
def test_split_sizes(spark, n):
    df = days(spark, n)
    assert split.split_by_share(df).filter("is_test").count() == math.ceil(0.2 * n)
    assert split.split_by_head(df).filter("NOT is_test").count() == int(0.8 * n)
    last = split.split_by_share(df).filter("is_test").agg(F.min("rn")).first()[0]
    assert last == n - math.ceil(0.2 * n) + 1


@pytest.mark.parametrize("n", [8, 21, 30])
def test_folds_train_only_on_the_past(spark, n):
    folds = split.with_folds(days(spark, n))
    size = n // 4
    got = {r["fold"]: (r["train_rows"], r["test_rows"]) for r in split.fold_sizes(folds).collect()}
    assert got == {j: (n - (3 - j) * size, size) for j in range(3)}
    for j in range(3):
        train, test = split.fold_parts(folds, j)
        assert train.agg(F.max("rn")).first()[0] < test.agg(F.min("rn")).first()[0]


def test_lookback_frames_labels_and_lags(spark):
    df = days(spark, 6, ("a", "b"))
    frames = window.lookback(df, ["OIL_VOL", "GAS_VOL"], 3, series_cols=["s"])
    assert frames.count() == 2 * 3
    first = frames.filter("s = 'a'").orderBy("DAYTIME").first()
    assert first["frame"] == [[0.0, 0.0], [1.0, 2.0], [2.0, 4.0]] and first["OIL_VOL"] == 3.0
    lags = window.lagged(df, ["OIL_VOL"], 3, series_cols=["s"]).filter("s = 'a'").orderBy("DAYTIME").first()
    assert [lags[f"OIL_VOL_lag{i}"] for i in (3, 2, 1)] == [0.0, 1.0, 2.0]
    assert window.tail(df, 2, series_cols=["s"]).count() == 4
    assert [r["OIL_VOL"] for r in window.tail(df.filter("s = 'a'"), 2).collect()] == [5.0, 4.0]


def test_latest_per_key_is_limited_before_the_shuffle(spark):
    plan = window.latest_per_key(days(spark, 4), ["s"], ["DAYTIME"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_scaling_is_population_and_handles_constant_columns(spark):
    df = spark.createDataFrame([(float(i), 5.0, i) for i in range(200)], "x double, c double, k long")
    scaled, stats = scale.normalize(df, ["x", "c"])
    row = stats.first()
    assert row["x_std"] == pytest.approx(np.arange(200).std()) and row["c_std"] == 0.0
    values = np.array(scaled.orderBy("k").select("x", "c").collect())
    assert values[:, 0].mean() == pytest.approx(0, abs=1e-12) and (values[:, 1] == 0).all()
    back = np.array(scale.invert_standard(scaled, stats, ["x", "c"]).orderBy("k").select("x", "c").collect())
    assert np.allclose(back, [[i, 5.0] for i in range(200)])
    bounds = scale.minmax_stats(df, ["x", "c"])
    small = scale.apply_minmax(df, bounds, ["x", "c"])
    assert small.agg(F.min("x"), F.max("x"), F.max("c")).first()[:] == (0.0, 1.0, 0.0)
    assert scale.invert_minmax(small, bounds, ["x", "c"]).agg(F.max("x"), F.min("c")).first()[:] == (199.0, 5.0)
    plan = scaled._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scaling_per_series(spark):
    df = days(spark, 5, ("a", "b")).withColumn("OIL_VOL", F.when(F.col("s") == "b", F.col("OIL_VOL") * 10).otherwise(F.col("OIL_VOL")))
    scaled, _ = scale.normalize(df, ["OIL_VOL"], ["s"])
    a, b = [np.array([r[0] for r in scaled.filter(F.col("s") == s).orderBy("DAYTIME").select("OIL_VOL").collect()]) for s in "ab"]
    assert np.allclose(a, b)


def test_ordered_statistic_equals_a_running_window_also_for_a_hot_category(spark):
    df = spark.range(2000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("c"), F.col("id") % 17)).alias("cat"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 13) / 4).alias("y"),
    )
    got = encode.ordered_stat(df, "cat", "y", "k")
    before = Window.partitionBy("cat").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumns({"run_sum": F.coalesce(F.sum("y").over(before), F.lit(0.0)), "run_count": F.count("y").over(before)})
    assert got.exceptAll(want).count() == 0 and got.count() == 2000


def test_target_encoding_fit_and_apply(spark):
    rows = [(1, "a", 1.0), (2, "b", 2.0), (3, "a", 3.0), (4, "c", 6.0)]
    df = spark.createDataFrame(rows, "k long, t string, y double")
    got = {r["k"]: r["t"] for r in encode.encode_fit(df, ["t"], "y", "k").collect()}
    assert got == {1: 3.0, 2: 3.0, 3: (1.0 + 3.0) / 2, 4: 3.0}
    new = spark.createDataFrame([(1, "a", 0.0), (2, "b", 0.0), (3, "zz", 0.0)], "k long, t string, y double")
    got = {r["k"]: r["t"] for r in encode.encode_apply(new, df, ["t"], "y").collect()}
    assert got == {1: (4.0 + 3.0) / 3, 2: 3.0, 3: 3.0}


def frame9(spark, actual, predicted):
    rows = [("m", "T", START + dt.timedelta(i), a, a, a, p, p, p) for i, (a, p) in enumerate(zip(actual, predicted))]
    return spark.createDataFrame(rows, MODEL_AI)


def test_metrics(spark):
    y, p = np.array([1.0, 2.0, 4.0, 8.0]), np.array([1.5, 2.0, 3.0, 9.0])
    row = metrics.evaluate(frame9(spark, y.tolist(), p.tolist())).first()
    mse = ((y - p) ** 2).mean()
    r2 = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert row["mse_OIL"] == pytest.approx(mse) and row["mse_global"] == pytest.approx(mse)
    assert row["rmse_GAS"] == pytest.approx(mse**0.5) and row["mae_WAT"] == pytest.approx(np.abs(y - p).mean())
    assert row["r2_OIL"] == pytest.approx(r2) and row["r2_global"] == pytest.approx(r2)
    assert row["mse_OIL"] >= 0


def test_report_status_is_strict_and_filters_are_inclusive(spark):
    table = frame9(spark, [100.0, 100.0, 100.0], [180.0, 180.5, 19.0])
    oil = report.report_table(table).filter("target = 'OIL'").orderBy("DAYTIME").collect()
    assert [r["status"] for r in oil] == ["Normal", "Check", "Check"]
    assert {r["target"]: r["unit"] for r in report.report_table(table).collect()} == {"OIL": "bbl/d", "GAS": "mcf/d", "WAT": "bbl/d"}
    assert report.filtered_report(table, predicted=(180.0, 180.5), target="GAS").count() == 2
    assert report.filtered_report(table, dates=(START, START), status="all").count() == 3
    assert report.filtered_report(table, status="Check", model_type="T").count() == 6
    assert report.filtered_report(table, model_type="other").count() == 0


def test_performance_series_skips_a_fluid_without_columns(spark):
    table = frame9(spark, [1.0], [2.0]).drop("GAS_VOL_pred")
    rows = report.performance_series(table, "M").collect()
    assert {(r["fluid"], r["kind"]): r["value"] for r in rows} == {
        ("OIL", "actual"): 1.0,
        ("OIL", "predicted"): 2.0,
        ("WAT", "actual"): 1.0,
        ("WAT", "predicted"): 2.0,
    }


def test_linear_roll_forward_per_series(spark):
    recent = forecast.recent_frame(days(spark, 10, ("a", "b")), 2, series_cols=["s"])
    weights = [[0.5 if i == j else (0.25 if i == j + 3 else 0.0) for i in range(6)] for j in range(3)]
    got = forecast.roll_linear(recent, weights, [1.0, 0.0, 0.0], 4, series_cols=["s"])
    assert got.count() == 8
    oil = [8.0, 9.0]
    for _ in range(4):
        oil.append(1.0 + 0.5 * oil[-2] + 0.25 * oil[-1])
    rows = got.filter("s = 'b'").orderBy("DAYTIME").collect()
    assert [r["OIL_VOL"] for r in rows] == pytest.approx(oil[2:])
    assert [r["DAYTIME"] for r in rows] == [START + dt.timedelta(10 + i) for i in range(4)]


def test_series_shorter_than_the_frame_are_left_out(spark):
    assert forecast.recent_frame(days(spark, 3), 5, series_cols=["s"]).count() == 0

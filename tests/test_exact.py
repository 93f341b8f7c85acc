"""Sums, deviations and scores at small, large and offset magnitudes."""

import math

import pytest
from pyspark.sql import functions as F

from derrick.functions import exact
from derrick.operators import encode, metrics, scale


@pytest.mark.parametrize("values", [[k * 1e-4 for k in range(7)], [2e11 + k for k in range(5)], [1e9, 1e9 + 1, 1e9 + 2], [3e15, 5e15, -1e15]])
def test_deviation_and_r2(spark, values):
    df = spark.createDataFrame([(v, v + (i % 2) * (max(values) - min(values)) / 8) for i, v in enumerate(values)], "y double, p double")
    mean = math.fsum(values) / len(values)
    spread = math.fsum((v - mean) ** 2 for v in values) / len(values)
    row = scale.standard_stats(df.repartition(3), ["y"]).first()
    assert row["y_mean"] == pytest.approx(mean, rel=1e-14)
    near = max(1e-9, 1e-16 * abs(mean) / math.sqrt(spread))  # what the offset leaves of a double
    assert row["y_std"] == pytest.approx(math.sqrt(spread), rel=near)
    errors = [(r.y - r.p) ** 2 for r in df.collect()]
    scored = metrics.evaluate(df, {"Y": ("y", "p")}).first()
    assert scored["r2_Y"] == pytest.approx(1 - math.fsum(errors) / len(errors) / spread, rel=max(near, 1e-9))
    assert scored["mse_Y"] == pytest.approx(math.fsum(errors) / len(errors), rel=1e-9)


def test_large_decimals_are_added_exactly(spark):
    rows = spark.range(1000).select(F.expr("cast(99999999999.999 as decimal(14,3))").alias("v"))
    assert rows.agg(exact.total("v").alias("t")).first()["t"] == 99999999999999.0


def test_small_category_sums_are_kept(spark):
    df = spark.createDataFrame([(i, "a", 1e-7) for i in range(4)], "i int, c string, v double")
    assert encode.category_stats(df, "c", "v").first()["cat_sum"] == pytest.approx(4e-7, rel=1e-12)
    runs = sorted(r["run_sum"] for r in encode.ordered_stat(df, "c", "v", "i").collect())
    assert runs == pytest.approx([0, 1e-7, 2e-7, 3e-7])


def test_significant_digits(spark):
    df = spark.createDataFrame([(123456.789,), (-0.00012345678,), (0.0,), (None,)], "x double")
    assert [r[0] for r in df.select(exact.significant("x", 4)).collect()] == [123500.0, -0.0001235, 0.0, None]

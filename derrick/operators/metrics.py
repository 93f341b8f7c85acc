"""Regression metrics per target and over all targets.

``pairs`` maps a target name to its (actual, predicted) columns. All metrics of
a frame come from one aggregate.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.schema import TARGETS

Pairs = dict[str, tuple[str, str]]
METRICS = ("mse", "rmse", "mae", "r2")


def model_pairs(targets: list[str] = TARGETS) -> Pairs:
    return {t.removesuffix("_VOL"): (f"{t}_test", f"{t}_pred") for t in targets}


def _moments(target: str, actual: str, predicted: str) -> list[Column]:
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    both = F.when(y.isNotNull() & p.isNotNull(), y)
    error = y - p
    return [
        F.count(error).cast("double").alias(f"_n_{target}"),
        F.sum(error * error).alias(f"_sse_{target}"),
        F.sum(F.abs(error)).alias(f"_sae_{target}"),
        F.var_pop(both).alias(f"_var_{target}"),
    ]


def _metric(name: str, target: str) -> Column:
    n, sse = F.nullif(F.col(f"_n_{target}"), F.lit(0.0)), F.col(f"_sse_{target}")
    if name == "mse":
        return sse / n
    if name == "rmse":
        return F.sqrt(sse / n)
    if name == "mae":
        return F.col(f"_sae_{target}") / n
    return F.lit(1.0) - sse / n / F.nullif(F.col(f"_var_{target}"), F.lit(0.0))


def evaluate(
    df: DataFrame,
    pairs: Pairs | None = None,
    metrics: tuple[str, ...] = METRICS,
    series_cols: list[str] | None = None,
    overall: bool = True,
) -> DataFrame:
    """One row: ``<metric>_<target>`` and, if asked, ``<metric>_global`` (the
    unweighted mean over the targets) for MSE and R²."""
    pairs = pairs or model_pairs()
    keys = list(series_cols or [])
    moments = [m for target, (a, p) in pairs.items() for m in _moments(target, a, p)]
    columns = [_metric(name, t).alias(f"{name}_{t}") for name in metrics for t in pairs]
    if overall:
        columns += [
            (reduce(add, [_metric(name, t) for t in pairs]) / F.lit(float(len(pairs)))).alias(f"{name}_global")
            for name in metrics
            if name in ("mse", "r2")
        ]
    return df.groupBy(*keys).agg(*moments).select(*keys, *columns)


def mse(df: DataFrame, pairs: Pairs | None = None) -> DataFrame:
    return evaluate(df, pairs, ("mse",), overall=False)


def mse_global(df: DataFrame, pairs: Pairs | None = None) -> DataFrame:
    return evaluate(df, pairs, ("mse",)).select("mse_global")


def r2(df: DataFrame, pairs: Pairs | None = None) -> DataFrame:
    return evaluate(df, pairs, ("r2",), overall=False)


def r2_global(df: DataFrame, pairs: Pairs | None = None) -> DataFrame:
    return evaluate(df, pairs, ("r2",)).select("r2_global")


def rmse_mae(df: DataFrame, pairs: Pairs | None = None) -> DataFrame:
    return evaluate(df, pairs, ("rmse", "mae"), overall=False)


def metrics_long(df: DataFrame, pairs: Pairs | None = None) -> DataFrame:
    """``target, rmse, mae, r2``: the stored shape, a row per target."""
    pairs = pairs or model_pairs()
    wide = evaluate(df, pairs, ("rmse", "mae", "r2"), overall=False)
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(t).alias("target"), *[F.col(f"{m}_{t}").alias(m) for m in ("rmse", "mae", "r2")])
                for t in pairs
            ]
        )
    )
    return wide.select(rows.alias("r")).select("r.*")

"""Standard and min-max scaling, forward and inverse.

Statistics are one row (or one row per series). A single row enters the query
as a scalar subquery, per-series rows by an equi-join, so no side is copied
without need and the operators stay lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.LongType))]


def standard_stats(df: DataFrame, cols: list[str], series_cols: list[str] | None = None) -> DataFrame:
    """``<c>_mean`` and population ``<c>_std`` of each column. Spark merges central
    moments, so a large offset costs no digits."""
    stats = []
    for c in cols:
        value = F.col(c).cast("double")
        stats += [F.avg(value).alias(f"{c}_mean"), F.stddev_pop(value).alias(f"{c}_std")]
    keys = list(series_cols or [])
    return df.groupBy(*keys).agg(*stats)


def minmax_stats(df: DataFrame, cols: list[str], series_cols: list[str] | None = None) -> DataFrame:
    """``<c>_min`` and ``<c>_max`` of each column."""
    bounds = []
    for c in cols:
        value = F.col(c).cast("double")
        bounds += [F.min(value).alias(f"{c}_min"), F.max(value).alias(f"{c}_max")]
    keys = list(series_cols or [])
    return df.groupBy(*keys).agg(*bounds)


def with_stats(
    df: DataFrame, stats: DataFrame, names: list[str], series_cols: list[str] | None = None
) -> DataFrame:
    """Put the named statistics next to every row."""
    keys = list(series_cols or [])
    if keys:
        return df.join(stats.select(*keys, *names), keys, "left")
    row = stats.select(F.struct(*names).alias("_stats")).scalar()
    return df.withColumn("_stats", row).select("*", *[F.col(f"_stats.{n}").alias(n) for n in names]).drop("_stats")


def _per_column(
    df: DataFrame,
    stats: DataFrame,
    cols: list[str],
    suffixes: tuple[str, str],
    formula,
    series_cols: list[str] | None,
) -> DataFrame:
    names = [f"{c}_{s}" for c in cols for s in suffixes]
    joined = with_stats(df, stats, names, series_cols)
    changed = {
        c: formula(F.col(c).cast("double"), F.col(f"{c}_{suffixes[0]}"), F.col(f"{c}_{suffixes[1]}"))
        for c in cols
    }
    return joined.withColumns(changed).select(*df.columns)


def _divisor(spread: Column) -> Column:
    """A column without spread is only shifted."""
    return F.when(spread == 0, F.lit(1.0)).otherwise(spread)


def apply_standard(df, stats, cols, series_cols=None) -> DataFrame:
    return _per_column(
        df, stats, cols, ("mean", "std"), lambda x, mean, std: (x - mean) / _divisor(std), series_cols
    )


def invert_standard(df, stats, cols, series_cols=None) -> DataFrame:
    return _per_column(
        df, stats, cols, ("mean", "std"), lambda z, mean, std: z * _divisor(std) + mean, series_cols
    )


def apply_minmax(df, stats, cols, series_cols=None) -> DataFrame:
    return _per_column(
        df, stats, cols, ("min", "max"), lambda x, lo, hi: (x - lo) / _divisor(hi - lo), series_cols
    )


def invert_minmax(df, stats, cols, series_cols=None) -> DataFrame:
    return _per_column(
        df, stats, cols, ("min", "max"), lambda z, lo, hi: z * _divisor(hi - lo) + lo, series_cols
    )


def normalize(
    df: DataFrame, columns: list[str] | None = None, series_cols: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Standardise the columns (default: every double and bigint one); returns
    the scaled frame and the statistics needed to scale back."""
    keys = list(series_cols or [])
    cols = columns if columns is not None else [c for c in numeric_columns(df) if c not in keys]
    stats = standard_stats(df, cols, keys)
    return apply_standard(df, stats, cols, keys), stats

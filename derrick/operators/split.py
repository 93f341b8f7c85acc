"""Chronological splits and folds, as predicates over the position in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.operators.window import with_index


def _test_rows(n: Column, share: float) -> Column:
    return F.ceil(n.cast("double") * F.lit(share))


def split_by_share(
    df: DataFrame, share: float = 0.2, ts_col: str = "DAYTIME", series_cols: list[str] | None = None
) -> DataFrame:
    """Split A: the last ceil(share * n) rows are test. Adds ``is_test``."""
    indexed = with_index(df, ts_col, series_cols)
    return indexed.withColumn("is_test", F.col("rn") > F.col("n") - _test_rows(F.col("n"), share))


def split_by_head(
    df: DataFrame, share: float = 0.8, ts_col: str = "DAYTIME", series_cols: list[str] | None = None
) -> DataFrame:
    """Split B: the first floor(share * n) rows are training. Adds ``is_test``."""
    indexed = with_index(df, ts_col, series_cols)
    return indexed.withColumn("is_test", F.col("rn") > F.floor(F.col("n").cast("double") * F.lit(share)))


def with_folds(
    df: DataFrame, k: int = 3, ts_col: str = "DAYTIME", series_cols: list[str] | None = None
) -> DataFrame:
    """Expanding-window folds: the row is tested by fold ``test_fold`` (null for
    the first block) and trains every fold after it."""
    indexed = with_index(df, ts_col, series_cols)
    size = F.floor(F.col("n") / F.lit(k + 1))
    into = F.col("rn") - 1 - (F.col("n") - size * k)
    fold = F.when(into >= 0, F.floor(into / size)).cast("bigint")
    return indexed.withColumn("test_fold", fold)


def fold_parts(folds: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of one fold."""
    number = F.coalesce(F.col("test_fold"), F.lit(-1))
    return folds.filter(number < fold), folds.filter(number == fold)


def fold_sizes(folds: DataFrame, k: int = 3, series_cols: list[str] | None = None) -> DataFrame:
    """``fold, train_rows, test_rows`` per fold, from one pass."""
    keys = list(series_cols or [])
    number = F.coalesce(F.col("test_fold"), F.lit(-1))
    counts = []
    for fold in range(k):
        counts += [
            F.count_if(number < fold).alias(f"train_{fold}"),
            F.count_if(number == fold).alias(f"test_{fold}"),
        ]
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(fold).cast("bigint").alias("fold"),
                    F.col(f"train_{fold}").alias("train_rows"),
                    F.col(f"test_{fold}").alias("test_rows"),
                )
                for fold in range(k)
            ]
        )
    )
    return folds.groupBy(*keys).agg(*counts).select(*keys, rows.alias("r")).select(*keys, "r.*")

"""Ordered operators over a series.

Every window is keyed by ``series_cols``. The empty list means one global
series and is meant for frames already reduced to a row per day, whose length
the calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _series(series_cols: list[str] | None, ts_col: str):
    keys = list(series_cols or [])
    return Window.partitionBy(*keys).orderBy(ts_col)


def latest_per_key(
    df: DataFrame, keys: list[str], sequence: list[str], first: bool = False
) -> DataFrame:
    """The last (or first) row of each key in ``sequence`` order.

    The rank is filtered directly, so Spark keeps one row per key on the map
    side already (WindowGroupLimit) and a hot key never meets in one task.
    """
    order = [F.col(c).asc() if first else F.col(c).desc() for c in sequence]
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def with_index(
    df: DataFrame, ts_col: str = "DAYTIME", series_cols: list[str] | None = None
) -> DataFrame:
    """Add ``rn`` (1-based position in time) and ``n`` (length of the series)."""
    keys = list(series_cols or [])
    return df.withColumns(
        {
            "rn": F.row_number().over(_series(keys, ts_col)).cast("bigint"),
            "n": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
        }
    )


def lookback(
    df: DataFrame,
    cols: list[str],
    length: int,
    ts_col: str = "DAYTIME",
    series_cols: list[str] | None = None,
) -> DataFrame:
    """Rows with ``length`` predecessors; ``frame`` holds those predecessors,
    oldest first, and the row's own columns are the next-step label."""
    before = _series(series_cols, ts_col).rowsBetween(-length, -1)
    framed = df.withColumn("frame", F.collect_list(F.array(*[F.col(c) for c in cols])).over(before))
    return framed.filter(F.size("frame") == length)


def lagged(
    df: DataFrame,
    cols: list[str],
    length: int,
    ts_col: str = "DAYTIME",
    series_cols: list[str] | None = None,
) -> DataFrame:
    """The look-back frame as flat columns ``<col>_lag<i>``, i = 1 the newest."""
    order = _series(series_cols, ts_col)
    names = {
        f"{c}_lag{i}": F.lag(c, i).over(order) for i in range(length, 0, -1) for c in cols
    }
    position = F.row_number().over(order)
    return df.withColumns({**names, "_pos": position}).filter(F.col("_pos") > length).drop("_pos")


def tail(
    df: DataFrame, length: int, ts_col: str = "DAYTIME", series_cols: list[str] | None = None
) -> DataFrame:
    """The last ``length`` rows of each series."""
    keys = list(series_cols or [])
    if not keys:
        return df.orderBy(F.col(ts_col).desc()).limit(length)
    newest = Window.partitionBy(*keys).orderBy(F.col(ts_col).desc())
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= length).drop("_rank")


def k_nearest(pairs: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The first ``k`` pairs of each group; limited on the map side as well."""
    ranked = Window.partitionBy(*by).orderBy(*order)
    return pairs.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)

"""Daily series: the production table reduced to one row per day (and series)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.functions.exact import mean, total
from derrick.functions.scalars import epoch_of_day
from derrick.schema import FLUIDS, READINGS


def daily_avg(df: DataFrame, series_cols: list[str] | None = None) -> DataFrame:
    """Mean volumes and readings per day; the day is given in epoch seconds."""
    keys = list(series_cols or [])
    volumes = [mean(column).alias(f"{fluid}_VOL") for fluid, column in FLUIDS.items()]
    readings = [mean(column).alias(column) for column in READINGS]
    daily = df.groupBy(*keys, "DAYTIME").agg(*volumes, *readings)
    return daily.withColumn("DAYTIME", epoch_of_day("DAYTIME"))


def daily_sum(df: DataFrame, series_cols: list[str] | None = None) -> DataFrame:
    """Total volumes per day."""
    keys = list(series_cols or [])
    return df.groupBy(*keys, "DAYTIME").agg(
        *[total(column).alias(f"{fluid}_VOL") for fluid, column in FLUIDS.items()]
    )


def last_date(df: DataFrame, ts_col: str = "DAYTIME") -> DataFrame:
    return df.agg(F.max(ts_col).alias("last_date"))

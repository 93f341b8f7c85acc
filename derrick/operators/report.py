"""Actual-against-predicted series, report table and its filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.operators.clean import resolve_alias

# Deviation limit, status words, units and column candidates per fluid.
DEVIATION_LIMIT = 80.0
STATUS_OFF, STATUS_OK, STATUS_ANY = "Check", "Normal", "all"
GAS_UNIT, LIQUID_UNIT = "mcf/d", "bbl/d"
FLUID_COLUMNS = {
    "OIL": (["BORE_OIL_VOL", "OIL_VOL_test"], ["OIL_VOL", "OIL_VOL_pred"]),
    "GAS": (["BORE_GAS_VOL", "GAS_VOL_test"], ["GAS_VOL", "GAS_VOL_pred"]),
    "WAT": (["BORE_WAT_VOL", "WAT_VOL_test"], ["WAT_VOL", "WAT_VOL_pred"]),
}


def resolve_fluids(df: DataFrame) -> dict[str, tuple[str, str]]:
    """Actual and predicted column of each fluid; a fluid that lacks one is left out."""
    found = {f: (resolve_alias(df, a), resolve_alias(df, p)) for f, (a, p) in FLUID_COLUMNS.items()}
    return {f: pair for f, pair in found.items() if all(pair)}


def deviation_status(actual: Column, predicted: Column, limit: float = DEVIATION_LIMIT) -> Column:
    return F.when(F.abs(actual - predicted) > F.lit(limit), F.lit(STATUS_OFF)).otherwise(F.lit(STATUS_OK))


def unit_label(fluid: Column) -> Column:
    return F.when(fluid == "GAS", F.lit(GAS_UNIT)).otherwise(F.lit(LIQUID_UNIT))


def report_table(predictions: DataFrame, series_cols: list[str] | None = None, limit: float = DEVIATION_LIMIT):
    """``[series..], model_type, DAYTIME, target, unit, actual, predicted, status``:
    one row per day, model and fluid."""
    keys = [*(series_cols or []), "model_type", "DAYTIME"]
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(fluid).alias("target"),
                    F.col(actual).cast("double").alias("actual"),
                    F.col(predicted).cast("double").alias("predicted"),
                )
                for fluid, (actual, predicted) in resolve_fluids(predictions).items()
            ]
        )
    )
    long = predictions.select(*keys, rows.alias("r")).select(*keys, "r.*")
    return long.select(
        *keys,
        "target",
        unit_label(F.col("target")).alias("unit"),
        "actual",
        "predicted",
        deviation_status(F.col("actual"), F.col("predicted"), limit).alias("status"),
    )


def range_filter(df: DataFrame, **bounds: tuple[object | None, object | None]) -> DataFrame:
    """Inclusive ranges per column; a bound that is None restricts nothing."""
    for column, (low, high) in bounds.items():
        if low is not None:
            df = df.filter(F.col(column) >= F.lit(low))
        if high is not None:
            df = df.filter(F.col(column) <= F.lit(high))
    return df


def status_filter(df: DataFrame, status: str = STATUS_ANY) -> DataFrame:
    return df if status == STATUS_ANY else df.filter(F.col("status") == status)


def select_equal(df: DataFrame, **values: object) -> DataFrame:
    """Keep rows equal to every given value; None selects all."""
    for column, value in values.items():
        if value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    return df


def filtered_report(
    predictions: DataFrame,
    dates: tuple[dt.date | None, dt.date | None] = (None, None),
    actual: tuple[float | None, float | None] = (None, None),
    predicted: tuple[float | None, float | None] = (None, None),
    status: str = STATUS_ANY,
    target: str | None = None,
    model_type: str | None = None,
    limit: float = DEVIATION_LIMIT,
) -> DataFrame:
    table = select_equal(report_table(predictions, limit=limit), target=target, model_type=model_type)
    ranged = range_filter(table, DAYTIME=dates, actual=actual, predicted=predicted)
    return status_filter(ranged, status)


def performance_series(predictions: DataFrame, model_name: str) -> DataFrame:
    """``model, DAYTIME, fluid, kind, value``: the lines of a performance chart."""
    points = [
        F.struct(F.lit(fluid).alias("fluid"), F.lit(kind).alias("kind"), F.col(c).cast("double").alias("value"))
        for fluid, pair in resolve_fluids(predictions).items()
        for kind, c in zip(("actual", "predicted"), pair)
    ]
    rows = predictions.select(F.to_date("DAYTIME").alias("DAYTIME"), F.explode(F.array(*points)).alias("p"))
    return rows.select(F.lit(model_name).alias("model"), "DAYTIME", "p.*")

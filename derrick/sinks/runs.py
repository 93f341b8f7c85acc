"""Run log: runs, metrics, hyper-parameters and predictions, appended."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.functions.scalars import new_id
from derrick.operators.metrics import Pairs, metrics_long, model_pairs
from derrick.schema import ML_PARAMS, ML_RUNS


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def create_run(spark: SparkSession, path: str, comment: str | None = None) -> str:
    """Append a run record; its id is made here, before any row is written."""
    run_id = new_id()
    append(spark.createDataFrame([(run_id, dt.datetime.now(dt.UTC).replace(tzinfo=None), comment)], ML_RUNS), path)
    return run_id


def metric_rows(run_id: str, predictions: DataFrame, pairs: Pairs | None = None) -> DataFrame:
    """``run_id, target, rmse, mae, r2``."""
    return metrics_long(predictions, pairs).select(F.lit(run_id).alias("run_id"), "target", "rmse", "mae", "r2")


def param_rows(spark: SparkSession, run_id: str, params: dict[str, dict[str, object]]) -> DataFrame:
    """``run_id, target, param, value``: the whole parameter map of every target."""
    rows = [(target, {k: str(v) for k, v in values.items()}) for target, values in params.items()]
    frame = spark.createDataFrame(rows, "target string, params map<string,string>")
    long = frame.select(F.lit(run_id).alias("run_id"), "target", F.explode("params").alias("param", "value"))
    return long.select(*ML_PARAMS.fieldNames())


def prediction_rows(
    run_id: str, predictions: DataFrame, pairs: Pairs | None = None, sample_type: str = "test"
) -> DataFrame:
    """``run_id, target, y_true, y_pred, sample_type, created_at``: a row per prediction."""
    pairs = pairs or model_pairs()
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(t).alias("target"),
                    F.col(actual).cast("double").alias("y_true"),
                    F.col(predicted).cast("double").alias("y_pred"),
                )
                for t, (actual, predicted) in pairs.items()
            ]
        )
    )
    return predictions.select(cells.alias("r")).select(
        F.lit(run_id).alias("run_id"),
        "r.*",
        F.lit(sample_type).alias("sample_type"),
        F.lit(dt.datetime.now(dt.UTC).replace(tzinfo=None)).alias("created_at"),
    )

"""Fitted models on shared storage, found by their id in ``model_params``."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from derrick.operators.forest_stage import ForestStage
from derrick.operators.models import Fitted
from derrick.sinks.upsert import read_table, upsert
from derrick.sources.tables import require_row


def save_model(spark: SparkSession, warehouse: str, fitted: Fitted) -> str:
    """Write the pipeline (scaling included) and its parameter row."""
    path = f"{warehouse}/models/{fitted.spec.model_type}_{fitted.id_model}"
    for stage in fitted.pipeline.stages:
        if isinstance(stage, ForestStage):
            stage.keep(spark, f"{path}_nodes")
    fitted.pipeline.write().overwrite().save(path)
    upsert(spark, warehouse, "model_params", fitted.params_row(spark, path))
    return path


def load_model(spark: SparkSession, warehouse: str, id_model: str) -> tuple[PipelineModel, dict[str, str]]:
    """The pipeline and the parameters of a model; an unknown id is an error."""
    row = require_row(read_table(spark, warehouse, "model_params"), id_model=id_model)
    return PipelineModel.load(row["model_path"]), row["params"]

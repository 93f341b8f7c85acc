"""Forecasts: persistence, recursive linear roll-forward, saved models."""

from __future__ import annotations

import json
from functools import reduce
from operator import add

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrick.functions.scalars import following_days
from derrick.operators.forest_stage import ForestStage
from derrick.operators.window import tail
from derrick.schema import MODEL_AI, MODEL_PF, TARGETS
from derrick.session import cut_lineage


def persistence(
    daily: DataFrame, id_model: str = "persistence", series_cols: list[str] | None = None
) -> DataFrame:
    """Yesterday's value as prediction, in the evaluation shape; the first day of
    a series has none and is left out."""
    keys = list(series_cols or [])
    order = Window.partitionBy(*keys).orderBy("DAYTIME")
    lagged = daily.withColumns({f"_p_{t}": F.lag(t).over(order) for t in TARGETS} | {"_rn": F.row_number().over(order)})
    rows = lagged.filter("_rn > 1").withColumns(
        {f"{t}_test": F.col(t) for t in TARGETS} | {f"{t}_pred": F.col(f"_p_{t}") for t in TARGETS}
    )
    tagged = rows.withColumns({"id_model": F.lit(id_model), "model_type": F.lit("PERSISTENCE")})
    return tagged.select(*keys, *MODEL_AI.fieldNames())


def recent_frame(
    daily: DataFrame, length: int, cols: list[str] = TARGETS, series_cols: list[str] | None = None
) -> DataFrame:
    """One row per series: ``last_day`` and ``frame``, the last ``length`` days as
    one flat array, oldest first. Series that are shorter are left out."""
    keys = list(series_cols or [])
    recent = tail(daily, length, "DAYTIME", keys)
    days = recent.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("DAYTIME", F.array(*[F.col(c).cast("double") for c in cols]).alias("v")))).alias("days")
    )
    return days.filter(F.size("days") == length).select(
        *keys,
        F.element_at("days", -1)["DAYTIME"].alias("last_day"),
        F.flatten(F.transform("days", lambda d: d["v"])).alias("frame"),
    )


def roll_linear(
    recent: DataFrame,
    weights: list[list[float]],
    intercepts: list[float],
    n_days: int,
    cols: list[str] = TARGETS,
    series_cols: list[str] | None = None,
) -> DataFrame:
    """Roll a linear one-step model forward ``n_days`` days.

    ``weights[j]`` weighs the flat frame for output column j. Each step appends
    its outputs and drops the oldest day; the recursion is one ``aggregate``
    over the days, so every series is a row and the whole forecast one stage.
    """
    keys = list(series_cols or [])
    width = len(cols)
    size = len(weights[0])

    def step(state, _day):
        start = F.size(state) - size
        outputs = []
        for w, b in zip(weights, intercepts):
            terms = [F.get(state, start + i) * F.lit(float(c)) for i, c in enumerate(w) if c != 0.0]
            outputs.append(reduce(add, terms, F.lit(float(b))))
        return F.concat(state, F.array(*outputs))

    rolled = F.aggregate(F.sequence(F.lit(1), F.lit(n_days)), F.col("frame"), step)
    days = following_days(F.col("last_day"), n_days)
    rows = recent.select(*keys, rolled.alias("values"), F.posexplode(days).alias("step", "DAYTIME"))
    return rows.select(
        *keys,
        "DAYTIME",
        *[F.get("values", F.col("step") * width + size + j).alias(c) for j, c in enumerate(cols)],
    )


def raw_weights(pipeline: PipelineModel, params: dict[str, str], targets: list[str] = TARGETS):
    """Weights and intercepts of a saved linear look-back model on the original
    scale, for ``roll_linear``; None if the model is of another kind."""
    models = [s for s in pipeline.stages if isinstance(s, LinearRegressionModel)]
    if len(models) != len(targets):
        return None
    scaler = json.loads(params["scaler"])
    bases = [f.rsplit("_lag", 1)[0] for f in json.loads(params["features"])]
    weights, intercepts = [], []
    for target, model in zip(targets, models):
        offset, spread = scaler[target]
        slopes = [c * spread / scaler[b][1] for c, b in zip(model.coefficients, bases)]
        weights.append(slopes)
        intercepts.append(offset + spread * model.intercept - sum(s * scaler[b][0] for s, b in zip(slopes, bases)))
    return weights, intercepts


def roll_model(
    recent: DataFrame,
    pipeline: PipelineModel,
    length: int,
    n_days: int,
    targets: list[str] = TARGETS,
    series_cols: list[str] | None = None,
    cut_every: int = 10,
) -> DataFrame:
    """Roll any look-back model forward: each step predicts one day for all
    series at once. The lineage is cut now and then, or it would grow by a
    model per day."""
    keys = list(series_cols or [])
    width = len(targets)
    names = [f"{t}_lag{i}" for i in range(length, 0, -1) for t in targets]
    state = recent.select(*keys, "last_day", "frame", F.expr("CAST(array() AS array<double>)").alias("values"))
    for day in range(1, n_days + 1):
        lags = state.withColumns({n: F.get("frame", F.lit(i)) for i, n in enumerate(names)})
        lags = lags.withColumns({t: F.lit(0.0) for t in targets})  # the scaling stage names the targets too
        outputs = F.array(*[F.col(f"{t}_pred") for t in targets])
        state = pipeline.transform(lags).select(
            *keys,
            "last_day",
            F.concat(F.slice("frame", width + 1, (length - 1) * width), outputs).alias("frame"),
            F.concat("values", outputs).alias("values"),
        )
        if day % cut_every == 0 and day < n_days:
            state = cut_lineage(state)
    rows = state.select(
        *keys, "values", F.posexplode(following_days(F.col("last_day"), n_days)).alias("step", "DAYTIME")
    )
    return rows.select(
        *keys, "DAYTIME", *[F.get("values", F.col("step") * width + j).alias(t) for j, t in enumerate(targets)]
    )


def roll_trees(
    recent: DataFrame,
    stage: ForestStage,
    params: dict[str, str],
    n_days: int,
    targets: list[str] = TARGETS,
    series_cols: list[str] | None = None,
) -> DataFrame:
    """Roll look-back trees forward ``n_days`` days in one pass: a task takes some series, and every day of
    all of them is one walk down the node arrays."""
    keys = list(series_cols or [])
    width = len(targets)
    scaler, cuts = json.loads(params["scaler"]), [np.array(c) for c in json.loads(stage.getOrDefault("cuts"))]
    # Features are named and ordered by the model; frames hold days oldest first.
    length = int(params["look_back"])
    places, offsets, spreads = [], [], []
    for name in json.loads(params["features"]):
        base, lag = name.rsplit("_lag", 1)
        places.append((length - int(lag)) * width + targets.index(base))
        offsets.append(scaler[base][0])
        spreads.append(scaler[base][1])
    offsets, spreads = np.array(offsets), np.array(spreads)
    back = np.array([scaler[t] for t in targets])
    forests = stage.on_tasks(recent.sparkSession)

    def roll(batches):
        for batch in batches:
            frame = np.array(batch["frame"].tolist(), np.float64).reshape(len(batch), -1)
            days = []
            for _ in range(n_days):
                z = (frame[:, places] - offsets) / spreads
                bins = np.column_stack([np.searchsorted(c, z[:, i], "left") for i, c in enumerate(cuts)])
                value = np.column_stack([f(bins) for f in forests()]) * back[:, 1] + back[:, 0]
                days.append(value)
                frame = np.concatenate([frame[:, width:], value], axis=1)
            yield batch[[*keys, "last_day"]].assign(values=list(np.concatenate(days, axis=1)) if len(batch) else [])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in recent.select(*keys, "last_day").schema.fields)
    rolled = recent.select(*keys, "last_day", "frame").mapInPandas(roll, f"{kinds}, values array<double>")
    rows = rolled.select(*keys, "values", F.posexplode(following_days(F.col("last_day"), n_days)).alias("step", "DAYTIME"))
    return rows.select(*keys, "DAYTIME", *[F.get("values", F.col("step") * width + j).alias(t) for j, t in enumerate(targets)])


def forecast_saved(
    pipeline: PipelineModel, id_model: str, params: dict[str, str], sums: DataFrame, n_days: int
) -> DataFrame:
    """Forecast ``n_days`` days after the daily sums with a saved look-back model."""
    length = int(params["look_back"])
    if not length:
        raise ValueError(f"model {id_model} needs the readings of the day and cannot be rolled forward")
    recent = recent_frame(sums, length)
    linear = raw_weights(pipeline, params)
    trees = next((s for s in pipeline.stages if isinstance(s, ForestStage)), None)
    if linear:
        rows = roll_linear(recent, *linear, n_days)
    elif trees:
        rows = roll_trees(recent, trees, params, n_days)
    else:
        rows = roll_model(recent, pipeline, length, n_days)
    tagged = rows.withColumns({"id_model": F.lit(id_model), "model_type": F.lit(params["model_type"] + "_FORECAST")})
    return tagged.select(*MODEL_PF.fieldNames())

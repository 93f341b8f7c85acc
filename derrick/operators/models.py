"""Training: time-ordered search over Spark ML estimators, one model per target.

A model is one persisted ``PipelineModel``: scaling by the statistics of the fit,
feature vector, an estimator per target, predictions on the original scale.
"""

from __future__ import annotations

import datetime as dt
import itertools
import json
import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derrick.functions.scalars import date_part, from_epoch, new_id
from derrick.operators import boosting, forest, gram, metrics
from derrick.operators.aggregate import daily_avg, daily_sum
from derrick.operators.clean import feature_columns
from derrick.operators.forest_stage import ForestStage
from derrick.operators.impute import knn_impute
from derrick.operators.scale import minmax_stats, standard_stats
from derrick.operators.split import fold_parts, split_by_head, split_by_share, with_folds
from derrick.operators.window import lagged
from derrick.schema import MODEL_AI, MODEL_PARAMS, READINGS, TARGETS
from derrick.session import cut_lineage, shared_folder

SEED = 42
SEARCH_DRAWS = 5
FOLDS = 3
PARALLEL_FITS = 4


@dataclass(frozen=True)
class ModelSpec:
    """A family of models: how to build one and which parameters to try."""

    name: str
    model_type: str
    algo: str
    build: Callable[..., Estimator | dict]
    grid: dict[str, list]
    lookback: int | None = None
    scaling: str = "standard"
    shared: bool = False  # all fits of a search in the same passes (``operators.forest``)
    from_sums: bool = False  # all errors of a search from one pass (``operators.gram``)


# The parameter grids. Spark limits trees to depth 30, which
# stands for "no limit".
LINEAR_GRID = {"fitIntercept": [True, False]}
FOREST_GRID = {
    "numTrees": [200, 400],
    "maxDepth": [30, 10, 20],
    "minInstancesPerNode": [1, 2, 5],
    "featureSubsetStrategy": ["sqrt", "0.5"],
}
BOOSTED_GRID = {
    "maxIter": [200, 400, 600],
    "maxDepth": [3, 5, 7],
    "stepSize": [0.01, 0.05, 0.1],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "all"],
}


def _linear(**params) -> Estimator:
    return LinearRegression(solver="normal", regParam=0.0, **params)


def _forest(numTrees, maxDepth, minInstancesPerNode, featureSubsetStrategy, bootstrap=True) -> dict:
    """Parameters of the shared trainer; the share of features is rounded up."""
    share = (lambda n: n**0.5) if featureSubsetStrategy == "sqrt" else (lambda n: n * float(featureSubsetStrategy))
    return {"trees": numTrees, "depth": maxDepth, "least": minInstancesPerNode, "features": lambda n: math.ceil(share(n)), "bootstrap": bootstrap}


def _rounds(maxIter, maxDepth, stepSize, subsamplingRate=1.0, featureSubsetStrategy="all", minInstancesPerNode=1) -> dict:
    """Parameters of the shared booster: its bag of columns is drawn for each tree."""
    share = 1.0 if featureSubsetStrategy == "all" else float(featureSubsetStrategy)
    return {"trees": maxIter, "depth": maxDepth, "least": minInstancesPerNode, "features": lambda n: math.ceil(share * n), "step": stepSize, "rate": subsamplingRate}


def _boosted(**params) -> Estimator:
    return GBTRegressor(lossType="squared", seed=SEED, **params)


MODELS = {
    spec.name: spec
    for spec in (
        ModelSpec("linear", "LR", "LinearRegression", _linear, LINEAR_GRID, from_sums=True),
        ModelSpec("forest", "RF", "RF_MultiOutput", _forest, FOREST_GRID, shared=True),
        ModelSpec("boosted", "GBT", "BoostedTrees", _rounds, BOOSTED_GRID, shared=True),
        ModelSpec("lookback20", "LB20", "LookbackLinear20", _linear, LINEAR_GRID, 20, "minmax", from_sums=True),
        ModelSpec("lookback30", "LB30", "LookbackLinear30", _linear, LINEAR_GRID, 30, "standard", from_sums=True),
    )
}


@dataclass
class Fitted:
    """A trained model with what the tables need of it."""

    id_model: str
    spec: ModelSpec
    params: dict[str, str]
    metrics: dict[str, float]
    pipeline: PipelineModel
    predictions: DataFrame
    trials: list[dict] = field(default_factory=list)

    def params_row(self, spark: SparkSession, model_path: str | None) -> DataFrame:
        row = (self.id_model, self.spec.algo, dt.datetime.now(dt.UTC).replace(tzinfo=None), self.params, self.metrics, model_path)
        return spark.createDataFrame([row], MODEL_PARAMS)


def draw_params(grid: dict[str, list], draws: int = SEARCH_DRAWS, seed: int = SEED) -> list[dict]:
    """Distinct combinations of a grid, all of them if it is small."""
    combinations = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    if len(combinations) <= draws:
        return combinations
    return random.Random(seed).sample(combinations, draws)


def scaling_stats(df: DataFrame, cols: list[str], scaling: str) -> dict[str, tuple[float, float]]:
    """Offset and divisor of every column, as numbers: a single row."""
    if scaling == "standard":
        row = standard_stats(df, cols).first()
        pairs = {c: (row[f"{c}_mean"], row[f"{c}_std"]) for c in cols}
    else:
        row = minmax_stats(df, cols).first()
        pairs = {c: (row[f"{c}_min"], row[f"{c}_max"] - row[f"{c}_min"]) for c in cols}
    return {c: (float(offset), float(spread) or 1.0) for c, (offset, spread) in pairs.items()}


def _scaled(column: str) -> str:
    return f"{column}__z"


def _scale_stage(bases: dict[str, str], stats: dict[str, tuple[float, float]]) -> SQLTransformer:
    """``bases`` names the column whose statistics scale each input column."""
    terms = [
        f"(CAST(`{c}` AS DOUBLE) - {stats[b][0]!r}D) / {stats[b][1]!r}D AS `{_scaled(c)}`" for c, b in bases.items()
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def _inverse_stage(targets: list[str], stats: dict[str, tuple[float, float]]) -> SQLTransformer:
    terms = [f"`{_scaled(t)}_pred` * {stats[t][1]!r}D + {stats[t][0]!r}D AS `{t}_pred`" for t in targets]
    return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def fit_targets(spec: ModelSpec, params: dict, train: DataFrame, targets: list[str]) -> list:
    """An independent model per target with the same parameters."""
    return [
        spec.build(
            featuresCol="features", labelCol=_scaled(t), predictionCol=f"{_scaled(t)}_pred", **params
        ).fit(train)
        for t in targets
    ]


def _scaled_pairs(targets: list[str]) -> metrics.Pairs:
    return {t.removesuffix("_VOL"): (_scaled(t), f"{_scaled(t)}_pred") for t in targets}


def _apply(models: list, frame: DataFrame) -> DataFrame:
    for model in models:
        frame = model.transform(frame)
    return frame


def cv_scores(
    spec: ModelSpec, folds: DataFrame, candidates: list[dict], targets: list[str], k: int = FOLDS
) -> list[dict]:
    """Error of every candidate on every fold. The fits are independent jobs and
    share the cluster from a few driver threads."""
    parts = [fold_parts(folds, i) for i in range(k)]

    def score(task: tuple[int, int]) -> dict:
        candidate, fold = task
        train, test = parts[fold]
        models = fit_targets(spec, candidates[candidate], train, targets)
        error = metrics.mse_global(_apply(models, test), _scaled_pairs(targets)).first()["mse_global"]
        return {"candidate": candidate, "fold": fold, "mse": float(error)}

    tasks = list(itertools.product(range(len(candidates)), range(k)))
    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return list(pool.map(score, tasks))


def _fits(spec: ModelSpec, candidates: dict[int, dict], folds: list[int], targets: list[str], n_features: int, **more) -> list[forest.Fit]:
    found = []
    for (number, params), fold, target in itertools.product(candidates.items(), folds, range(len(targets))):
        built = spec.build(**params)
        found.append(forest.Fit(number, fold, target, **(built | {"features": built["features"](n_features)}), **more))
    return found


def binned_rows(folds: DataFrame, held: DataFrame, inputs: list[str], targets: list[str], k: int = FOLDS) -> tuple[DataFrame, list[list[float]]]:
    """Rows of the shared trainer, and the cut points: training rows with their fold as block, held-out ones as block ``k``."""
    cuts = forest.bin_cuts(folds, inputs)
    columns = [F.unix_date("DAYTIME").cast("long").alias("row"), *inputs, F.array(*[F.col(_scaled(t)) for t in targets]).alias("y")]
    blocks = folds.select(*columns, F.coalesce("test_fold", F.lit(-1)).cast("int").alias("block"))
    both = blocks.unionByName(held.select(*columns, F.lit(k).alias("block")))
    return cut_lineage(forest.with_bins(both, inputs, cuts).select("row", "bins", "y", "block")), cuts


def shared_scores(rows: DataFrame, spec: ModelSpec, candidates: list[dict], targets: list[str], n_features: int, k: int = FOLDS) -> list[dict]:
    """Error of every candidate on every fold, from forests grown in the same passes."""
    fits = _fits(spec, dict(enumerate(candidates)), list(range(k)), targets, n_features)
    grow = boosting.grow if fits[0].step else forest.grow
    found = grow(rows, fits, n_features)[0]
    target = F.element_at(F.array(*[F.lit(f.target) for f in fits]), F.col("fit") + 1)
    error = found.join(rows.select("row", "y"), "row").groupBy("fit").agg(F.avg((F.get("y", target) - F.col("prediction")) ** 2).alias("mse"))
    mse = {r["fit"]: r["mse"] for r in error.collect()}
    trials = []
    for candidate, fold in itertools.product(range(len(candidates)), range(k)):
        own = [mse[i] for i, f in enumerate(fits) if (f.candidate, f.fold) == (candidate, fold)]
        trials.append({"candidate": candidate, "fold": fold, "mse": float(sum(own) / len(own))})
    return trials


def shared_model(rows: DataFrame, cuts: list[list[float]], spec: ModelSpec, params: dict, inputs: list[str], targets: list[str], k: int = FOLDS) -> ForestStage:
    """The trees of all targets on all training rows, as a stage."""
    fits = _fits(spec, {0: params}, [k], targets, len(inputs), keep_nodes=True)
    given = {"inputCols": inputs, "outputCols": [f"{_scaled(t)}_pred" for t in targets], "cuts": json.dumps(cuts)}
    if fits[0].step:
        _, nodes, given["bases"] = boosting.grow(rows, fits, len(inputs))
    else:
        _, nodes = forest.grow(rows, fits, len(inputs))
    path = f"{shared_folder(rows.sparkSession)}/derrick-{new_id()}"
    nodes.write.parquet(path)
    return ForestStage(**given, nodesPath=path)


def best_candidate(trials: list[dict]) -> tuple[int, float]:
    """Candidate with the smallest mean error over the folds; the first of equals."""
    errors: dict[int, list[float]] = {}
    for trial in trials:
        errors.setdefault(trial["candidate"], []).append(trial["mse"])
    mean, chosen = min((sum(e) / len(e), candidate) for candidate, e in errors.items())
    return chosen, mean


def train_frame(
    spec: ModelSpec,
    frame: DataFrame,
    features: dict[str, str],
    targets: list[str],
    draws: int = SEARCH_DRAWS,
    fit_on: str = "train",
    grid: dict[str, list] | None = None,
) -> Fitted:
    """Search, refit and evaluate on a split frame.

    ``frame`` holds DAYTIME (date), the features, the targets and ``is_test``.
    ``features`` maps a feature to the column that scales it. ``fit_on`` says
    which rows the scaling statistics come from.
    """
    spark = frame.sparkSession
    id_model = new_id()
    frame = frame.persist()
    source = frame if fit_on == "all" else frame.filter(~F.col("is_test"))
    stats = scaling_stats(source, list(dict.fromkeys([*features.values(), *targets])), spec.scaling)
    scale = _scale_stage({**features, **{t: t for t in targets}}, stats)
    assemble = VectorAssembler(inputCols=[_scaled(c) for c in features], outputCol="features")
    folds = with_folds(assemble.transform(scale.transform(frame.filter(~F.col("is_test")))).drop("rn", "n"), FOLDS)
    folds = folds.persist()
    candidates = draw_params(grid or spec.grid, draws)
    if spec.shared:
        inputs = [_scaled(c) for c in features]
        rows, cuts = binned_rows(folds, scale.transform(frame.filter("is_test")), inputs, targets)
        trials = shared_scores(rows, spec, candidates, targets, len(inputs))
        chosen, error = best_candidate(trials)
        models = [shared_model(rows, cuts, spec, candidates[chosen], inputs, targets)]
    else:
        if spec.from_sums:
            trials = gram.cv_scores(folds, candidates, [_scaled(c) for c in features], [_scaled(t) for t in targets], FOLDS)
        else:
            trials = cv_scores(spec, folds, candidates, targets)
        chosen, error = best_candidate(trials)
        models = fit_targets(spec, candidates[chosen], folds, targets)
    pipeline = PipelineModel([scale, assemble, *models, _inverse_stage(targets, stats)])
    scored = cut_lineage(
        pipeline.transform(frame.filter("is_test")).drop("features", *[c for c in features if c not in targets])
    )
    folds.unpersist()
    frame.unpersist()
    measured = metrics.evaluate(scored, _scaled_pairs(targets), ("mse", "r2")).first().asDict()
    params = {k: str(v) for k, v in candidates[chosen].items()}
    params |= {
        "seed": str(SEED),
        "scaling": spec.scaling,
        "scaler": json.dumps({c: list(v) for c, v in stats.items()}),
        "features": json.dumps(list(features)),
        "model_type": spec.model_type,
        "look_back": str(spec.lookback or 0),
    }
    predictions = scored.select(
        F.lit(id_model).alias("id_model"),
        F.lit(spec.model_type).alias("model_type"),
        "DAYTIME",
        *[F.col(t).alias(f"{t}_test") for t in targets],
        *[f"{t}_pred" for t in targets],
    ).select(*MODEL_AI.fieldNames())
    found = {k: float(v) for k, v in measured.items() if v is not None} | {"cv_mse": float(error)}
    return Fitted(id_model, spec, params, found, pipeline, predictions, trials)


def train_daily(
    daily: DataFrame, spec: ModelSpec, draws: int = SEARCH_DRAWS, fit_on: str = "train", grid=None
) -> Fitted:
    """Train on the daily means: gaps filled, the day and the readings as features."""
    split = cut_lineage(split_by_share(daily))  # a row per day, read many times below
    known = None if fit_on == "all" else ~F.col("is_test")
    filled = knn_impute(split, ["DAYTIME", *TARGETS, *READINGS], ["rn"], donors=known)
    named = filled.withColumns(
        {"EPOCH": F.col("DAYTIME").cast("double"), "DAYTIME": date_part(from_epoch(F.col("DAYTIME").cast("bigint")))}
    )
    features = feature_columns(named, TARGETS, ("DAYTIME", "rn", "n", "is_test"))
    # A reading that is empty throughout has nothing to scale or to learn from.
    filled_in = named.agg(*[F.count(c).alias(c) for c in features]).first()
    features = [c for c in features if filled_in[c]]
    return train_frame(spec, named, {f: f for f in features}, TARGETS, draws, fit_on, grid)


def lag_names(length: int, targets: list[str] = TARGETS) -> dict[str, str]:
    """Lag columns, oldest day first, and the target that scales each."""
    return {f"{t}_lag{i}": t for i in range(length, 0, -1) for t in targets}


def train_lookback(
    sums: DataFrame, spec: ModelSpec, draws: int = SEARCH_DRAWS, fit_on: str = "train", grid=None
) -> Fitted:
    """Train on look-back frames of the daily sums to predict the next day."""
    frames = split_by_head(lagged(sums, TARGETS, spec.lookback))
    return train_frame(spec, frames, lag_names(spec.lookback), TARGETS, draws, fit_on, grid)


@dataclass(frozen=True)
class DaySeries:
    """The daily means and sums that all families train on."""

    means: DataFrame
    sums: DataFrame

    @classmethod
    def of(cls, production: DataFrame) -> DaySeries:
        """Both series written once, to be shared by several families."""
        return cls(cut_lineage(daily_avg(production)), cut_lineage(daily_sum(production)))


def train(
    production: DataFrame | DaySeries,
    spec: ModelSpec,
    draws: int = SEARCH_DRAWS,
    fit_on: str = "train",
    grid=None,
) -> Fitted:
    """Train a model family on the production table or on its daily series."""
    days = production if isinstance(production, DaySeries) else DaySeries(daily_avg(production), daily_sum(production))
    if spec.lookback:
        return train_lookback(days.sums, spec, draws, fit_on, grid)
    return train_daily(days.means, spec, draws, fit_on, grid)

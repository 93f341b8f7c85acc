"""Linear fits from sums of products.

One pass sums the outer products of (1, features, targets) per block of a series.
The training rows of every fold are sums of blocks, and so are the errors on its
test block, so a search over folds and candidates is small systems and needs no
further pass. With series keys every series is a row of its own and its systems
are solved in the tasks; without them only a matrix per block reaches the driver.

A candidate is ``{"fitIntercept": bool, "regParam": float}`` and minimises
half the mean squared error plus ``regParam / 2`` times the squared weights; the
intercept is free. Where the features don't determine the weights, the smallest
ones are taken. Values should be scaled: errors are differences of sums of
squares. Rows with a null or NaN in a feature or target are left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT = 1e-12  # errors below this share of the targets' squares are rounding and count as none
SINGULAR = 1e-12  # directions with a smaller share of the largest spread have no weight


def block_grams(rows: DataFrame, features: list[str], targets: list[str], block: str, series_cols: list[str] | None = None) -> DataFrame:
    """Series keys, ``block`` and ``gram``: the sum of outer products of (1, features, targets), row by row as a flat array.

    Batches are reduced in the tasks, so what is shuffled is a matrix per batch and block."""
    keys = [*(series_cols or []), block]
    values = [F.col(c).cast("double") for c in (*features, *targets)]
    known = rows.select(*keys, F.array(F.lit(1.0), *values).alias("z")).filter(~F.exists("z", lambda v: v.isNull() | F.isnan(v)))

    def partial(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            group = batch.groupby(keys, dropna=False, sort=False)
            of = group.ngroup().to_numpy()
            order = np.argsort(of, kind="stable")
            firsts = np.flatnonzero(np.append(True, np.diff(of[order]) != 0))
            z = np.array(batch["z"].tolist())[order]
            sums = [(own.T @ own).ravel() for own in np.split(z, firsts[1:])]
            yield batch.iloc[order[firsts]][keys].assign(gram=sums)

    schema = T.StructType([*known.select(*keys).schema.fields, T.StructField("gram", T.ArrayType(T.DoubleType()))])
    sums = known.mapInPandas(partial, schema).groupBy(*keys).agg(Summarizer.sum(array_to_vector("gram")).alias("gram"))
    return sums.withColumn("gram", vector_to_array("gram"))


def solve(gram: np.ndarray, n_features: int, fitIntercept: bool = True, regParam: float = 0.0) -> np.ndarray:
    """Intercept and weights (rows) of every target (columns)."""
    p = n_features + 1
    n, xx, xy = gram[0, 0], gram[1:p, 1:p], gram[1:p, p:]
    out = np.zeros((p, gram.shape[0] - p))
    if not n:
        return out
    if fitIntercept:
        xx, xy = xx - np.outer(gram[1:p, 0], gram[0, 1:p]) / n, xy - np.outer(gram[1:p, 0], gram[0, p:]) / n
    spread, axes = np.linalg.eigh(xx / n)
    spread = np.maximum(spread, 0.0)
    usable = spread > SINGULAR * spread.max(initial=0.0)
    inverse = np.where(usable, 1 / np.where(usable, spread + regParam, 1), 0.0)
    out[1:] = axes @ (inverse[:, None] * (axes.T @ (xy / n)))
    if fitIntercept:
        out[0] = (gram[0, p:] - gram[0, 1:p] @ out[1:]) / n
    return out


def mean_error(gram: np.ndarray, weights: np.ndarray) -> float:
    """Mean squared error over rows and targets of the weights on the rows of a sum."""
    if not gram[0, 0]:
        return float("nan")
    misses = np.vstack([weights, -np.eye(weights.shape[1])])
    total = np.einsum("it,ij,jt->", misses, gram, misses)
    whole = np.trace(gram[len(weights) :, len(weights) :])
    return float((total if total > EXACT * whole else 0.0) / gram[0, 0] / weights.shape[1])


def fold_errors(blocks: dict[int, np.ndarray], n_features: int, candidates: list[dict], k: int) -> list[dict]:
    """Error of every candidate on every fold; block ``-1`` and those before a fold train it. Folds without rows have no entry."""
    trials = []
    for number, candidate in enumerate(candidates):
        for fold in range(k):
            train = [gram for block, gram in blocks.items() if block < fold]
            if train and fold in blocks:
                weights = solve(sum(train), n_features, **candidate)
                trials.append({"candidate": number, "fold": fold, "mse": mean_error(blocks[fold], weights)})
    return trials


def cv_scores(folds: DataFrame, candidates: list[dict], features: list[str], targets: list[str], k: int) -> list[dict]:
    """Error of every candidate on every fold of one series, from one pass over ``folds`` (of ``with_folds``)."""
    rows = folds.withColumn("block", F.coalesce("test_fold", F.lit(-1)))
    d = 1 + len(features) + len(targets)
    blocks = {r["block"]: np.array(r["gram"]).reshape(d, d) for r in block_grams(rows, features, targets, "block").collect()}
    return fold_errors(dict(sorted(blocks.items())), len(features), candidates, k)


def fit_series(
    folds: DataFrame, candidates: list[dict], features: list[str], targets: list[str], series_cols: list[str], k: int
) -> DataFrame:
    """The best candidate of every series and its fit on all rows of the series: keys, ``n_rows``, ``candidate``, ``cv_mse``,
    and per target ``<t>_intercept`` and ``<t>_weights``. A series without a fold that has training and test rows takes the
    first candidate and has no ``cv_mse``. The blocks of a series are at most ``k + 1`` rows."""
    rows = folds.withColumn("block", F.coalesce("test_fold", F.lit(-1)))
    sums = block_grams(rows, features, targets, "block", series_cols)
    own = sums.groupBy(*series_cols).agg(F.array_sort(F.collect_list(F.struct("block", "gram"))).alias("blocks"))
    own = own.select(*series_cols, F.transform("blocks", lambda b: b["block"]).alias("blocks"), F.transform("blocks", lambda b: b["gram"]).alias("grams"))
    p, d = len(features), 1 + len(features) + len(targets)

    def fit(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for numbers, grams in zip(batch["blocks"], batch["grams"], strict=True):
                blocks = {int(b): np.array(g).reshape(d, d) for b, g in zip(numbers, grams, strict=True)}
                errors: dict[int, list[float]] = {}
                for trial in fold_errors(blocks, p, candidates, k):
                    errors.setdefault(trial["candidate"], []).append(trial["mse"])
                mse, chosen = min(((sum(e) / len(e), c) for c, e in errors.items()), default=(None, 0))
                whole = sum(blocks.values())
                weights = solve(whole, p, **candidates[chosen])
                fits = [x for j in range(len(targets)) for x in (weights[0, j], weights[1:, j])]
                found.append((int(whole[0, 0]), chosen, mse, *fits))
            columns = pd.DataFrame(found, columns=names, index=batch.index)
            yield pd.concat([batch[series_cols], columns], axis=1)

    names = ["n_rows", "candidate", "cv_mse", *[f"{t}_{part}" for t in targets for part in ("intercept", "weights")]]
    kinds = ["n_rows long", "candidate int", "cv_mse double", *[x for t in targets for x in (f"`{t}_intercept` double", f"`{t}_weights` array<double>")]]
    keys = [f"`{f.name}` {f.dataType.simpleString()}" for f in own.select(*series_cols).schema.fields]
    return own.mapInPandas(fit, ", ".join([*keys, *kinds]))

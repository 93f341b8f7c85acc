"""A grown forest as a pipeline stage: bins, flat node arrays, one prediction column per target."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from derrick.operators.forest import with_bins

MOST_NODES = 50_000_000  # some 1 GB; a forest of more nodes isn't sent to tasks


def flat(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """Nodes of one forest in arrays: feature (-1: leaf), bin, value, place of the left child, and the roots."""
    nodes = nodes.sort_values(["tree", "node"], kind="stable")
    tree, node = nodes.tree.to_numpy(np.int64), nodes.node.to_numpy(np.int64)
    key = (tree << 32) | node
    left = np.searchsorted(key, (tree << 32) | 2 * node)
    return {
        "feature": nodes.feature.to_numpy(np.int16),
        "bin": nodes.bin.to_numpy(np.int16),
        "value": nodes.value.to_numpy(np.float64),
        "left": left.astype(np.int32),
        "roots": np.flatnonzero(node == 1),
    }


def predict(forest: dict[str, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """Mean over the trees for each row of bins. Siblings stand side by side, as nodes are sorted."""
    at = np.tile(forest["roots"], (len(bins), 1))
    line = np.arange(len(bins))[:, None]
    while True:
        feature = forest["feature"][at]
        inner = feature >= 0
        if not inner.any():
            return forest["value"][at].mean(axis=1)
        right = bins[line, np.maximum(feature, 0)] > forest["bin"][at]
        at = np.where(inner, forest["left"][at] + right, at)


class ForestStage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Forests of several targets on the same binned features. The nodes lie in a parquet table, which ``keep`` moves to the model's folder."""

    inputCols = Param(Params._dummy(), "inputCols", "features in the order of their numbers", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "a prediction column per target", TypeConverters.toListString)
    cuts = Param(Params._dummy(), "cuts", "cut points of the features, as JSON", TypeConverters.toString)
    bases = Param(Params._dummy(), "bases", "of boosted trees: what the trees' sum is added to, per target; empty: the trees' mean", TypeConverters.toListFloat)
    nodesPath = Param(Params._dummy(), "nodesPath", "table of the nodes", TypeConverters.toString)

    def __init__(self, **given) -> None:
        super().__init__()
        self._setDefault(bases=[])
        self._set(**given)

    def keep(self, spark, path: str) -> None:
        spark.read.parquet(self.getOrDefault("nodesPath")).write.mode("overwrite").parquet(path)
        self._set(nodesPath=path)

    def on_tasks(self, spark):
        """What a task calls to get a function per target, from rows of bins to predictions."""
        table = spark.read.parquet(self.getOrDefault("nodesPath"))
        n_nodes = table.count()
        if n_nodes > MOST_NODES:
            raise ValueError(f"a forest of {n_nodes} nodes is too large to be sent to tasks")
        nodes = table.toPandas()
        bases = self.getOrDefault("bases")
        sent = spark.sparkContext.broadcast([flat(nodes[nodes.fit == i]) for i in range(len(self.getOrDefault("outputCols")))])

        def functions():
            one = lambda i, f: lambda bins: bases[i] + len(f["roots"]) * predict(f, bins) if bases else predict(f, bins)
            return [one(i, f) for i, f in enumerate(sent.value)]

        return functions

    def _transform(self, dataset: DataFrame) -> DataFrame:
        forests = self.on_tasks(dataset.sparkSession)

        @pandas_udf("array<double>")
        def all_targets(bins: pd.Series) -> pd.Series:
            if not len(bins):
                return pd.Series([], dtype=object)
            rows = np.frombuffer(b"".join(bins), np.uint8).reshape(len(bins), -1)
            return pd.Series(list(np.column_stack([f(rows) for f in forests()])))

        binned = with_bins(dataset, self.getOrDefault("inputCols"), json.loads(self.getOrDefault("cuts")))
        found = binned.withColumn("_found", all_targets("bins")).drop("bins")
        return found.withColumns({c: F.get("_found", F.lit(i)) for i, c in enumerate(self.getOrDefault("outputCols"))}).drop("_found")

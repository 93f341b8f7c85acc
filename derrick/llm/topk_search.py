"""Exact top-k inner-product search by a three-phase uniform threshold.

Components become ``floor(1024 * x)``; a vector's dimensions are dealt into ``SLICES``
slices, and a score is the sum of its slices' partial scores.

1. Every block of candidates makes a list of the ``k`` best partial scores of each
   slice and query, and resolves these entries; a query's k-th best over all blocks is its cutoff.
2. The cutoff goes back to the query's rows. An entry whose total reaches the cutoff has at least one partial
   score of cutoff / slices, so a block collects the entries with such a partial score: none can be missed.
3. The collected entries' scores are resolved exactly, and the best ``k`` that reach the cutoff are ranked.

Queries meet candidates block by block: both sides carry the pair of blocks as
key, so that a task holds one block of each. Nothing is broadcast.

Cases: vectors that are null, or hold null or non-finite components, and rows
without id take no part; vectors of different length aren't compared (their product isn't
defined); ties go to the smaller id; a row whose id equals the query's is the query's own;
repeated rows are candidates of their own, and repeated query rows are one query; components and
scores beyond 64 bits are held at the largest long. Only vec_id and embedding are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrick.session import cut_lineage

K = 10
SCALE = 1024
EVERY = 100  # rows whose id is divisible by it are queries
SLICES = 4
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 8192
ROWS_AT_ONCE = 256
_LARGEST = np.iinfo(np.int64).max


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` and ``b``."""
    bound = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(1, a.shape[1])
    if bound < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if bound < 2**62:
        return a @ b.T
    wide = a.astype(object) @ b.astype(object).T
    return np.clip(wide, -_LARGEST, _LARGEST).astype(np.int64)


def _partials(q: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    cuts = np.linspace(0, q.shape[1], SLICES + 1).astype(int)
    return [_product(q[:, a:b], c[:, a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), np.int64).reshape(len(rows), -1)


def _total(partials: list[np.ndarray], q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The sum of the slices, or the whole product where a sum could leave 64 bits."""
    if any(np.abs(p).max(initial=0) >= 2**60 for p in partials):
        return _product(q, c)
    return np.sum(partials, axis=0)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of the ``k`` largest of each row (in no order)."""
    if scores.shape[1] <= k:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    return np.argpartition(scores, scores.shape[1] - k, axis=1)[:, -k:]


def _local_lists(k: int):
    """Phase 1: per query the exact scores of the entries that lead a slice."""

    def lists(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(candidates) and len(queries):
            c, ids = _matrix(candidates.comps), candidates.vec_id.to_numpy()
            for at in range(0, len(queries), ROWS_AT_ONCE):
                some = queries.iloc[at : at + ROWS_AT_ONCE]
                q = _matrix(some.comps)
                partials = _partials(q, c)
                total = _total(partials, q, c)
                line = np.arange(len(some))[:, None]
                own = some.vec_id.to_numpy()[:, None] == ids[None, :]
                seen = np.zeros(total.shape, bool)
                for p in partials:
                    p = np.where(own, -_LARGEST, p)
                    seen[line, _best(p, k)] = True
                row, column = np.nonzero(seen & ~own)
                parts.append(pd.DataFrame({"query_id": some.vec_id.to_numpy()[row], "dim": q.shape[1], "score": total[row, column]}))
        return pd.concat(parts) if parts else pd.DataFrame({"query_id": [], "dim": [], "score": []}).astype("int64")

    return lists


def _collected(k: int):
    """Phases 2 and 3: the entries that pass the uniform threshold, resolved, and the best of a block."""

    def collect(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(candidates) and len(queries):
            candidates = candidates.sort_values("vec_id", kind="stable")
            c, ids = _matrix(candidates.comps), candidates.vec_id.to_numpy()
            for at in range(0, len(queries), ROWS_AT_ONCE):
                some = queries.iloc[at : at + ROWS_AT_ONCE]
                q = _matrix(some.comps)
                cutoff, all_suffice = some.cutoff.to_numpy(np.int64)[:, None], ~some.has_cutoff.to_numpy(bool)[:, None]
                partials = _partials(q, c)
                least = -(-cutoff // SLICES) - 1  # rounded to the safe side
                sufficient = np.repeat(all_suffice, len(ids), 1)
                for p in partials:
                    sufficient |= p >= least
                sufficient &= some.vec_id.to_numpy()[:, None] != ids[None, :]
                total = _total(partials, q, c)
                row, column = np.nonzero(sufficient & (all_suffice | (total >= cutoff)))
                found = pd.DataFrame({"query_id": some.vec_id.to_numpy()[row], "dim": q.shape[1], "vec_id": ids[column], "score": total[row, column]})
                found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True], kind="stable")
                parts.append(found.groupby("query_id").head(k))
        return pd.concat(parts) if parts else pd.DataFrame({"query_id": [], "dim": [], "vec_id": [], "score": []}).astype("int64")

    return collect


def search(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best candidates of every query."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    comps = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    rows = cut_lineage(valid.select("vec_id", comps.alias("comps"), F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("row")))
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "dim").agg(F.min_by("comps", "row").alias("comps"))
    asked = cut_lineage(asked)

    n_queries = asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("nq"))
    sizes = cut_lineage(rows.groupBy("dim").agg(F.ceil(F.count("*") / CANDIDATE_BLOCK).alias("nc")).join(n_queries, "dim"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    candidates = rows.join(sizes, "dim").select("dim", "vec_id", "comps", F.pmod(F.xxhash64("row"), F.col("nc")).alias("c"), upto("nq").alias("q"))

    def blocks(queries: DataFrame) -> DataFrame:
        return queries.join(sizes, "dim").select(*queries.columns, F.pmod(F.xxhash64("vec_id"), F.col("nq")).alias("q"), upto("nc").alias("c"))

    key = ["dim", "c", "q"]
    lists = candidates.groupBy(*key).cogroup(blocks(asked).groupBy(*key)).applyInPandas(_local_lists(k), "query_id long, dim int, score long")
    by_score = Window.partitionBy("query_id", "dim").orderBy(F.desc("score"))
    best = lists.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    # Fewer than k entries in all: no cutoff, everything is sufficient.
    cutoffs = best.groupBy("query_id", "dim").agg(F.when(F.count("*") == k, F.min("score")).alias("cutoff"))
    cutoffs = cut_lineage(cutoffs).withColumnRenamed("query_id", "vec_id")
    # A cutoff stays a whole number: a null would turn the batch's cutoffs into doubles.
    cutoff = [F.coalesce("cutoff", F.lit(0)).cast("long").alias("cutoff"), F.col("cutoff").isNotNull().alias("has_cutoff")]
    told = asked.join(cutoffs, ["vec_id", "dim"], "left").select(*asked.columns, *cutoff)
    found = candidates.groupBy(*key).cogroup(blocks(told).groupBy(*key)).applyInPandas(_collected(k), "query_id long, dim int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.c, v.c), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.c) = len(v.c)
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

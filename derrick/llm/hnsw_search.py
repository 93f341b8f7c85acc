"""Approximate nearest neighbours by largest inner product: one HNSW graph per shard, results merged.

Equal vectors are one node, dealt to a shard by a hash of the vector, so that a shard holds about ``SHARD_NODES``
nodes however rows repeat. A node keeps the rows that a list of ``k`` can ever need, its ``k + 1`` smallest ids, which
loses nothing. Each shard's graph is built in a task and written as flat arrays; blocks of queries then meet every
shard by an equi-join, found nodes are scored again in double precision on the original vectors, and the shards'
lists are merged by a window. Every row is indexed; what is approximate is only which nodes a walk meets.

A shard's walk costs about the logarithm of its size, and a query walks each shard: larger shards mean less work in
all and longer tasks. ``SHARD_NODES`` and the beam ``WIDTH`` are the knobs; the recall is in the README.

Cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows without id take
no part; vectors of different length aren't compared; ties go to the smaller id; a row whose id equals the query's is the
query's own; repeated rows are candidates of their own; an id with several query rows is one query, by its smallest vector;
shards of up to 64 nodes are searched whole. Only vec_id and embedding are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrick.llm import hnsw_graph
from derrick.session import cut_lineage, shuffle_width

K = 20
EVERY = 20  # rows whose id is divisible by it are queries
SHARD_NODES = 8192
QUERY_BLOCK = 4096
WIDTH = 256
ROWS_AT_ONCE = 128
GRAPHS = "dim int, shard long, vectors binary, sizes array<int>, edges array<binary>, n_rows binary, vec_ids binary"


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    """The graph of one shard; ``n_rows`` says how many of ``vec_ids`` belong to each node."""
    shard = shard.sort_values("place", kind="stable")
    vectors = np.array(shard.x.tolist(), np.float64)
    graph = hnsw_graph.build(vectors)
    ids = [np.repeat([r["vec_id"] for r in rows], [r["copies"] for r in rows]) for rows in shard.rows]
    columns = {
        "dim": [vectors.shape[1]],
        "shard": [shard.shard.iloc[0]],
        "vectors": [vectors.tobytes()],
        "sizes": [graph.sizes],
        "edges": [[e.tobytes() for e in graph.edges]],
        "n_rows": [np.array([len(i) for i in ids], np.int64).tobytes()],
        "vec_ids": [np.concatenate(ids).astype(np.int64).tobytes()],
    }
    return pd.DataFrame(columns)


def _walk(k: int):
    """The best ``k`` rows of a shard for each query of a block."""

    def walk(graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(graphs) and len(queries):
            g = graphs.iloc[0]
            vectors = np.frombuffer(g.vectors, np.float64).reshape(-1, g.dim)
            graph = hnsw_graph.Graph(list(g.sizes), [np.frombuffer(e, np.int32) for e in g.edges])
            n_rows, vec_ids = np.frombuffer(g.n_rows, np.int64), np.frombuffer(g.vec_ids, np.int64)
            first = np.cumsum(n_rows) - n_rows
            q, asked = np.array(queries.x.tolist(), np.float64), queries.vec_id.to_numpy()
            nodes = hnsw_graph.search(vectors, graph, q, max(WIDTH, k))
            for at in range(0, len(q), ROWS_AT_ONCE):
                line, column = np.nonzero(nodes[at : at + ROWS_AT_ONCE] >= 0)
                node = nodes[at : at + ROWS_AT_ONCE][line, column]
                with np.errstate(over="ignore", invalid="ignore"):
                    score = (q[at + line] * vectors[node]).sum(axis=1)
                # Each node stands for its rows.
                n = n_rows[node]
                row = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[node], n)
                found = pd.DataFrame({"query_id": np.repeat(asked[at + line], n), "vec_id": vec_ids[row], "score": np.repeat(score, n)})
                found = found[found.query_id != found.vec_id].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
                parts.append(found.groupby("query_id").head(k))
        return pd.concat(parts) if parts else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    return walk


def _valid(vectors: DataFrame) -> DataFrame:
    """vec_id, the vector in double precision, and its length."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    return rows.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("x"), F.size("embedding").alias("dim"))


def index(vectors: DataFrame, k: int = K) -> DataFrame:
    """The graphs of all shards, a row each, as a written table. It serves lists of up to ``k``."""
    counted = _valid(vectors).groupBy("dim", "x", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))
    # Of equal vectors a list of k needs the k + 1 smallest ids at most: one may be the query's own.
    by_id = Window.partitionBy("dim", "x").orderBy("vec_id")
    needed = counted.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1)
    nodes = cut_lineage(needed.groupBy("dim", "x").agg(F.sort_array(F.collect_list(F.struct("vec_id", "copies"))).alias("rows")))
    shards = nodes.groupBy("dim").agg(F.ceil(F.count("*") / SHARD_NODES).alias("n_shards"))
    dealt = nodes.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("x"), F.col("n_shards"))).withColumn("place", F.xxhash64(F.lit(1), "x"))
    # Shards are small in bytes and dear in time: the width is given, so that they aren't put together into few tasks.
    spread = dealt.select("dim", "shard", "place", "x", "rows").repartition(shuffle_width(vectors.sparkSession), "dim", "shard")
    return cut_lineage(spread.groupBy("dim", "shard").applyInPandas(_build, GRAPHS))


def search(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for every query."""
    graphs = index(vectors, k)
    asked = _valid(vectors).where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("x").alias("x")).withColumn("dim", F.size("x"))
    asked = cut_lineage(asked)
    n_shards = graphs.groupBy("dim").agg(F.count("*").alias("n_shards"))
    sizes = cut_lineage(asked.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("n_blocks")).join(n_shards, "dim"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    blocks = asked.join(sizes, "dim").select("dim", "vec_id", "x", F.pmod(F.xxhash64("vec_id"), F.col("n_blocks")).alias("block"), "n_shards")
    blocks = blocks.select("dim", "vec_id", "x", "block", upto("n_shards").alias("shard"))
    met = graphs.join(sizes.select("dim", "n_blocks"), "dim").select(*graphs.columns, upto("n_blocks").alias("block"))
    key = ["dim", "shard", "block"]
    found = met.groupBy(*key).cogroup(blocks.groupBy(*key)).applyInPandas(_walk(k), "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

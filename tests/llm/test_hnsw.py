import math

import numpy as np
import pytest

from derrick.llm import hnsw_graph, hnsw_search

FOLDER = "/root/testdata"


def brute(rows, k=20, every=20):
    fine = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    asked = {}
    for i, v in fine:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for i, q in asked.items():
        scored = sorted((-float((np.array(q) * np.array(c)).sum()), j) for j, c in fine if j != i and len(c) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def found(df, **options):
    return sorted(map(tuple, hnsw_search.search(df, **options).collect()))


@pytest.mark.parametrize("nodes", [8192, 300])
def test_recall_and_exact_scores(spark, monkeypatch, nodes):
    """Against brute force over all rows: one shard, and several with several blocks of queries."""
    monkeypatch.setattr(hnsw_search, "SHARD_NODES", nodes)
    monkeypatch.setattr(hnsw_search, "QUERY_BLOCK", 100 if nodes < 8192 else 4096)
    df = spark.read.parquet(f"{FOLDER}/check_s/embeddings.parquet").where("vec_id < 4000")
    rows = df.select("vec_id", "embedding").collect()
    x = np.array([r.embedding for r in rows])
    ids = np.array([r.vec_id for r in rows])
    result = hnsw_search.search(df).toPandas()
    score = {i: dict(zip(ids.tolist(), (x @ x[k]).tolist())) for k, i in enumerate(ids.tolist()) if i % 20 == 0}
    hits = 0
    assert set(result.query_id) == set(score)
    for i, mine in result.groupby("query_id"):
        mine = mine.sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21)) and i not in set(mine.vec_id)
        assert list(zip(-mine.score, mine.vec_id)) == sorted(zip(-mine.score, mine.vec_id))
        assert np.allclose(mine.score, [score[i][j] for j in mine.vec_id], rtol=1e-12)
        least = sorted((s for j, s in score[i].items() if j != i), reverse=True)[19]
        hits += int((mine.score >= least - 1e-12).sum())
    assert hits / len(result) >= 0.97


def test_uneven_lengths_keep_the_recall():
    """Inner products favour long vectors; the stretched ones still find them."""
    some = np.random.default_rng(5)
    x = (some.normal(size=(40, 16))[some.integers(0, 40, 3000)] + 0.3 * some.normal(size=(3000, 16))) * some.lognormal(0, 0.5, (3000, 1))
    q = some.normal(size=(200, 16))
    nodes = hnsw_graph.search(x, hnsw_graph.build(x), q, hnsw_search.WIDTH)
    best = np.argsort(-(q @ x.T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(nodes.tolist(), best.tolist())]) >= 0.95


def test_cases(spark):
    rows = [(k, [float(k % 5), 1.0, -0.5 * (k % 3), 0.25]) for k in range(1, 50)]  # fifteen vectors, each of several rows
    rows += [(20, rows[0][1]), (20, rows[1][1]), (7, rows[3][1]), (7, rows[3][1]), (7, rows[3][1]), (None, [1.0] * 4), (40, None), (60, []), (80, [0.0] * 4)]
    rows += [(100, [1.0, None, 0.0, 0.0]), (120, [float("nan")] * 4), (140, [float("inf"), 0.0, 0.0, 0.0]), (160, [2.0, 1.0]), (161, [-1.0, 4.0]), (180, [1e300, 1.0, 1.0]), (0, [-0.0, 1.0, -0.0, 0.25])]
    df = spark.createDataFrame([(i, v, 1, 2, 3.0, "x") for i, v in rows], "vec_id long, embedding array<double>, dim int, shard long, score double, rows string")
    assert found(df) == brute(rows)
    assert found(df, k=3) == brute(rows, 3)
    assert hnsw_search.search(df.limit(0)).count() == 0


def test_a_common_vector_is_one_node(spark):
    """A third of the rows are copies: they fill the lists by their ids and don't cut the graph."""
    some = np.random.default_rng(8)
    rows = [(k, [1.0] * 8 if k % 3 == 0 else some.normal(size=8).tolist()) for k in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = found(df), brute(rows)
    assert len(got) == len(want) and [r[:3] for r in got if r[0] % 3 == 0] == [r[:3] for r in want if r[0] % 3 == 0]
    assert len(set(got) & set(want)) >= 0.97 * len(want)

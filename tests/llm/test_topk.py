import math

import duckdb

from check_oracles import compare
from derrick.llm import topk_search

FOLDER = "/root/testdata/sf0.01"


def brute(rows, k=10, every=100):
    fine = [(i, [max(-(2**63), min(2**63 - 1, math.floor(1024 * x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], set()
    for i, q in fine:
        if i % every or i in asked:
            continue
        asked.add(i)
        scored = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in fine if j != i and len(c) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    assert compare(spark, connection, "op5_topk_search", FOLDER).startswith("ok")


def test_edge_cases(spark, monkeypatch):
    rows = [(k, [math.sin(k * 0.7), -0.001 * k, float(k % 3), 0.5]) for k in range(0, 330)]
    rows += [(401, rows[7][1]), (402, rows[7][1]), (400, [0.0] * 4), (7, rows[7][1]), (None, [1.0] * 4), (500, None), (501, [1.0, None, 0.0, 0.0]), (600, [float("nan")] * 4), (700, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(800, [1.0, 2.0]), (801, [3.0, -4.0]), (900, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, row string")
    single = [(r.vec_id, None if r.embedding is None else list(r.embedding)) for r in df.collect()]
    for block in (4096, 50):
        monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", block)
        monkeypatch.setattr(topk_search, "QUERY_BLOCK", 2)
        assert sorted(map(tuple, topk_search.search(df).collect())) == brute(single)
    assert topk_search.search(df.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(k, [3e12 * (k + 1), -2.5e12, 1.0]) for k in range(6)] + [(100, [1.5e13, 7.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = [(q, n, v, max(-(2**63 - 1), min(2**63 - 1, s))) for q, n, v, s in brute(rows)]
    assert [r.score for r in topk_search.search(df).orderBy("query_id", "rank").collect()] == [w[3] for w in want]

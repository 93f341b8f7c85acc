import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as contract
from derrick.llm import quality_gam, quality_trees
from derrick.llm.statistics import COUNTS, FEATURES, measure
from tests.llm.cases import TEXTS, empty, frame

FOLDER = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {p for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def test_counts_equal_brute_force(spark):
    import pyarrow.parquet as pq

    texts = [t for _, t in TEXTS] + pq.read_table(f"{FOLDER}/documents.parquet")["text"].to_pylist()[::7]
    found = measure(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert tuple(int(found[name][k]) for name in COUNTS) == brute(text)


def test_statistics_do_not_depend_on_neighbours():
    texts = [t for _, t in TEXTS]
    together = measure(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        alone = measure(pa.array([text], pa.string()))
        assert all(alone[name][0] == together[name][k] for name in COUNTS + FEATURES)


def test_additive_score_is_the_sum_of_its_tables():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 4))
    y = (x[:, 1] * x[:, 2] + 0.5 * (x[:, 0] > 0) > 0.25).astype(float)
    model = quality_gam.fit(x, y, rounds=40, pairs=2)
    for row, score in zip(x[:50], model.score(x[:50]), strict=True):
        total = model.base + sum(t[sum(e <= v for e in edges)] for v, edges, t in zip(row, model.edges, model.tables, strict=True))
        total += sum(t[sum(c <= row[a] for c in ca), sum(c <= row[b] for c in cb)] for a, b, ca, cb, t in model.pairs)
        assert score == pytest.approx(1 / (1 + np.exp(-total)))
    # The product of two features is found as a pair; tables of single features can't hold it.
    assert (1, 2) in [(a, b) for a, b, *_ in model.pairs]
    assert ((model.score(x) > 0.5) == y).mean() > ((quality_gam.fit(x, y, rounds=40, pairs=0).score(x) > 0.5) == y).mean() + 0.1


@pytest.mark.parametrize("y,expected", [([], 1.0), ([1.0, 1.0], 1.0), ([0.0], 0.0)])
def test_labels_of_one_kind(y, expected):
    x = np.zeros((len(y), len(FEATURES)))
    assert quality_gam.fit(x, np.array(y)).score(np.ones((1, len(FEATURES))))[0] == pytest.approx(expected, abs=1e-9)
    assert quality_trees.fit(x, np.array(y)).score(np.ones((1, len(FEATURES))))[0] == pytest.approx(expected, abs=1e-9)


def test_trees_are_monotone_and_walk_as_one_by_one():
    rng = np.random.default_rng(1)
    x = rng.random((800, len(FEATURES)))
    y = (x[:, FEATURES.index("symbols_per_word")] + 0.3 * rng.random(800) < 0.7).astype(float)
    forest = quality_trees.fit(x, y, trees=30)
    for name, sign in quality_trees.MONOTONE.items():
        rows = np.repeat(x[:20], 15, 0)
        rows[:, FEATURES.index(name)] = np.tile(np.linspace(0, 1, 15), 20)
        steps = np.diff(forest.score(rows).reshape(20, 15), axis=1)
        assert (steps * sign >= -1e-12).all()
    for row, score in zip(x[:20], forest.score(x[:20]), strict=True):
        total = forest.base
        for node in forest.roots:
            while forest.low[node] != node:
                node = forest.low[node] if row[forest.feature[node]] < forest.cut[node] else forest.high[node]
            total += forest.value[node]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_edge_cases(spark):
    docs, labels = frame(spark), spark.createDataFrame([(4, 1, 0), (4, 0, 0), (7, 0, 0), (12, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    scored = quality_gam.classify(docs, quality_gam.train(docs, labels)).collect()
    assert len(scored) == len(TEXTS) and all(0 <= r.score <= 1 for r in scored)
    assert all(r.held_out == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored)
    judged = quality_trees.verdicts(docs, quality_trees.train(docs, labels)).collect()
    for r in judged:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    none = empty(spark)
    assert quality_gam.classify(none, quality_gam.train(none, labels.limit(0))).count() == 0
    assert quality_trees.keep_passing(none, quality_trees.train(none, labels.limit(0))).columns == none.columns


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = contract.queries()["op1_quality_classifier"](spark, FOLDER).join(labels, "doc_id").where("held_out").toPandas()
    assert (found.predicted == found.quality).mean() > 0.93
    kept = contract.queries()["op7_quality_rules"](spark, FOLDER).join(labels, "doc_id").where("not base_failed").toPandas()
    assert (kept.kept.astype(int) == kept.quality).mean() > 0.95

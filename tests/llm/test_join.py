import re

import pytest

from derrick.llm import jaccard_forest
from derrick.llm.components import components
from tests.llm.cases import TEXTS, empty, frame, plain


def shingles(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower()) or re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) or frozenset([tuple(words)] if words else [])


def brute(rows):
    """Per row: class, copy and number of links, by comparing all sets."""
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(shingles(text), []).append(doc_id)
    keys = list(sets)
    close = {a: [b for b in keys if a is not b and a and b and 5 * len(a & b) >= 4 * len(a | b)] for a in keys}
    group = {}
    for a in keys:
        if a not in group:
            reached, todo = {a}, [a]
            while todo:
                new = [b for b in close[todo.pop()] if b not in reached]
                reached.update(new)
                todo += new
            for b in reached:
                group[b] = reached
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return sorted([(i, least([j for b in group[shingles(t)] for j in sets[b]]), least(sets[shingles(t)]), len(close[shingles(t)])) for i, t in rows], key=str)


def found(df):
    return sorted([(r.doc_id, r.class_id, r.copy_id, r.n_links) for r in jaccard_forest.near_duplicates(df).collect()], key=str)


def near_copies(n, first=100):
    words = plain(200, 77).split()
    rows = []
    for k in range(n):
        own = list(words)
        for step in range(k % 5):
            own[(k * 37 + step * 41) % 200] = f"new{k}-{step}"
        rows.append((first + k, " ".join(own)))
    return rows


def test_edge_cases(spark):
    assert found(frame(spark)) == brute(TEXTS)
    assert found(empty(spark)) == []
    kept = jaccard_forest.keep_first(frame(spark))
    assert kept.columns == frame(spark).columns
    assert kept.count() == len({c for _, c, _, _ in brute(TEXTS)})
    assert jaccard_forest.keep_first(empty(spark)).count() == 0


def test_ids_that_are_null_or_repeat_keep_each_text(spark):
    a, b, c, d = (plain(60, seed) for seed in (11, 12, 13, 14))
    rows = [(None, a), (None, b), (None, b + " more"), (5, c), (5, d), (5, d), (6, d + " more")]
    kept = [(r.doc_id, r.text) for r in jaccard_forest.keep_first(frame(spark, rows)).collect()]
    assert len(kept) == 4 and {(None, a), (5, c), (5, d)} < set(kept)
    assert {(None, b), (None, b + " more")} & set(kept)


@pytest.mark.parametrize("block", [1000, 7])
def test_a_large_group_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_forest, "BLOCK", block)
    rows = near_copies(40) + [(500 + k, plain(80, 1000 + k)) for k in range(30)] + [(600 + k, plain(80, 1000)) for k in range(25)]
    assert found(frame(spark, rows)) == brute(rows)


def test_similarities_around_the_threshold(spark):
    rows = []
    for k in range(40):
        words = plain(120, 5000 + k).split()
        rows.append((10 * k, " ".join(words)))
        for cut in range(1, 5):
            rows.append((10 * k + cut, " ".join(words[: 120 - 6 * cut])))
    got, want = found(frame(spark, rows)), brute(rows)
    # Misses are possible below the target recall; at these similarities none is expected.
    assert sum(g != w for g, w in zip(got, want, strict=True)) <= len(rows) * (1 - jaccard_forest.TARGET_RECALL) + 1


def test_case_and_punctuation_do_not_count(spark):
    text = plain(50, 4)
    rows = [(1, text), (2, text.upper() + "!"), (3, text.replace(" ", ", ")), (4, "Élan À ÿ × b c"), (5, "élan à ÿ × b c"), (6, "*** ###"), (7, "### ***"), (8, "***  ###")]
    assert found(frame(spark, rows)) == brute(rows)
    copies = {i: copy for i, _, copy, _ in brute(rows)}
    assert copies == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 6}


def test_prefix_reaches_the_target():
    depth = jaccard_forest.prefix_depth()
    assert 1 - (1 - 0.8**depth) ** jaccard_forest.TREES >= jaccard_forest.TARGET_RECALL
    assert 1 - (1 - 0.8 ** (depth + 1)) ** jaccard_forest.TREES < jaccard_forest.TARGET_RECALL


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (301, 300), (302, 301)]
    rows = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert rows == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}, 300: 300, 301: 300, 302: 300}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

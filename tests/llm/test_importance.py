import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from check_oracles import compare
from derrick.llm import importance_planes
from tests.llm.cases import TEXTS, empty, frame, plain

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    words = WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
    return len(words), Counter(zlib.crc32(g.encode()) % 10000 for g in words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def brute(rows, target):
    docs = [(i, *grams(t)) for i, t in rows]
    s, t = Counter(), Counter()
    for _, _, c in docs:
        s.update(c)
    for text in target:
        t.update(grams(text)[1])
    all_s, all_t = float(s.total() + 10000), float(t.total() + 10000)
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10000)]
    out = []
    for i, n_words, c in docs:
        weight = sum(n * gain[b] for b, n in c.items()) // c.total() if c else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([n_words >= 20, -score, i is None, i or 0, c.total(), weight, i, score])
    out.sort(key=lambda r: (not r[0], r[1:6]))
    n = 25 * sum(r[0] for r in out) // 100
    return sorted(((r[6], r[4], r[5], r[7], k + 1 if k < n else None) for k, r in enumerate(out)), key=repr)


def found(docs, target):
    return sorted((tuple(r) for r in importance_planes.resample(docs, target).collect()), key=repr)


def bench(spark, texts):
    return spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "item_id long, text string, bucket int")


def test_equals_sql(spark):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    assert compare(spark, connection, "op13_importance_resampling", FOLDER).startswith("ok")


def test_equals_brute_force(spark):
    rows = TEXTS + [(100 + k % 190, plain(15 + k % 30, k) + (" Ÿ字" if k % 4 else " the END")) for k in range(200)]
    rows += [(1000, "w" * 47 + " " + "v" * 48 + " " + "ü" * 24 + " " + "u" * 49 + " " + "x" * 600_000), (1001, plain(60_000, 5)), (1002, "same Same " * 40_000)]
    target = ["the of and to", plain(300, 77), None, "", "same same same"]
    assert found(frame(spark, rows), bench(spark, target)) == brute(rows, target)


def test_empty_tables(spark):
    assert importance_planes.resample(empty(spark), bench(spark, ["a b"])).count() == 0
    assert found(frame(spark), bench(spark, []).limit(0)) == brute(TEXTS, [])


def test_planes_give_whole_sums():
    some = np.random.default_rng(3)
    gain = some.integers(-9000, 9000, importance_planes.BUCKETS)
    doc, bucket = some.integers(0, 7, 40_000), some.choice([0, 1, 63, 64, 65, 9998, 9999, 500], 40_000)
    want = np.bincount(doc, gain[bucket], minlength=8).astype(np.int64)
    assert importance_planes._sums(doc, bucket, 8, importance_planes.gain_planes(gain)).tolist() == want.tolist()

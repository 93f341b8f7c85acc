import hashlib
import zlib
from collections import defaultdict

import duckdb

from check_oracles import compare
from derrick.llm import merkle_manifest, ranks
from pyspark.sql import functions as F
from tests.llm.cases import TEXTS, empty, frame

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, digest string, pos long, n int, block string, level0 int, flanks int, root string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return H(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][k : k + 8]) for k in range(0, len(out[-1]), 8)])
    return out


def flanks(tree, at):
    for level in tree[:-1]:
        start = at // 8 * 8
        yield "".join(level[start:at]), "".join(level[at + 1 : start + 8])
        at //= 8


def brute(rows):
    trees = defaultdict(list)
    for r in rows:
        folded = r[4]
        if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
            folded = r[4].translate({k: k + 32 for k in range(65, 91)})
        trees[r[2]].append((r[0], leaf(*r), leaf(*r[:4], folded)))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in langs:
        trees[lang].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        built[lang] = levels([t[1] for t in trees[lang]])
    top = levels([built[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for at, (doc_id, own, node) in enumerate(trees[lang]):
            path = [*flanks(built[lang], at), *flanks(top, k)]
            for left, right in path:
                node = H(left, node, right)
            out.append((doc_id, own, built[lang][-1][0], top[-1][0], H(*(a + b for a, b in path)), node, node == top[-1][0]))
    return sorted(out, key=repr)


def rows_of(n):
    """Two languages of more than a block, small ones, a null one, repeated ids and rows, long and odd texts."""
    rows = [(k * 3, f"s{k % 5}", "en" if k % 9 else "fr", k, f"Text {k} ÀÉ {'Z' * (k % 7)}") for k in range(n)]
    rows += [(k, None, None, None, None if k % 2 else "ABC") for k in range(9)]
    rows += [(5, "s", "", 1, "Aé"), (5, "s", "", 1, "Aé"), (5, "s", "", 1, "B"), (None, "s", "", 1, "B"), (None, "s", "", 1, "B"), (None, None, "", None, "")]
    return rows + [(10**12, "s", "éé", -1, "Long WORD " * 70_000), (-3, "s", "x", 0, "one"), (0, "s", "en", 0, "A")]


def found(spark, rows):
    df = spark.createDataFrame([(*r, "d", 1, 2, "b", 3, 4, "r") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle_manifest.manifest(df).collect()), key=repr)


def test_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    assert compare(spark, connection, "op11_merkle_manifest", FOLDER).startswith("ok")


def test_equals_brute_force(spark):
    rows = rows_of(2500)
    result = found(spark, rows)
    assert result == brute(rows)
    assert {r[6] for r in result} == {True, False}


def test_single_nodes(spark):
    for rows in ([(1, "s", "en", 3, "one")], [(3, "s", "en", 3, "Two"), (0, "s", "fr", 1, "A")], [(k, "s", f"l{k}", k, "T") for k in range(20)]):
        assert found(spark, rows) == brute(rows)


def test_cases(spark):
    assert merkle_manifest.manifest(empty(spark)).count() == 0
    rows = [(i, "s", "en", len(t or ""), t) for i, t in TEXTS]
    got = sorted((tuple(r) for r in merkle_manifest.manifest(frame(spark)).collect()), key=repr)
    assert got == brute(rows)


def test_places_of_hot_and_equal_keys(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("g"), (F.col("id") % 2).alias("k"), "id")
    placed = ranks.with_places(rows, ["g"], [F.col("k")]).collect()
    for g in (None, "hot"):
        mine = sorted((r.pos, r.k) for r in placed if r.g == g)
        assert [p for p, _ in mine] == list(range(len(mine))) and [k for _, k in mine] == sorted(k for _, k in mine)
        assert {r.n for r in placed if r.g == g} == {len(mine)}

"""Merkle manifest of documents: leaves, roots, inclusion proofs and their verification.

A document's leaf is the SHA-256 of its length-prefixed columns. The leaves of a language stand in
order of doc_id; every 8 nodes in a row have a parent, the SHA-256 of their digests as text, until one
node is left: the language's subroot. The subroots are the leaves of a last tree, whose node is the root.

Each aligned block of 512 nodes keeps a level as one string of digests of 64 characters: fixed-width
substrings are hashed to the next level's string, three levels in a row, and the substrings beside a node's
own in its run of 8 are its siblings. The blocks' last nodes are the leaves of the next
round, so a round divides the nodes by 512 and a group never holds more than 512 rows. From the
roots down, each node's siblings are followed by those of its block; a document thus carries its whole
path, its proof, and folds its (perhaps tampered) leaf along it to a root again.

Cases: a null column is ``-`` in the leaf; documents without doc_id come first in their language and aren't
tampered; rows with equal doc_id follow each other by leaf, and equal rows are leaves
of their own; a language of one document is its own subroot, one language its own root; an empty table has no rows.
Only doc_id, source, lang, n_chars and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.llm.ranks import with_places
from derrick.session import cut_lineage

FAN = 8
LEVELS = 3  # of a block
BLOCK = FAN**LEVELS
HEX = 64
TAMPER_EVERY = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(c: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def leaf_of(text: Column) -> Column:
    before = [F.col("doc_id").cast("string"), F.col("source"), F.col("lang"), F.col("n_chars").cast("string")]
    return F.sha2(F.concat(*[_field(c) for c in before], _field(text)), 256)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; pure ASCII takes the quick way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _is_tampered() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0


def _parents(level: Column) -> Column:
    """The next level's string: the digest of each run of 8 digests, the last one maybe shorter."""
    starts = F.sequence(F.lit(1), F.length(level), F.lit(FAN * HEX))
    return F.array_join(F.transform(starts, lambda at: F.sha2(F.substring(level, at, FAN * HEX), 256)), "").cast("binary")


def _blocks(nodes: DataFrame, tree: list[str], payload: list[str] = ()) -> DataFrame:
    """One row per block of 512 nodes: its members in order, a string per level, and what is left of it.

    ``n`` counts the nodes of the whole tree; a level has parents while the tree has several nodes on it. Strings are
    kept as bytes, so that a substring is cut without walking the characters before it."""
    member = F.struct("pos", "digest", *payload)
    found = nodes.groupBy(*tree, F.expr(f"pos div {BLOCK}").alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"), F.max("n").alias("n"))
    found = found.withColumn("level0", F.array_join(F.transform("members", lambda m: m.digest), "").cast("binary"))
    for j in range(LEVELS):
        found = found.withColumn(f"level{j + 1}", F.when(F.col("n") > FAN**j, _parents(F.col(f"level{j}"))))
    last = F.coalesce(*[F.col(f"level{j}") for j in range(LEVELS, -1, -1)])
    return cut_lineage(found.withColumn("digest", last.cast("string")))


def _own_flanks(pos: Column) -> Column:
    """The digests before and behind a node in its run, for each level of its block that has parents."""

    def flank(j: int) -> Column:
        at = F.floor((pos % BLOCK) / FAN**j).cast("int")
        place = at % FAN
        level = F.col(f"level{j}")
        left = F.substring(level, (at - place) * HEX + 1, place * HEX)
        right = F.substring(level, (at + 1) * HEX + 1, (FAN - 1 - place) * HEX)
        return F.when(F.col("n") > FAN**j, F.struct(left.alias("left"), right.alias("right")))

    return F.filter(F.array(*[flank(j) for j in range(LEVELS)]), lambda f: f.isNotNull())


def _rounds(nodes: DataFrame, tree: list[str], payload: list[str] = ()) -> list[DataFrame]:
    """Blocks of all rounds, until every tree is one block."""
    rounds = [_blocks(nodes, tree, payload)]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > BLOCK:
        upper = rounds[-1].select(*tree, F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), "digest")
        rounds.append(_blocks(upper, tree))
    return rounds


def _with_path(blocks: DataFrame, above: DataFrame, tree: list[str]) -> DataFrame:
    """Blocks with the flanks of their last node up to the root; ``above`` has them by tree and pos."""
    same = F.col("block") == F.col("_pos")
    for c in tree:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    named = above.select(F.col("pos").alias("_pos"), *[F.col(c).alias(f"_{c}") for c in tree], *[c for c in above.columns if c not in ("pos", *tree)])
    return blocks.join(named, same).drop("_pos", *[f"_{c}" for c in tree])


def _paths(blocks: DataFrame, keys: list[str], kept: list[str], payload: list[str] = ()) -> DataFrame:
    """The members of blocks, each with its own flanks before those of its block."""
    member = F.transform("members", lambda m: F.struct(m.pos.alias("pos"), *[m[c].alias(c) for c in payload], F.concat(_own_flanks(m.pos), F.col("flanks")).alias("flanks")))
    return blocks.select(*keys, *kept, F.inline(member))


def _fold(digest: Column, flanks: Column) -> Column:
    return F.aggregate(flanks, digest, lambda node, f: F.sha2(F.concat(f.left, node.cast("binary"), f.right), 256))


def _proof(flanks: Column) -> Column:
    return F.sha2(F.array_join(F.transform(flanks, lambda f: F.concat(f.left, f.right).cast("string")), ""), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document."""
    leaves = docs.select("doc_id", "source", "lang", "n_chars", "text").select(
        "doc_id",
        "lang",
        leaf_of(F.col("text")).alias("digest"),
        F.when(_is_tampered(), leaf_of(lower_ascii(F.col("text")))).alias("tampered"),
    )
    placed = with_places(cut_lineage(leaves), ["lang"], [F.col("doc_id"), F.col("digest")])
    rounds = _rounds(placed, ["lang"], ["doc_id", "tampered"])

    subroots = rounds[-1].select("lang", F.col("digest").alias("subroot"))
    nodes = with_places(cut_lineage(subroots), [], [F.col("lang")]).withColumnRenamed("subroot", "digest")
    top = _rounds(nodes.withColumn("subroot", F.col("digest")), [], ["lang", "subroot"])
    last = top[-1].select("digest").first()
    root = F.lit(last.digest if last else None).cast("string")

    # From the root down: nodes of a round meet the blocks that they stand for.
    nothing = F.array().cast("array<struct<left: binary, right: binary>>")
    path = top[-1].withColumn("flanks", nothing)
    for lower in reversed(top[:-1]):
        path = _with_path(lower, _paths(path, [], []), [])
    above = _paths(path, [], [], ["lang", "subroot"]).withColumn("pos", F.lit(0).cast("long"))
    for lower in reversed(rounds[1:]):
        above = _paths(_with_path(lower, above, ["lang"]), ["lang"], ["subroot"])

    full = _with_path(rounds[0], above, ["lang"])
    path_of = lambda m: F.struct(m.alias("m"), F.concat(_own_flanks(m.pos), F.col("flanks")).alias("flanks"))
    entry = lambda e: F.struct(
        e.m.doc_id.alias("doc_id"),
        e.m.digest.alias("leaf"),
        _proof(e.flanks).alias("proof_sha256"),
        _fold(F.coalesce(e.m.tampered, e.m.digest), e.flanks).alias("folded_root"),
    )
    found = full.select("subroot", F.inline(F.transform(F.transform("members", path_of), entry)))
    return found.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))


# CRC-32 of ASCII text ``{0}``, bit by bit.
_SQL_CRC = (
    "xor(list_reduce([4294967295] || list_transform(string_split({0}, ''), lambda c: CAST(ascii(c) AS BIGINT)), "
    "lambda a, c: list_reduce([xor(a, c)] || [CAST(k AS BIGINT) for k in range(8)], lambda b, k: xor(b >> 1, 3988292384 * (b & 1)))), 4294967295)"
)


def _sql_field(c: str) -> str:
    return f"COALESCE(CAST(strlen({c}) AS VARCHAR) || ':' || {c}, '-')"


def _sql_leaf(text: str) -> str:
    parts = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return f"sha256({' || '.join(_sql_field(p) for p in parts)})"


_SQL_TREE = """SELECT tree, level + 1 AS level, pos // 8 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
  FROM (SELECT *, COUNT(*) OVER (PARTITION BY tree) AS c FROM {0}) x WHERE c > 1 GROUP BY tree, level, pos // 8"""
_SQL_FLANKS = """SELECT l.tree, l.pos, n.level,
    COALESCE(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < n.pos), '') || '|' || COALESCE(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > n.pos), '') AS flank
  FROM {0} l JOIN {1} n ON n.tree = l.tree AND n.pos = l.pos // CAST(8 ** n.level AS BIGINT)
  JOIN (SELECT tree, level, COUNT(*) AS c FROM {1} GROUP BY tree, level) k ON k.tree = n.tree AND k.level = n.level AND k.c > 1
  JOIN {1} s ON s.tree = n.tree AND s.level = n.level AND s.pos // 8 = n.pos // 8 GROUP BY l.tree, l.pos, n.level"""

SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, COALESCE('=' || lang, '') AS tree, {_sql_leaf("text")} AS leaf,
    {_sql_leaf(f"CASE WHEN {_SQL_CRC.format('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END")} AS folded
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS digest FROM placed UNION ALL {_SQL_TREE.format("nodes")}
), subroots AS (
  SELECT tree AS lang_tree, arg_max(digest, level) AS digest, row_number() OVER (ORDER BY tree) - 1 AS pos, 0 AS tree FROM nodes GROUP BY lang_tree
), top_nodes AS (
  SELECT tree, 0 AS level, pos, digest FROM subroots UNION ALL {_SQL_TREE.format("top_nodes")}
), flanks AS ({_SQL_FLANKS.format("placed", "nodes")}
), top_flanks AS ({_SQL_FLANKS.format("subroots", "top_nodes")}
), path AS (
  SELECT p.tree, p.pos, 0 AS part, f.level, f.flank FROM placed p JOIN flanks f ON f.tree = p.tree AND f.pos = p.pos
  UNION ALL SELECT p.tree, p.pos, 1, f.level, f.flank FROM placed p JOIN subroots r ON r.lang_tree = p.tree JOIN top_flanks f ON f.pos = r.pos
), proofs AS (
  SELECT tree, pos, list(flank ORDER BY part, level) AS flanks FROM path GROUP BY tree, pos
), found AS (
  SELECT p.doc_id, p.leaf, r.digest AS subroot, (SELECT arg_max(digest, level) FROM top_nodes) AS root,
    sha256(replace(array_to_string(COALESCE(f.flanks, []), ''), '|', '')) AS proof_sha256,
    list_reduce([p.folded] || COALESCE(f.flanks, []), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) AS folded_root
  FROM placed p JOIN subroots r ON r.lang_tree = p.tree LEFT JOIN proofs f ON f.tree = p.tree AND f.pos = p.pos
)
SELECT *, folded_root = root AS verified FROM found
"""

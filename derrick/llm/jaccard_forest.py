"""N-gram Jaccard join with a MinHash LSH forest.

Words are runs of letters, digits and other characters beyond ASCII, without case (a text of
signs alone is split at white space instead). A text is the set of its windows of ``SHINGLE``
words (a shorter text is one window); two texts are linked when the Jaccard similarity of their sets is at least ``THRESHOLD``.

1. Texts with equal sets are one class; everything below works on classes.
2. A class has ``TREES`` labels of ``DEPTH`` MinHash values. Sorting the labels of a tree
   lays its prefix trie out as a sorted list: the classes below a trie node are
   neighbours, and neighbours' longest common prefix says how deep their node is. One
   distributed sort serves every depth.
3. The matched prefix is shortened, value by value, until the chance that a pair at
   the threshold shares a prefix in some tree reaches ``TARGET_RECALL`` (more similar pairs share it more surely).
   Neighbours with such a prefix are chained to candidate components.
4. Inside a component all pairs are verified exactly on their sets, in blocks of
   ``BLOCK`` classes; pairs of blocks of a large component are separate groups of a task's stream. Only
   counts and spanning links leave a task, never pairs.

Cases: null, empty and word-less texts have the empty set, are one class and link
to nothing else. Repeated rows and ids are rows of their class. A null id is no
class id unless the class has no other. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.llm.chunks import Chunk, chunks, mix
from derrick.llm.components import components
from derrick.session import cut_lineage

SHINGLE = 5
THRESHOLD = (4, 5)  # 0.8 as a fraction, so that the test is exact
TREES = 24
DEPTH = 8
TARGET_RECALL = 0.999
BLOCK = 1000
COLUMNS = 8192  # shingles per step of a block product

_RANDOM = np.random.Generator(np.random.PCG64(7))
_FACTORS = _RANDOM.integers(0, 2**31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32)


def prefix_depth(threshold: float = THRESHOLD[0] / THRESHOLD[1], target: float = TARGET_RECALL) -> int:
    """The longest prefix that a pair at the threshold shares in some tree with the target probability."""
    depth = DEPTH
    while depth > 1 and 1 - (1 - threshold**depth) ** TREES < target:
        depth -= 1
    return depth


def shingle_sets(chunk: Chunk) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a chunk."""
    out = _shingles(chunk.plain)
    bare = np.flatnonzero((np.diff(chunk.plain.word_bounds) == 0) & (np.diff(chunk.word_bounds) > 0))
    if len(bare):
        whole = _shingles(chunk)
        for doc in bare:
            out[doc] = whole[doc]
    return out


def _shingles(chunk: Chunk) -> list[np.ndarray]:
    keys, at = chunk.windows(SHINGLE)
    bounds = chunk.word_bounds
    cuts = np.searchsorted(at, bounds)
    out = []
    for doc in range(chunk.n):
        own = keys[cuts[doc] : cuts[doc + 1]]
        n = bounds[doc + 1] - bounds[doc]
        if 0 < n < SHINGLE:
            total = np.uint64(n)
            for h in chunk.word_hashes[bounds[doc] : bounds[doc + 1]]:
                total = mix(np.array([total], np.uint64))[0] ^ h
            own = mix(np.array([total], np.uint64))
        out.append(np.unique(own))
    return out


def signature(shingles: np.ndarray) -> bytes:
    """The labels of all trees: 16 bits of each MinHash value, tree by tree."""
    low = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(low, (short[at : at + 2048, None] * _FACTORS + _SHIFTS).min(0), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(">u2").tobytes()


def _sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            sets = shingle_sets(chunk)
            # The sum and the mixed sum of a set's hashes identify it in 128 bits.
            digests = [np.array([own.sum(dtype=np.uint64), mix(own).sum(dtype=np.uint64)], ">u8").tobytes() for own in sets]
            columns = [
                batch.column("doc_id").slice(chunk.first, chunk.n),
                batch.column("text_hash").slice(chunk.first, chunk.n),
                pa.array(digests, pa.binary()),
                pa.array([signature(own) if len(own) else None for own in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "digest", "labels"])


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, digest of the shingle set and labels of every document."""
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return source.mapInArrow(_sketched, "doc_id long, text_hash long, digest binary, labels binary")


def _neighbours(depth: int):
    """Chains of neighbours whose labels share ``depth`` values; the rows at the edges of a task are returned too."""

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b, label=None):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(label if label is not None else [None] * len(a), pa.binary())], names=["a", "b", "label"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            labels = batch.column("label").cast(pa.binary())
            raw = np.frombuffer(labels.buffers()[2], np.uint8)
            width = 1 + 2 * DEPTH
            at = np.frombuffer(labels.buffers()[1], np.int32)[labels.offset]
            rows = raw[at : at + width * len(labels)].reshape(-1, width)
            nodes = batch.column("node").to_numpy()
            prefix = rows[:, : 1 + 2 * depth]
            if last is None:
                yield out(nodes[:1], [None], [rows[0].tobytes()])
            elif (prefix[0] == last[1][: 1 + 2 * depth]).all():
                yield out([last[0]], nodes[:1])
            same = np.flatnonzero((prefix[1:] == prefix[:-1]).all(1))
            yield out(nodes[same], nodes[same + 1])
            last = int(nodes[-1]), rows[-1].copy()
        if last is not None:
            yield out([last[0]], [None], [last[1].tobytes()])

    return chain


def candidates(classes: DataFrame, depth: int) -> DataFrame:
    """Chains ``(a, b)`` through all classes that share a prefix of ``depth`` values in a tree."""
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    labels = classes.where(F.col("labels").isNotNull()).select("node", "labels", trees.alias("tree"))
    # The first byte tells the tree, so that one sort by bytes lays out all tries.
    tree_byte = F.unhex(F.lpad(F.hex("tree"), 2, "0"))
    entry = F.concat(tree_byte, F.substring("labels", F.col("tree") * (2 * DEPTH) + 1, F.lit(2 * DEPTH)))
    ranged = labels.select("node", entry.alias("label")).repartitionByRange("label", "node").sortWithinPartitions("label", "node")
    chained = cut_lineage(ranged.mapInArrow(_neighbours(depth), "a long, b long, label binary"))
    # Tasks are ranges of the sorted list: the last row of one may continue in the next. A hot node
    # spans whole tasks, whose edge rows all share its prefix; they are linked to their smallest.
    edge = chained.where(F.col("b").isNull()).select("a", F.substring("label", 1, 1 + 2 * depth).alias("prefix"))
    hub = edge.groupBy("prefix").agg(F.min("a").alias("hub"))
    across = edge.join(hub, "prefix").select("a", F.col("hub").alias("b"))
    return chained.where(F.col("b").isNotNull()).select("a", "b").unionAll(across)


def _similar(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Which pairs of sets reach the threshold, exactly; with one list, each against the others of it."""
    sets = left + (right or [])
    hashes = np.concatenate(sets)
    _, column, n = np.unique(hashes, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = n > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = int(shared.sum())
    k = len(left)
    common = np.zeros((k, len(right) if right is not None else k))
    for at in range(0, total, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        part = np.zeros((len(sets), min(COLUMNS, total - at)), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        common += part[:k] @ (part[k:] if right is not None else part).T
    size_left = np.array([len(s) for s in left])
    size_right = np.array([len(s) for s in right]) if right is not None else size_left
    union = size_left[:, None] + size_right[None, :] - common
    close = THRESHOLD[1] * common >= THRESHOLD[0] * union
    if right is None:
        np.fill_diagonal(close, False)
    return close


def verify(nodes: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Number of links of each class within a pair of blocks, and the smallest class it reaches by them."""
    first = np.flatnonzero(blocks == blocks.min())
    second = np.flatnonzero(blocks != blocks.min())
    close = np.zeros((len(nodes), len(nodes)), bool)
    if len(second):
        part = _similar([sets[k] for k in first], [sets[k] for k in second])
        close[np.ix_(first, second)] = part
        close[np.ix_(second, first)] = part.T
    else:
        close = _similar(sets, None)
    root = np.asarray(nodes).copy()
    while True:
        reach = np.where(close, root[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        new = np.minimum(root, reach)
        if (new == root).all():
            return close.sum(1), root
        root = new


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks rows sorted by component and block pair; a group may span batches."""
    key, nodes, blocks, sets = None, [], [], []
    done: list[tuple] = []

    def close_group():
        if nodes:
            links, roots = verify(np.array(nodes), np.array(blocks), sets)
            done.append((np.full(len(nodes), key[3]), np.array(nodes), links, roots))

    def flush():
        parts = [np.concatenate(x) for x in zip(*done, strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in parts], names=["n_blocks", "node", "links", "root"])

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("component", "i", "j", "n_blocks")), strict=True))
        own_nodes, own_blocks = batch.column("node").to_pylist(), batch.column("block").to_pylist()
        for chunk in chunks(batch.column("text")):
            for k, shingles in enumerate(shingle_sets(chunk), chunk.first):
                if keys[k] != key:
                    close_group()
                    key, nodes, blocks, sets = keys[k], [], [], []
                nodes.append(own_nodes[k])
                blocks.append(own_blocks[k])
                sets.append(shingles)
        if done:
            yield flush()
    close_group()
    if done:
        yield flush()


def links(docs: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Exact links within the candidate components: n_blocks, node, links and root per class and pair of blocks."""
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("n_blocks"))
    members = groups.join(sizes, "component").join(classes.select("node", "doc_id", "text_hash"), "node")
    texts = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("hash"))
    found = texts.join(members, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")))
    # Repeated rows of an id hold one text.
    one = found.groupBy("component", "node", "n_blocks").agg(F.first("text").alias("text"))
    block = F.pmod(F.xxhash64("node"), F.col("n_blocks"))
    dealt = one.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    paired = dealt.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "n_blocks", "node", "block", "text")
    keys = ["component", "i", "j"]
    streams = paired.repartition(*keys).sortWithinPartitions(*keys, "node")
    return streams.mapInArrow(_verified, "n_blocks long, node long, links long, root long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, class_id, copy_id and n_links for every document.

    ``copy_id`` is the smallest id with the same shingle set, ``class_id`` the smallest id of
    the texts joined by links (over several steps as well), ``n_links`` the number of other shingle
    sets that the text is linked to.
    """
    return with_components(docs).drop("component")


def with_components(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with ``component``, which is unique per class; ids may be null or repeat over classes."""
    sketches = cut_lineage(sketch(docs))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")).alias("first")
    classes = sketches.groupBy("digest", "labels").agg(first).select("digest", "labels", "first.doc_id", "first.text_hash")
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))
    groups = cut_lineage(components(candidates(classes, prefix_depth())))
    found = cut_lineage(links(docs, classes, groups))
    # A component of one block is settled in its task; larger ones are joined over their blocks.
    whole = found.where("n_blocks = 1").select("node", F.col("root").alias("component"))
    wide = components(found.where("n_blocks > 1").select(F.col("node").alias("a"), F.col("root").alias("b")))
    settled = whole.unionAll(wide)
    counted = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    labelled = classes.select("node", "digest", F.col("doc_id").alias("copy_id")).join(settled, "node", "left").join(counted, "node", "left")
    labelled = labelled.select("digest", "copy_id", F.coalesce("component", "node").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    labelled = cut_lineage(labelled)
    smallest = labelled.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    by_class = labelled.join(smallest, "component").select("digest", "copy_id", "class_id", "n_links", "component")
    return sketches.select("doc_id", "text_hash", "digest").join(by_class, "digest").select("doc_id", "text_hash", "class_id", "copy_id", "n_links", "component")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest id, with all its columns."""
    found = with_components(docs)
    chosen = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")).alias("first"))
    rows = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = cut_lineage(chosen.select("first.doc_id", "first.text_hash"))
    picked = first.join(rows, first.doc_id.eqNullSafe(rows.doc_id) & (first.text_hash == rows.text_hash)).select(first.doc_id.alias("own_id"), first.text_hash.alias("own_hash"), "n")
    picked = cut_lineage(picked)
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    match = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("hash") == F.col("own_hash"))
    single = named.join(picked.where("n = 1"), match, "left_semi").select("row.*")
    # Rows that repeat both id and text count once.
    repeated = named.join(picked.where("n > 1"), match, "left_semi").groupBy("id", "hash").agg(F.first("row").alias("row")).select("row.*")
    return single.unionAll(repeated)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, CASE WHEN len(plain) > 0 THEN plain ELSE whole END AS w FROM (
    SELECT doc_id, regexp_extract_all(lower(COALESCE(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS plain,
      regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS whole FROM documents) AS t
), s AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS g FROM d
), c AS (
  SELECT g, MIN(doc_id) AS copy_id FROM s GROUP BY g
), e AS (
  SELECT copy_id, UNNEST(g) AS x, len(g) AS n FROM c
), p AS (
  SELECT a.copy_id AS a, b.copy_id AS b FROM e AS a JOIN e AS b ON a.x = b.x AND a.copy_id <> b.copy_id
  GROUP BY a.copy_id, b.copy_id, a.n, b.n HAVING 5 * COUNT(*) >= 4 * (a.n + b.n - COUNT(*))
), r AS (
  SELECT copy_id AS a, copy_id AS b FROM c UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a
)
SELECT s.doc_id, k.class_id, c.copy_id, COALESCE(l.n, 0) AS n_links
FROM s JOIN c ON s.g = c.g
JOIN (SELECT a, MIN(b) AS class_id FROM r GROUP BY a) AS k ON k.a = c.copy_id
LEFT JOIN (SELECT a, COUNT(*) AS n FROM p GROUP BY a) AS l ON l.a = c.copy_id
"""

"""Importance resampling of documents towards a target's n-grams, with bit-sliced weights.

Features are runs of one and two words; a feature's bucket is the CRC-32 of its bytes modulo
10,000. Counts of all documents and of the target give each bucket a whole gain, and a document's
weight is the floored mean gain of its features. Gumbel noise from the document's id is added, and the
highest quarter of the documents with at least 20 words is drawn, which is sampling without replacement by weight.

A document's bucket counts become bit planes: plane p has a bit for each bucket whose count has bit p. The gains are
cut into planes likewise, apart for either sign. The sum of counts times gains is then the sum over all pairs of planes of 2^(p+q)
times the number of common bits, exactly and in whole numbers.

Cases: null and empty texts have no features and weight 0; a text of one word has one feature; texts are read whole, however
long; with fewer than four such documents at least none need be drawn (the share is floored); a null doc_id hashes as
an empty one and comes last among equal scores; rows equal in score and doc_id are ranked by their counts; an empty target has
no counts, so every gain favours rare buckets. Only doc_id and text of the documents and text of the target are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.llm.chunks import Chunk, chunks, sums_between
from derrick.llm.ranks import with_places
from derrick.session import cut_lineage

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
DRAWN_PERCENT = 25
LONG_WORD = 48  # bytes; longer words are hashed one by one
DOCS_AT_ONCE = 256
_WORDS64 = -(-BUCKETS // 64)

# Word bytes: ASCII letters in lower case, digits, and every byte from 0x80.
_FOLDED = np.zeros(256, np.uint8)
_FOLDED[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLDED[0x41:0x5B] = _FOLDED[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLDED[0x80:] = np.arange(0x80, 0x100)


def _crc_steps() -> np.ndarray:
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = (steps >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (steps & np.uint32(1)))
    return steps


_STEPS = _crc_steps()


def crc_of_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """CRC-32 of each slice, going on from the checksums ``before``: byte by byte over all slices at once."""
    out = before ^ np.uint32(0xFFFFFFFF)
    length = ends - starts
    order = np.argsort(-np.minimum(length, LONG_WORD + 1), kind="stable")
    n_long = int(np.count_nonzero(length > LONG_WORD))
    at, state, left = starts[order[n_long:]], out[order[n_long:]], length[order[n_long:]]
    live = len(left)
    for k in range(int(left.max(initial=0))):
        live = int(np.searchsorted(-left, -k))  # lengths fall, so the longer ones stand first
        state[:live] = _STEPS[(state[:live] ^ data[at[:live] + k]) & np.uint32(0xFF)] ^ (state[:live] >> np.uint32(8))
    out[order[n_long:]] = state
    out ^= np.uint32(0xFFFFFFFF)
    for i in order[:n_long].tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(before[i]))
    return out


def features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and bucket of every feature, and the words of each document."""
    data = _FOLDED[chunk.data]
    starts, ends = chunk.runs(data != 0)
    bounds = np.searchsorted(starts, chunk.bounds)
    doc = np.repeat(np.arange(chunk.n), np.diff(bounds))
    first = crc_of_words(data, starts, ends, np.zeros(len(starts), np.uint32))
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    spaced = ~first[pair]
    spaced = ~(_STEPS[(spaced ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (spaced >> np.uint32(8)))
    second = crc_of_words(data, starts[pair + 1], ends[pair + 1], spaced)
    buckets = np.concatenate([first, second]) % np.uint32(BUCKETS)
    return np.concatenate([doc, doc[pair]]), buckets.astype(np.int64), np.diff(bounds)


def bucket_counts(texts: DataFrame) -> DataFrame:
    """bucket and count over all texts; every task adds its own up first."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                total += np.bincount(features(chunk)[1], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket; at most 10,000 counts of either side reach the driver."""
    s, t = ({r.bucket: r.n for r in bucket_counts(side).collect()} for side in (docs, target))
    all_s, all_t = float(sum(s.values()) + BUCKETS), float(sum(t.values()) + BUCKETS)
    ratio = lambda b: float(t.get(b, 0) + 1) * all_s / (float(s.get(b, 0) + 1) * all_t)
    return np.array([math.floor(1000 * math.log(ratio(b))) for b in range(BUCKETS)], np.int64)


def _pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    wide = np.zeros((len(bits), _WORDS64 * 8), np.uint8)
    packed = np.packbits(bits, axis=1)
    wide[:, : packed.shape[1]] = packed
    return wide.view(np.uint64)


def gain_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Signed power of two and bits of every plane of the gains."""
    planes = []
    for sign in (1, -1):
        size = np.maximum(sign * gain, 0)
        planes += [(sign << q, _pack(((size >> q) & 1)[None, :].astype(bool))[0]) for q in range(int(size.max()).bit_length())]
    return planes


def _sums(doc: np.ndarray, bucket: np.ndarray, n: int, planes: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Counts times gains of documents 0 .. n - 1, from common bits of their planes."""
    key, count = np.unique(doc * BUCKETS + bucket, return_counts=True)
    doc, bucket = key // BUCKETS, key % BUCKETS
    total = np.zeros(n, np.int64)
    for p in range(int(count.max(initial=0)).bit_length()):
        has = (count >> p) & 1 == 1
        rows, line = np.unique(doc[has], return_inverse=True)
        bits = np.zeros((len(rows), BUCKETS), bool)
        bits[line, bucket[has]] = True
        packed = _pack(bits)
        for power, plane in planes:
            total[rows] += (power << p) * np.bitwise_count(packed & plane).sum(axis=1, dtype=np.int64)
    return total


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""

    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = gain_planes(gain)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                doc, bucket, n_words = features(chunk)
                order = np.argsort(doc, kind="stable")
                doc, bucket = doc[order], bucket[order]
                total = np.zeros(chunk.n, np.int64)
                for a in range(0, chunk.n, DOCS_AT_ONCE):
                    b = min(a + DOCS_AT_ONCE, chunk.n)
                    lo, hi = np.searchsorted(doc, [a, b])
                    total[a:b] = _sums(doc[lo:hi] - a, bucket[lo:hi], b - a, planes)
                n_features = np.bincount(doc, minlength=chunk.n)
                mean = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
                ids = batch.column("doc_id").slice(chunk.first, chunk.n)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c.astype(np.int64)) for c in (n_words, n_features, mean)]], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null for those not drawn."""
    weighed = weights(docs, gains(docs, target))
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    eligible = F.col("n_words") >= LEAST_WORDS
    scored = cut_lineage(weighed.select("*", (F.col("weight") + noise).cast("long").alias("score"), eligible.alias("eligible")))
    placed = with_places(scored, ["eligible"], [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("n_features"), F.col("weight")])
    drawn = F.col("eligible") & (F.col("pos") < F.expr(f"n * {DRAWN_PERCENT} div 100"))
    return placed.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("pos") + 1).alias("rank"))


SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce([CAST(b AS BIGINT)] || [CAST(k AS BIGINT) for k in range(8)], lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS steps
), texts AS (
  SELECT TRUE AS is_doc, row_number() OVER () AS row_id, doc_id, text FROM documents UNION ALL SELECT FALSE, row_number() OVER (), NULL, text FROM benchmark
), words AS (
  SELECT is_doc, row_id, doc_id,
    regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), grams AS (
  SELECT is_doc, row_id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM words
), counted AS (
  SELECT is_doc, row_id, gram, COUNT(*) AS n FROM grams GROUP BY ALL
), hashed AS (
  SELECT gram, xor(list_reduce([4294967295] || list_transform(range(1, CAST(len(hex(gram)) / 2 AS BIGINT) + 1), lambda i: CAST('0x' || substr(hex(gram), 2 * i - 1, 2) AS BIGINT)),
    lambda a, c: xor(crc.steps[(xor(a, c) & 255) + 1], a >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT gram FROM counted) g, crc
), bucket AS (
  SELECT bucket, COALESCE(SUM(n) FILTER (is_doc), 0) AS s, COALESCE(SUM(n) FILTER (NOT is_doc), 0) AS t FROM counted JOIN hashed USING (gram) GROUP BY bucket
), total AS (
  SELECT CAST(SUM(s) AS DOUBLE) + 10000 AS s, CAST(SUM(t) AS DOUBLE) + 10000 AS t FROM bucket
), gain AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(b.t AS DOUBLE) + 1) * total.s / ((CAST(b.s AS DOUBLE) + 1) * total.t))) AS BIGINT) AS gain FROM bucket b, total
), summed AS (
  SELECT row_id, CAST(SUM(n) AS BIGINT) AS n_features, CAST(SUM(n * gain) AS BIGINT) AS total FROM counted JOIN hashed USING (gram) JOIN gain USING (bucket) WHERE is_doc GROUP BY row_id
), scored AS (
  SELECT doc_id, len(w) >= 20 AS eligible, COALESCE(n_features, 0) AS n_features, CAST(COALESCE(floor(CAST(total AS DOUBLE) / n_features), 0) AS BIGINT) AS weight,
    CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('7:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) + 0.5e0) / 4294967296e0))) AS BIGINT) AS noise
  FROM words LEFT JOIN summed USING (row_id) WHERE is_doc
), ranked AS (
  SELECT doc_id, n_features, weight, weight + noise AS score, eligible,
    row_number() OVER (PARTITION BY eligible ORDER BY weight + noise DESC, doc_id NULLS LAST, n_features, weight) AS r, COUNT(*) OVER (PARTITION BY eligible) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN eligible AND r <= n * 25 // 100 THEN r END AS rank FROM ranked
"""

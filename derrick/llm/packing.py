"""Best-fit packing of documents into sequences of at most ``LIMIT`` tokens.

Sizes are integers up to ``LIMIT``, so the sorted lists of documents and of gaps are
runs of equal sizes. One sweep goes from the longest pieces to the shortest; each
round matches a run of equal documents with its successor among the gaps (the smallest that
is large enough), the k-th document by rank getting the k-th gap, and the gaps, now smaller, join
the runs of their new size before the next round. What finds no gap opens new sequences.

The sweep needs only the number of pieces of each size (at most ``LIMIT`` counts,
whatever the input), so its schedule is made once; ranks of the pieces are
dealt out in Spark, slice by slice, and every piece finds its place by its size and rank.

Cases: null counts as empty; an empty document is the end token alone. Longer
documents are cut: the first piece takes the remainder, the others are full. Documents
are never merged or dropped; equal rows are packed one by one. ``sequence_id`` numbers
the sequences from 0. Only doc_id and text are read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrick.llm.byte_bpe import ByteBpe, Encoded
from derrick.llm.chunks import chunks
from derrick.session import cut_lineage

LIMIT = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n_ids: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document with ``n_ids`` ids, the end token included."""
    first = n_ids % limit or min(n_ids, limit)
    return [(0, first)] + [(at, limit) for at in range(first, n_ids, limit)]


@dataclass
class Schedule:
    """Where the pieces of a size with ranks from ``first`` on go: consecutive sequences, one offset."""

    size: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.size * (1 << 48) + self.first, size * (1 << 48) + rank, "right") - 1
        return self.sequence[at] + rank - self.first[at], self.offset[at]


def best_fit(counts: dict[int, int], limit: int = LIMIT) -> Schedule:
    """Best fit by decreasing size on runs: ``counts`` has the number of pieces of each size."""
    runs: list[tuple[int, int, int, int]] = []
    gaps: dict[int, list[list[int]]] = {}  # gap -> runs of [first sequence, number]
    sizes: list[int] = []  # the gaps that exist, sorted
    opened = 0

    def add(gap: int, sequence: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append([sequence, n])

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            k = bisect.bisect_left(sizes, size)
            if k == len(sizes):
                # No gap is large enough: open as many sequences as full stacks of this size need.
                sequence, n = opened, -(-left // (limit // size))
                opened += n
                gap = limit
            else:
                gap = sizes[k]
                sequence, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(k)
            used = min(n, left)
            runs.append((size, rank, sequence, limit - gap))
            if used < n:
                add(gap, sequence + used, n - used)
            add(gap - size, sequence, used)
            rank += used
            left -= used
    table = np.array(runs, np.int64).reshape(-1, 4)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    return Schedule(*table.T, opened)


def _cut_rows(doc_ids: pa.Array, found: Encoded, limit: int) -> pa.RecordBatch:
    which, piece, start, length, check = [], [], [], [], []
    for doc, (a, b) in enumerate(zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist(), strict=True)):
        ids = np.append(found.ids[a:b], np.uint32(END_ID)).astype("<u4")
        for k, (at, n) in enumerate(cut(len(ids), limit)):
            which.append(doc)
            piece.append(k)
            start.append(at)
            length.append(n)
            check.append(zlib.crc32(ids[at : at + n].tobytes()))
    numbers = [pa.array(piece, pa.int32())] + [pa.array(c, pa.int64()) for c in (start, length, check)]
    return pa.RecordBatch.from_arrays([doc_ids.take(pa.array(which, pa.int64())), *numbers], names=["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """The pieces of every document with start, length and checksum of their ids."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.shared(path)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                yield _cut_rows(batch.column("doc_id").slice(chunk.first, chunk.n), bpe.encode(chunk), limit)

    return docs.select("doc_id", "text").mapInArrow(encode, PIECES)


def pack(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    # Slices are the tasks that wrote the table; being written, they stay as they are.
    cuts = cut_lineage(pieces(docs, path, limit).withColumn("slice", F.spark_partition_id()))
    per_slice = cut_lineage(cuts.groupBy("length", "slice").agg(F.count("*").alias("n")))
    counts = {r.length: r.n for r in per_slice.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    schedule = best_fit(counts, limit)

    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_slice.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("slice", "length").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cuts.withColumn("rank", F.row_number().over(within) - 1).join(firsts, ["slice", "length"])
    sent = docs.sparkSession.sparkContext.broadcast(schedule)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = sent.value.places(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            kept = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    rows = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    return rows.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")

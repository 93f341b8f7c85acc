"""Document scoring by masked pseudo-likelihood.

A small network sees ``REACH`` words on each side of a hidden word and predicts it;
a document's score is the sum of the log-probabilities of all its words. Words are
ids below ``SIDE * SIDE``: the most frequent words of the whole corpus have one
each, the others share ``RARE`` ids by their last bytes. An id is predicted in two digits,
the second given the first, so that a prediction costs twice ``SIDE`` outputs. A word of a shared id
also has its share of the id's words, from the counts of all words, which stay a distributed
table and are met by a join; ``UNSEEN`` counts are kept for words that the corpus doesn't have.

Texts are split and hashed twice: for the counts and to write every document's ids, two bytes a word. Rounds and scores read
the ids. Words that occur at least once in ``LISTED`` words of the corpus, of which there can be no more than ``LISTED``, have their counts in the tasks;
only the others go through the join.

Training takes every position of every document, dealt over the rounds (each position is a target in one of them).
Documents are dealt by a hash of doc_id and ids to slices of about ``SLICE`` words, sorted in each: so what a slice learns
doesn't depend on how the rows were stored, on the number of tasks or of executors. The number of slices grows with the words of the corpus. A slice's
weights are averaged with the others' in proportion to what it saw; averages are summed in Spark as a stream per block of
weights; only one set of weights, whose size doesn't depend on the input, reaches the driver. Rows that agree in doc_id and text are in one slice; they stream
through it, so many of them cost time but no memory.

Cases: null, empty and word-less texts have 0 words, log_prob 0 and no mean. Neighbours beyond
the ends of a document count as blanks. Equal texts get equal scores. A corpus without words gives the
untrained network. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.llm.chunks import Chunk, chunks, mix, sums_between
from derrick.session import cut_lineage

SIDE = 64
WORDS = SIDE * SIDE
RARE = 1024
REACH = 2
WIDTH = 24
ROUNDS = 2
BATCH = 4096
SHORT = 8
RATE = 0.1
BLOCK = 4096  # weights per row when averages are summed
BLANK = WORDS
UNSEEN = 0.5
LISTED = 1 << 20  # words with a larger share of the corpus than 1 / LISTED are listed with their counts
SLICE = 1 << 22  # words that one copy of the weights is trained on, about
MOST_TASKS = 1 << 16  # beyond this many slices a task trains several, one after the other
POINT = 2**28  # logarithms are summed as whole multiples of 1 / POINT, so that no order changes a sum


@dataclass
class Vocabulary:
    """Sorted hashes of the listed words, the id and the count of each, and how often each id occurs."""

    hashes: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    own: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __call__(self, chunk: Chunk) -> np.ndarray:
        """The id of every word of a chunk."""
        return self.find(chunk)[0]

    @cached_property
    def _index(self) -> tuple[int, np.ndarray, np.ndarray]:
        """Bits to drop from a hash, the first place of every value of the rest, and the hashes with the largest behind them."""
        bits = min(len(self.hashes).bit_length() + 2, 21)
        drop = 64 - bits
        size = np.bincount((self.hashes >> np.uint64(drop)).astype(np.int64), minlength=1 << bits)
        return drop, (np.cumsum(size) - size).astype(np.int32), np.append(self.hashes, np.uint64(2**64 - 1))

    def _place(self, hashes: np.ndarray) -> np.ndarray:
        """``np.searchsorted(self.hashes, hashes)``: the hashes' first bits give a place from which it is a step or two."""
        drop, starts, known = self._index
        at = starts.take((hashes >> np.uint64(drop)).astype(np.int64)).astype(np.int64)
        behind = np.flatnonzero(known.take(at) < hashes)
        while len(behind):
            at[behind] += 1
            behind = behind[known.take(at.take(behind)) < hashes.take(behind)]
        return at

    def find(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The id of every word of a chunk, and its place in the list (-1: not listed)."""
        hashes = chunk.word_hashes
        if not len(self.hashes):
            return rare_id(chunk), np.full(len(hashes), -1)
        at = np.minimum(self._place(hashes), len(self.hashes) - 1)
        ids, others = self.ids[at], np.flatnonzero(self.hashes[at] != hashes)
        ids[others], at[others] = rare_id(chunk, others), -1
        return ids, at


def rare_id(chunk: Chunk, at=slice(None)) -> np.ndarray:
    """The id that a word, or the words ``at`` some places, shares with others of the same last two bytes and about the same length."""
    starts, ends = (x[at] for x in chunk.words)
    size = ends - starts
    last = chunk.data[ends - 1].astype(np.uint64)
    second = np.where(size > 1, chunk.data[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
    key = (np.minimum(size, 15) // 3).astype(np.uint64) << np.uint64(16) | second << np.uint64(8) | last
    return (mix(key) % np.uint64(RARE)).astype(np.int64) + WORDS - RARE


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for chunk in chunks(batch.column("text")):
            # First within a chunk, which a core's cache holds, so that fewer words are sorted together.
            order = np.argsort(chunk.word_hashes)
            ranked = chunk.word_hashes.take(order)
            firsts = _firsts(ranked)
            found.append((ranked.take(firsts), rare_id(chunk, order.take(firsts)), np.diff(np.append(firsts, len(ranked)))))
        if found:
            hashes, rare, times = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            firsts = _firsts(ranked)
            sums = np.add.reduceat(times[order], firsts) if len(firsts) else times
            yield pa.RecordBatch.from_arrays([pa.array(ranked[firsts].view(np.int64)), pa.array(rare[order[firsts]]), pa.array(sums)], names=["word", "rare", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """word (hash), rare (its shared id) and n for every word of all documents."""
    words = docs.select("text").mapInArrow(_counted, "word long, rare long, n long").groupBy("word").agg(F.min("rare").alias("rare"), F.sum("n").alias("n"))
    return cut_lineage(words)


def vocabulary(docs: DataFrame, words: DataFrame | None = None) -> Vocabulary:
    """The most frequent of all words get ids of their own; ``words`` are the counts if they are known."""
    words = word_counts(docs) if words is None else words
    top = words.orderBy(F.desc("n"), "word").limit(WORDS - RARE).toArrow()
    counts = np.zeros(WORDS)
    counts[: top.num_rows] = top.column("n").to_numpy()
    rest = words.groupBy("rare").agg(F.sum("n").alias("n")).toArrow()
    counts[rest.column("rare").to_numpy()] = rest.column("n").to_numpy()
    # The frequent words' own counts are in their shared id as well; they are taken out again.
    np.subtract.at(counts, top.column("rare").to_numpy(), top.column("n").to_numpy())
    often = words.filter(F.col("n") >= max(1, int(counts.sum()) // LISTED + 1)).toArrow() if counts.sum() >= LISTED else top
    listed, which = np.unique(np.concatenate([t.column("word").to_numpy().view(np.uint64) for t in (top, often)]), return_index=True)
    ids, own = (np.concatenate(x)[which] for x in ((np.arange(top.num_rows), often.column("rare").to_numpy()), (top.column("n").to_numpy(), often.column("n").to_numpy())))
    return Vocabulary(listed, ids.astype(np.int64), counts, own)


class Network:
    """Weights by name in one flat array, so that averaging needs no knowledge of their shapes."""

    SHAPES = {
        "embed": (WORDS + 1, WIDTH),
        "place": (2 * REACH, WIDTH),
        "first": (WIDTH, SIDE),
        "first_bias": (SIDE,),
        "given": (SIDE, WIDTH),
        "second": (WIDTH, SIDE),
        "second_bias": (SIDE, SIDE),
    }

    def __init__(self, flat: np.ndarray):
        self.flat, self.w, at = flat, {}, 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            self.w[name] = flat[at : at + size].reshape(shape)
            at += size

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(shape)) for shape in cls.SHAPES.values())

    @classmethod
    def fresh(cls, counts: np.ndarray, seed: int = 3) -> Network:
        """Random weights; the biases start at the smoothed word frequencies."""
        net = cls(np.random.default_rng(seed).normal(0, 0.05, cls.size()).astype(np.float32))
        net.w["embed"][BLANK] = 0
        net.w["place"][:] = 1
        table = (counts + 0.5).reshape(SIDE, SIDE)
        net.w["first_bias"][:] = np.log(table.sum(1) / table.sum())
        net.w["second_bias"][:] = np.log(table / table.sum(1, keepdims=True))
        return net

    def _placed(self) -> np.ndarray:
        """What each word adds to the hidden layer from each place."""
        return self.w["embed"] * self.w["place"][:, None, :]

    def _hidden(self, placed: np.ndarray, context: np.ndarray) -> np.ndarray:
        out = placed[0].take(context[:, 0], axis=0)
        for k in range(1, len(placed)):
            out += placed[k].take(context[:, k], axis=0)
        return np.tanh(out, out=out)

    def _of_words(self, rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``embed`` and ``place`` from those of the hidden layer, over the words that occur."""
        sums, found = _sum_by_key(rows, keys)
        embed, place = np.zeros_like(self.w["embed"]), np.zeros_like(self.w["place"])
        cuts = np.searchsorted(found, np.arange(len(place) + 1) * (WORDS + 1))
        for k, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            words = found[low:high] - k * (WORDS + 1)
            place[k] = (sums[low:high] * self.w["embed"].take(words, axis=0)).sum(0)
            embed[words] = embed.take(words, axis=0) + sums[low:high] * self.w["place"][k]
        return embed, place

    def log_probs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        out, w, placed = np.empty(len(target)), self.w, self._placed()
        for at in range(0, len(target), BATCH):
            high, low = np.divmod(target[at : at + BATCH], SIDE)
            hidden = self._hidden(placed, context[at : at + BATCH])
            inner = hidden + w["given"].take(high, axis=0)
            first, second = hidden @ w["first"], np.tanh(inner, out=inner) @ w["second"]
            first += w["first_bias"]
            second += w["second_bias"].take(high, axis=0)
            out[at : at + BATCH] = _log_softmax_at(first, high) + _log_softmax_at(second, low)
        return out

    def step(self, context: np.ndarray, target: np.ndarray, scale: dict[str, np.ndarray], rate: float = RATE) -> None:
        """One step of gradient ascent on the mean log-probability, scaled by past squares."""
        w, n = self.w, len(target)
        # In the order of the first digit, so that what belongs to one of its values is a run.
        order = np.argsort((target // SIDE).astype(np.uint8), kind="stable")
        context, (high, low) = context.take(order, axis=0), np.divmod(target[order], SIDE)
        firsts = _firsts(high)
        present = high[firsts]
        size = np.diff(np.append(firsts, n))
        hidden = self._hidden(self._placed(), context)
        d_first = hidden @ w["first"]
        d_first += w["first_bias"]
        _error(d_first, high)
        inner = np.repeat(w["given"][present], size, axis=0)
        inner += hidden
        np.tanh(inner, out=inner)
        d_second = inner @ w["second"]
        d_second += np.repeat(w["second_bias"][present], size, axis=0)
        _error(d_second, low)
        d_inner = d_second @ w["second"].T
        d_inner *= 1 - inner**2
        d_hidden = d_first @ w["first"].T
        d_hidden += d_inner
        d_hidden *= 1 - hidden**2
        embed, place = self._of_words(d_hidden, context + PLACES)
        grads = {
            "second": inner.T @ d_second,
            "second_bias": _sum_runs(d_second, firsts, present, SIDE),
            "given": _sum_runs(d_inner, firsts, present, SIDE),
            "first": hidden.T @ d_first,
            "first_bias": d_first.sum(0),
            "place": place,
            "embed": embed,
        }
        grads["embed"][BLANK] = 0
        for name, g in grads.items():
            g /= n
            scale[name] += g**2
            w[name] += rate * g / (np.sqrt(scale[name]) + 1e-4)


PLACES = np.arange(2 * REACH) * (WORDS + 1)


def _largest(x: np.ndarray) -> np.ndarray:
    """``x.max(1, keepdims=True)`` of outputs, as maxima of runs, which numpy calls up faster for short rows."""
    return np.maximum.reduceat(x.reshape(-1), np.arange(len(x)) * SIDE)[:, None] if len(x) else x[:, :1]


def _log_softmax_at(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax of each row at one of its columns; overwrites ``x``."""
    x -= _largest(x)
    hit = x.take(np.arange(len(x)) * SIDE + at)
    return hit - np.log(np.exp(x, out=x) @ np.ones(SIDE, np.float32))


def _error(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One at the hit column of each row, less the softmax of the row; overwrites ``x``."""
    x -= _largest(x)
    np.exp(x, out=x)
    x /= -(x @ np.ones((SIDE, 1), np.float32))
    x[np.arange(len(x)), at] += 1
    return x


def _firsts(ranked: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, int)


def _sum_runs(rows: np.ndarray, firsts: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, rows.shape[1]), np.float32)
    if len(firsts):
        out[at] = np.add.reduceat(rows, firsts, axis=0)
    return out


def _sum_short_runs(rows: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of runs of rows of which most are short: those of up to ``SHORT`` rows are added up side by side, longer ones run by run."""
    sums, size = rows.take(firsts, axis=0), np.diff(np.append(firsts, len(rows)))
    long = np.flatnonzero(size > SHORT)
    if len(long):
        ends = np.cumsum(size[long])
        within = np.arange(ends[-1]) + np.repeat(firsts[long] - ends + size[long], size[long])
        sums[long] = np.add.reduceat(rows.take(within, axis=0), ends - size[long], axis=0)
    short = np.flatnonzero((size > 1) & (size <= SHORT))
    short = short[np.argsort(-size[short], kind="stable")]
    if len(short):
        begin, reach = firsts[short], np.searchsorted(-size[short], -np.arange(SHORT + 1), "right")
        rest = rows.take(begin + 1, axis=0)
        for k in range(2, size[short[0]]):
            rest[: reach[k + 1]] += rows.take(begin[: reach[k + 1]] + k, axis=0)
        sums[short] = sums.take(short, axis=0) + rest
    return sums


def _sum_by_key(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows per place and word that occur, and their keys in order, by a radix sort of the keys (below 2^16)."""
    flat = keys.ravel().astype(np.uint16)
    order = np.argsort(flat, kind="stable")
    ranked = flat[order]
    firsts = _firsts(ranked)
    return _sum_short_runs(rows.take(order // keys.shape[1], axis=0), firsts), ranked[firsts].astype(np.int64)


def contexts(ids: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ids of the neighbours of the positions ``at``; blanks beyond the ends of their documents."""
    size = np.diff(bounds)
    # Blanks stand between the documents, so that a place near the end of one has them as neighbours.
    moved = np.arange(len(ids)) + np.repeat(REACH * np.arange(1, len(size) + 1), size)
    spaced = np.full(len(ids) + REACH * (len(size) + 1), BLANK)
    spaced[moved] = ids
    steps = np.array([*range(-REACH, 0), *range(1, REACH + 1)])
    return spaced.take(moved.take(at)[:, None] + steps)


def _coded(words: Vocabulary):
    """Ids of every document, two bytes a word, and its shared-id words: what the listed ones add up to, the others one by one."""
    logs = np.round(np.log(np.maximum(words.own, 1)) * POINT).astype(np.int64)

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                (ids, listed), bounds = words.find(chunk), chunk.word_bounds
                shared = ids >= WORDS - RARE
                own = np.zeros(len(ids), np.int64)
                own[shared & (listed >= 0)] = logs[listed[shared & (listed >= 0)]]
                at = np.flatnonzero(shared & (listed < 0))
                doc, hashes = np.repeat(np.arange(chunk.n), np.diff(bounds)).take(at), chunk.word_hashes.take(at)
                order = np.argsort(hashes)
                order = order.take(np.argsort(doc.take(order).astype(np.min_scalar_type(chunk.n)), kind="stable"))
                doc, hashes = doc.take(order), hashes.take(order)
                first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1]))) if len(at) else np.zeros(0, int)
                cuts = pa.array(np.searchsorted(doc[first], np.arange(chunk.n + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (hashes[first].view(np.int64), np.diff(np.append(first, len(at))))]
                data = pa.py_buffer(ids.astype("<u2").tobytes())
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), chunk.n, [None, pa.py_buffer((bounds * 2).astype(np.int64).tobytes()), data])
                columns = [batch.column("doc_id").slice(chunk.first, chunk.n), packed.cast(pa.binary()), pa.array(sums_between(own, bounds)), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "listed", "others", "times"])

    return coded


def coded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """doc_id, ids, listed, others and times of every document, written once."""
    schema = "doc_id long, ids binary, listed long, others array<long>, times array<long>"
    rows = docs.select("doc_id", "text").mapInArrow(_coded(words), schema)
    return cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))


def _unpacked(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First document, ids and bounds of stretches of about ``limit`` words; a document stays whole."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] // 2
    data = np.frombuffer(data, "<u2") if data is not None and data.size else np.zeros(0, "<u2")
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, data[offsets[at] : offsets[end]].astype(np.int64), offsets[at : end + 1] - offsets[at]
        at = end


def _train_once(flat: np.ndarray, round_: int, rounds: int = ROUNDS):
    """Train a copy of the weights on each slice of a task; returns their weighted sum in blocks."""

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen, own = np.zeros(len(flat)), 0, 0
        current, net, scale, waiting = None, None, {}, []

        def close() -> None:
            nonlocal total, seen, own
            if net is not None:
                own += _steps(net, waiting, scale, True)
                total += net.flat.astype(np.float64) * own
                seen, own = seen + own, 0

        for batch in batches:
            slices = batch.column("slice").to_numpy()
            cuts = [0, *(np.flatnonzero(slices[1:] != slices[:-1]) + 1), len(slices)]
            for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if stop == start:
                    continue
                if slices[start] != current:
                    close()
                    current, net, waiting = slices[start], Network(flat.copy()), []
                    scale = {name: np.zeros(shape, np.float32) for name, shape in Network.SHAPES.items()}
                for _, ids, bounds in _unpacked(batch.column("ids").slice(start, stop - start)):
                    place = np.arange(len(ids)) - np.repeat(bounds[:-1], np.diff(bounds))
                    # Dealt by a hash, as text with a period would give a round one kind of word only.
                    deal = mix((place + np.repeat(np.diff(bounds), np.diff(bounds))).astype(np.uint64))
                    at = np.flatnonzero(deal % np.uint64(rounds) == np.uint64(round_))
                    waiting.append((contexts(ids, bounds, at), ids[at]))
                    if sum(len(t) for _, t in waiting) >= BATCH:
                        own += _steps(net, waiting, scale, False)
        close()
        if seen:
            parts = [total[a : a + BLOCK] for a in range(0, len(total), BLOCK)]
            columns = [pa.array(range(len(parts)), pa.int32()), pa.array([seen] * len(parts), pa.int64()), pa.array(parts, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "seen", "weights"])

    return train


def _steps(net: Network, waiting: list, scale: dict, all_of_it: bool) -> int:
    if not waiting:
        return 0
    context, target = (np.concatenate(x) for x in zip(*waiting, strict=True))
    n = len(target) if all_of_it else len(target) // BATCH * BATCH
    for at in range(0, n, BATCH):
        net.step(context[at : min(at + BATCH, n)], target[at : min(at + BATCH, n)], scale)
    waiting[:] = [] if n == len(target) else [(context[n:], target[n:])]
    return n


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the rows of a block as they stream by."""
    total: dict[int, list] = {}
    for batch in batches:
        for block, seen, weights in zip(*(batch.column(c) for c in ("block", "seen", "weights")), strict=True):
            own = total.setdefault(block.as_py(), [0, 0.0])
            own[0] += seen.as_py()
            own[1] = own[1] + weights.values.to_numpy()
    columns = [pa.array(total, pa.int32()), pa.array([x[0] for x in total.values()], pa.int64()), pa.array([x[1] for x in total.values()], pa.list_(pa.float64()))]
    yield pa.RecordBatch.from_arrays(columns, names=["block", "seen", "weights"])


def fitted(rows: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Network:
    """Rounds of training on all slices of coded documents, each followed by the average of their weights; together they take every position once."""
    schema = "block int, seen long, weights array<double>"
    net = Network.fresh(words.counts)
    slices = max(1, -(-int(words.counts.sum()) // SLICE))
    tasks = min(slices, MOST_TASKS)
    dealt = rows.select("doc_id", "ids", F.pmod(F.xxhash64("doc_id", "ids"), F.lit(slices)).alias("slice"))
    for round_ in range(rounds):
        placed = dealt.repartitionById(tasks, F.pmod("slice", F.lit(tasks)).cast("int")).sortWithinPartitions("slice", "doc_id", "ids")
        weights = placed.select("slice", "ids").mapInArrow(_train_once(net.flat, round_, rounds), schema)
        mean = weights.repartition("block").mapInArrow(_summed, schema).toArrow().sort_by("block")
        if mean.num_rows:
            flat = np.concatenate([w.values.to_numpy() / s.as_py() for w, s in zip(mean.column("weights"), mean.column("seen"), strict=True)])
            net = Network(flat.astype(np.float32))
    return net


def train(docs: DataFrame, words: Vocabulary, rounds: int = ROUNDS) -> Network:
    """Fit the network on the documents."""
    return fitted(coded(docs, words), words, rounds)


def _scored(words: Vocabulary, flat: np.ndarray):
    """The network's sums per coded document, and the logarithms of all counts of the ids that its shared-id words have."""
    logs = np.log(words.counts + UNSEEN)
    logs[: WORDS - RARE] = 0

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network(flat)
        for batch in batches:
            for first, ids, bounds in _unpacked(batch.column("ids")):
                n, last = np.diff(bounds), np.minimum(bounds[:-1], len(ids))
                found = model.log_probs(contexts(ids, bounds, np.arange(len(ids))), ids)
                sums = [np.where(n > 0, np.add.reduceat(np.append(x, 0.0), last), 0.0) for x in (found, logs[ids])]
                columns = [batch.column(c).slice(first, len(n)) for c in ("row", "doc_id", "listed")]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, (n, *sums))], names=["row", "doc_id", "listed", "n_words", "log_prob", "totals"])

    return scored


def scored(coded_rows: DataFrame, words: Vocabulary, net: Network, counts: DataFrame | None = None) -> DataFrame:
    """``score`` on coded documents."""
    schema = "row long, doc_id long, listed long, n_words long, log_prob double, totals double"
    rows = coded_rows.select("row", "doc_id", "listed", "ids").mapInArrow(_scored(words, net.flat), schema)
    if counts is not None:
        others = coded_rows.select("row", "times", F.posexplode("others").alias("at", "word")).select("row", "word", F.get("times", "at").alias("times"))
        # Once per word of the corpus, not per place; a word the corpus doesn't have counts as UNSEEN. The table of counts has a word once and none
        # that is frequent comes to the join, so its parts are even and small enough to be hashed.
        share, unseen = (F.round(F.log(n) * POINT).cast("long") for n in (F.col("n").cast("double"), F.lit(UNSEEN)))
        known = counts.select("word", share.alias("share")).hint("shuffle_hash")
        own = others.join(known, "word", "left").groupBy("row").agg(F.sum(F.col("times") * F.coalesce("share", unseen)).alias("own"))
        shares = (F.coalesce("own", F.lit(0)) + F.col("listed")) / POINT
        rows = rows.join(own, "row", "left").withColumn("log_prob", F.col("log_prob") + shares - F.col("totals"))
    mean = F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words"))
    return rows.select("doc_id", "n_words", "log_prob", mean.alias("mean_log_prob"))


def score(docs: DataFrame, words: Vocabulary, net: Network, counts: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, log_prob (sum over all words) and mean_log_prob of every document.

    With ``counts`` (of ``word_counts``) every word has its own probability, without them its id's.
    """
    return scored(coded(docs, words), words, net, counts)


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    """Fit vocabulary and network on the documents and score them."""
    counts = word_counts(docs)
    words = vocabulary(docs, counts)
    rows = coded(docs, words)
    return scored(rows, words, fitted(rows, words), counts)

"""Byte-level BPE encoding and decoding without regular expressions.

Pre-tokenisation works on arrays: every code point gets a class, a class is a
transition function over eight states, and functions are composed by an
associative doubling scan until all are constant (two or three steps, as only
apostrophes and what follows them look back). State before a code point and its class
say whether a piece starts there. The pieces are the matches of the public pattern
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.

Distinct pieces are merged pair by pair, lowest rank first, leftmost first, all
at once as rows of a matrix; a store of bounded size keeps them, and long pieces use a heap. ``Encoded.offsets`` keeps the byte at which each id starts,
so that any span of ids can be decoded or traced to its text.

Cases: null counts as empty, empty texts have no ids; every text is taken whole;
with a file of lines special strings are
ordinary text, while the added tokens that a JSON file lists are found first, leftmost and longest, and are one id each, as its library has it; the text
between them is cut into pieces by itself. Character classes are those of Unicode 16. Equal rows stay equal rows; only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from derrick.llm.chunks import Chunk, chunks

OTHER, SPACE, WHITE, APOSTROPHE, NUMBER, LETTER, ONE_TAIL, TWO_TAIL = range(8)
# States: what the code points so far leave open for the next one.
FREE, AFTER_SPACE, IN_LETTERS, IN_NUMBER, IN_OTHER, QUOTE, TAIL_DONE, TAIL_HALF = range(8)

STORED_PIECES = 300_000
NO_PAIR = 1 << 60
# Pieces of these byte lengths are merged together as rows of a matrix; longer ones use the heap.
WIDTHS = [(0, 4), (4, 8), (8, 12), (12, 16), (16, 24), (24, 40)]

# The white space of the pattern.
WHITE_POINTS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LAST_LETTER = 0x33480  # no letter or number lies beyond
# Letters and numbers that Unicode 16 has and 15.1, the tables of Python 3.13 and before, lacks (first and last code points).
NEWER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEWER_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


def _next_state(state: int, kind: int) -> int:
    if kind == APOSTROPHE:
        return IN_OTHER if state in (AFTER_SPACE, IN_OTHER, QUOTE) else QUOTE
    if kind in (LETTER, ONE_TAIL, TWO_TAIL):
        if state == TAIL_HALF or (state == QUOTE and kind == ONE_TAIL):
            return TAIL_DONE
        return TAIL_HALF if state == QUOTE and kind == TWO_TAIL else IN_LETTERS
    return {SPACE: AFTER_SPACE, WHITE: FREE, NUMBER: IN_NUMBER, OTHER: IN_OTHER}[kind]


def _starts(state: int, kind: int) -> bool:
    if kind in (LETTER, ONE_TAIL, TWO_TAIL):
        return not (state in (AFTER_SPACE, IN_LETTERS, TAIL_HALF) or (state == QUOTE and kind != LETTER))
    if kind == NUMBER:
        return state not in (AFTER_SPACE, IN_NUMBER)
    return state not in (AFTER_SPACE, IN_OTHER, QUOTE)


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The functions that compositions of the classes can make: their products, values at ``FREE``, and which are constant.

    Ids 0 to 7 are the classes, 8 to 15 the constant functions.
    """
    functions = [tuple(_next_state(s, kind) for s in range(8)) for kind in range(8)] + [(s,) * 8 for s in range(8)]
    ids: dict[tuple[int, ...], int] = {}
    for at, f in enumerate(functions):
        ids.setdefault(f, at)
    done = 0
    while done < len(functions):
        done = len(functions)
        for f in functions[:done]:
            for g in functions[:done]:
                both = tuple(g[s] for s in f)
                if both not in ids:
                    ids[both] = len(functions)
                    functions.append(both)
    product = np.array([[ids[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint8)
    return product, np.array([f[FREE] for f in functions], np.uint8), np.array([len(set(f)) == 1 for f in functions])


def _code_classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    table[:LAST_LETTER] = [kinds.get(unicodedata.category(chr(p))[0], OTHER) for p in range(LAST_LETTER)]
    for kind, runs in ((LETTER, NEWER_LETTERS), (NUMBER, NEWER_NUMBERS)):
        for first, last in runs:
            table[first : last + 1] = kind
    table[WHITE_POINTS] = WHITE
    table[0x20], table[0x27] = SPACE, APOSTROPHE
    table[[ord(c) for c in "stmd"]] = ONE_TAIL
    return table


class Pieces:
    """Finds piece boundaries with class arrays and the function scan."""

    def __init__(self) -> None:
        self.classes = _code_classes()
        self.product, self.at_free, self.constant = _monoid()
        self.start = np.array([[_starts(s, kind) for kind in range(8)] for s in range(8)])

    def __call__(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Byte starts of the pieces of all documents of a chunk, and where each document's pieces begin."""
        if not len(chunk.data):
            return np.zeros(0, np.int64), np.zeros(chunk.n + 1, np.int64)
        at = np.flatnonzero(chunk.is_point)
        points = np.frombuffer(chunk.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        kind = self.classes[points]
        follows = np.zeros(len(points), np.uint32)
        follows[:-1] = points[1:]
        kind[(((points == 0x72) | (points == 0x76)) & (follows == 0x65)) | ((points == 0x6C) & (follows == 0x6C))] = TWO_TAIL
        bounds = np.searchsorted(at, chunk.bounds)
        filled = bounds[:-1] < bounds[1:]
        firsts, lasts = bounds[:-1][filled], bounds[1:][filled] - 1
        # A tail must end within its document.
        kind[lasts[kind[lasts] == TWO_TAIL]] = LETTER

        f = kind.copy()
        f[firsts] = 8 + self.at_free[kind[firsts]]
        step = 1
        while not self.constant[f].all():
            f[step:] = self.product[f[:-step], f[step:]]
            step *= 2
        before = np.empty(len(f), np.uint8)
        before[1:] = self.at_free[f[:-1]]
        before[firsts] = FREE

        start = self.start[before, kind]
        white = (kind == SPACE) | (kind == WHITE)
        last_white = np.zeros(len(f), bool)
        last_white[:-1] = ~white[1:]
        last_white[lasts] = False
        first_white = np.ones(len(f), bool)
        first_white[1:] = ~white[:-1]
        first_white[firsts] = True
        start[white] = (first_white | last_white)[white]
        starts = at[start]
        return starts, np.searchsorted(starts, chunk.bounds)


def spread(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``values[first : first + size]`` one after the other."""
    total = np.cumsum(sizes)
    if not len(total) or not total[-1]:
        return values[:0]
    return values[np.arange(total[-1]) + np.repeat(first - (total - sizes), sizes)]


class Merger:
    """Pair merging of many pieces at once, and a bounded store of what was merged.

    A piece is known by its 64-bit hash and its length. Short pieces are rows of a
    matrix of ids: each round merges the lowest-ranked, leftmost pair of every row.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.clear()

    def clear(self) -> None:
        self.slots: dict[int, int] = {}
        self.size = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (left >= 0) & (right >= 0), self.pair_ranks[at], NO_PAIR)

    def _merge_rows(self, rows: np.ndarray) -> np.ndarray:
        """Merge rows of byte ids (-1 behind the end) as far as the ranks go."""
        width = rows.shape[1]
        cost = self._rank(rows[:, :-1], rows[:, 1:])
        done = rows.copy()
        live = np.arange(len(rows))
        column = np.arange(width)[None, :]
        while len(live) and width > 1:
            best = cost.argmin(1)
            line = np.arange(len(live))
            rank = cost[line, best]
            ended = rank == NO_PAIR
            if ended.any():
                done[live[ended]] = rows[ended]
                go = ~ended
                live, rows, cost, best, rank = live[go], rows[go], cost[go], best[go], rank[go]
                if not len(live):
                    break
                line = np.arange(len(live))
            take = np.minimum(column + (column > best[:, None]), width - 1)
            rows = np.take_along_axis(rows, take, 1)
            rows[:, -1] = -1
            rows[line, best] = rank
            cost = np.take_along_axis(cost, np.minimum(take[:, : width - 1], width - 2), 1)
            cost[:, -1] = NO_PAIR
            right = np.minimum(best + 1, width - 1)
            cost[line, np.minimum(best, width - 2)] = np.where(best < width - 1, self._rank(rows[line, best], np.where(best < width - 1, rows[line, right], -1)), NO_PAIR)
            inner = np.flatnonzero(best > 0)
            cost[inner, best[inner] - 1] = self._rank(rows[inner, best[inner] - 1], rows[inner, best[inner]])
        return done

    def _merged(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given pieces one after the other, and how many each has."""
        groups = []
        for low, high in WIDTHS:
            own = np.flatnonzero((sizes > low) & (sizes <= high))
            for part in np.array_split(own, max(1, len(own) * high // (1 << 18))):
                if not len(part):
                    continue
                column = np.arange(high)[None, :]
                inside = column < sizes[part, None]
                rows = np.where(inside, self.byte_ids[data[np.minimum(starts[part, None] + column, len(data) - 1)]], -1)
                rows = self._merge_rows(rows)
                held = rows >= 0
                groups.append((part, held.sum(1), rows[held]))
        far = np.flatnonzero(sizes > WIDTHS[-1][1])
        if len(far):
            found = [self._long(data[starts[k] : starts[k] + sizes[k]].tobytes()) for k in far]
            groups.append((far, np.array([len(f) for f in found]), np.array(list(chain.from_iterable(found)), np.int64)))
        order = np.concatenate([g[0] for g in groups])
        n_ids = np.concatenate([g[1] for g in groups])
        flat = np.concatenate([g[2] for g in groups])
        first = np.cumsum(n_ids) - n_ids
        back = np.argsort(order)
        return spread(flat, first[back], n_ids[back]).astype(np.uint32), n_ids[back]

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order, and how many each has."""
        if len(self.slots) > STORED_PIECES:
            self.clear()
        known, at, back = np.unique(keys, return_index=True, return_inverse=True)
        sizes = (ends - starts)[at]
        slot = np.fromiter(map(self.slots.get, known.tolist(), repeat(-1)), np.int64, len(known))
        new = np.flatnonzero(slot < 0)
        if len(new):
            ids, n_ids = self._merged(data, starts[at[new]], sizes[new])
            slot[new] = np.arange(len(self.size), len(self.size) + len(new))
            self.slots.update(zip(known[new].tolist(), slot[new].tolist(), strict=True))
            self.size = np.concatenate([self.size, sizes[new]])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n_ids)])
            self.ids = np.concatenate([self.ids, ids])
        if (self.size[slot] != sizes).any() or (self.size[slot[back]] != ends - starts).any():
            raise ValueError("two pieces share a 64-bit hash; run again with other byte codes")
        own = slot[back]
        n_ids = self.first[own + 1] - self.first[own]
        return spread(self.ids, self.first[own], n_ids), n_ids

    def _long(self, piece: bytes) -> tuple[int, ...]:
        """The same with a heap over linked parts, for pieces of any length."""
        n, ranks = len(piece), self.ranks
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def pair(i: int):
            j = after[i]
            if j < n:
                rank = ranks.get(piece[i : after[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, j, after[j]))

        heap: list[tuple[int, int, int, int]] = []
        for i in range(n - 1):
            pair(i)
        while heap:
            _, i, j, end = heapq.heappop(heap)
            if not (alive[i] and after[i] == j and alive[j] and after[j] == end):
                continue
            alive[j] = False
            after[i] = end
            if end < n:
                before[end] = i
            pair(i)
            if before[i] >= 0:
                pair(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return tuple(out)


@dataclass
class Encoded:
    """Ids of the documents of a chunk, the byte each id starts at, and where each document's ids begin."""

    ids: np.ndarray
    offsets: np.ndarray
    bounds: np.ndarray


def _line_ranks(path: str) -> dict[bytes, int]:
    """A file of lines: token in base64, rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _json_ranks(path: str) -> dict[bytes, int]:
    """A tokenizer file whose vocabulary writes bytes as characters: printable ones as themselves, the others from U+0100 on.

    Ids grow with the merges, so they serve as ranks. Added special tokens are left out.
    """
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}
    return {bytes(map(byte_of.__getitem__, token)): rank for token, rank in vocabulary.items()}


def _json_added(path: str) -> dict[bytes, int]:
    """Texts that the file lists as tokens of their own; matching options other than the plain one are refused."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", [])
    if any(t.get(option) for t in added for option in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"'{path}': added tokens that look at their neighbours")
    return {t["content"].encode(): t["id"] for t in added}


class ByteBpe:
    def __init__(self, path: str):
        self.ranks = _json_ranks(path) if path.endswith(".json") else _line_ranks(path)
        self.added = _json_added(path) if path.endswith(".json") else {}
        self.added_pattern = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))))
        self.tokens = {rank: token for token, rank in self.ranks.items()} | {rank: token for token, rank in self.added.items()}
        self.sizes = np.zeros(max(self.tokens) + 1, np.int64)
        self.sizes[list(self.tokens)] = [len(t) for t in self.tokens.values()]
        self.pieces = Pieces()
        self.merged = Merger(self.ranks)

    @classmethod
    def shared(cls, path: str) -> ByteBpe:
        """One per Python process: workers are reused, task code is not."""
        kept = sys.__dict__.setdefault("_byte_bpe_by_path", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _marks(self, chunk: Chunk) -> np.ndarray:
        """Start, end and id of every added token, none across documents."""
        data = chunk.data.tobytes()
        if not self.added or not self.added_pattern.search(data):
            return np.zeros((0, 3), np.int64)
        edges = chunk.bounds.tolist()
        found = (m for a, b in zip(edges[:-1], edges[1:], strict=True) for m in self.added_pattern.finditer(data, a, b))
        return np.array([(*m.span(), self.added[m.group()]) for m in found], np.int64).reshape(-1, 3)

    def encode(self, chunk: Chunk) -> Encoded:
        marks = self._marks(chunk)
        if not len(marks):
            return self._encode(chunk)
        # Added tokens and what lies between them are encoded as documents; then an added token's ids become its one id.
        edges = np.unique(np.concatenate([chunk.bounds, marks[:, 0], marks[:, 1]]))
        parts = self._encode(Chunk(0, chunk.data, edges))
        at = np.searchsorted(edges, marks[:, 0])
        kept = np.ones(len(parts.ids), np.int64)
        for a, b in zip(parts.bounds[at], parts.bounds[at + 1], strict=True):
            kept[a + 1 : b] = 0
        parts.ids[parts.bounds[at]] = marks[:, 2]
        before = np.append(0, np.cumsum(kept))
        take = kept.astype(bool)
        return Encoded(parts.ids[take], parts.offsets[take], before[parts.bounds[np.searchsorted(edges, chunk.bounds)]])

    def _encode(self, chunk: Chunk) -> Encoded:
        starts, bounds = self.pieces(chunk)
        ends = np.append(starts[1:], len(chunk.data)) if len(starts) else starts
        ids, n_ids = self.merged(chunk.data, starts, ends, chunk.hashes(starts, ends))
        total = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(n_ids, out=total[1:])
        sizes = self.sizes[ids]
        return Encoded(ids, np.cumsum(sizes) - sizes, total[bounds])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the byte offset of each id, for every document."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.shared(path)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                found = bpe.encode(chunk)
                within = found.offsets - np.repeat(chunk.bounds[:-1], np.diff(found.bounds))
                bounds = pa.array(found.bounds.astype(np.int32))
                columns = [
                    batch.column("doc_id").slice(chunk.first, chunk.n),
                    pa.ListArray.from_arrays(bounds, pa.array(found.ids.astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(within)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "offsets"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids array<int>, offsets array<long>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode every text, decode the ids again, and give digests of both: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.shared(path)
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                found = bpe.encode(chunk)
                own = [found.ids[a:b] for a, b in zip(found.bounds[:-1], found.bounds[1:], strict=True)]
                columns = [
                    batch.column("doc_id").slice(chunk.first, chunk.n),
                    pa.array(np.diff(found.bounds)),
                    pa.array([hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids in own], pa.string()),
                    pa.array([hashlib.sha256(bpe.decode(ids)).hexdigest() for ids in own], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

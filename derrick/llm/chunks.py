"""Vectorised views of text batches: UTF-8 bytes of many documents at once.

An Arrow string column is one byte buffer with offsets. All text operators walk
it in chunks of about ``CHUNK_BYTES`` (cut only between documents, so that a
document is always whole) and find words, lines and hashes with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

# Word separators: space, and tab to carriage return.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BYTE_CODES = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, CHUNK_BYTES * 2)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (an invertible bit mixer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` per segment; empty segments give 0."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


# Word characters for comparing texts: ASCII letters in lower case, digits, and every byte from 0x80.
_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[0x30:0x3A] = np.arange(0x30, 0x3A)
_PLAIN[0x41:0x5B] = _PLAIN[0x61:0x7B] = np.arange(0x61, 0x7B)
_PLAIN[0x80:] = np.arange(0x80, 0x100)


@dataclass
class Chunk:
    """``data`` holds the bytes of the documents ``first`` .. ``first + n - 1`` of the batch."""

    first: int
    data: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1

    @cached_property
    def _marks(self) -> tuple[np.ndarray, np.ndarray]:
        filled = self.bounds[:-1] < self.bounds[1:]
        return self.bounds[:-1][filled], self.bounds[1:][filled] - 1

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each maximal run of ``inside``; runs don't cross documents."""
        before, after = np.ones(len(inside), bool), np.ones(len(inside), bool)
        np.logical_not(inside[:-1], out=before[1:])
        np.logical_not(inside[1:], out=after[:-1])
        before[self._marks[0]] = True
        after[self._marks[1]] = True
        return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1

    @cached_property
    def in_word(self) -> np.ndarray:
        return ~_SPACE[self.data]

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(self.in_word)

    @cached_property
    def word_bounds(self) -> np.ndarray:
        """Where each document's words begin in ``words``."""
        return np.searchsorted(self.words[0], self.bounds)

    @cached_property
    def plain(self) -> Chunk:
        """The same documents without case (of ASCII and Latin-1 letters) and punctuation."""
        folded = _PLAIN[self.data]
        after_c3 = np.zeros(len(folded), bool)
        after_c3[1:] = self.data[:-1] == 0xC3
        capital = after_c3 & (self.data <= 0x9E) & (self.data >= 0x80) & (self.data != 0x97)
        folded[capital] += 0x20
        return Chunk(self.first, folded, self.bounds)

    @cached_property
    def is_point(self) -> np.ndarray:
        """The first byte of each code point."""
        return (self.data & 0xC0) != 0x80

    @cached_property
    def doc_keys(self) -> np.ndarray:
        return mix(np.arange(1, self.n + 1, dtype=np.uint64))

    @cached_property
    def _running(self) -> np.ndarray:
        up, _ = _POWERS.upto(len(self.data))
        out = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[self.data] * up[: len(self.data)], out=out[1:])
        return out

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each slice of bytes."""
        _, down = _POWERS.upto(len(self.data))
        return mix((self._running[ends] - self._running[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return self.hashes(*self.words)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each window of ``size`` words within a document, and the index of its first word."""
        hashes, bounds = self.word_hashes, self.word_bounds
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for k in range(size):
            total = total * _BASE + hashes[k : k + n]
        last = np.repeat(bounds[1:], np.diff(bounds))[:n]
        at = np.flatnonzero(np.arange(n) + size <= last)
        return mix(total[at]), at


def chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The documents of an Arrow string column in order; null counts as empty."""
    parts = texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]
    base = 0
    for part in parts:
        part = part.cast(pa.large_string()).fill_null("")
        n = len(part)
        if not n:
            continue
        _, offsets, data = part.buffers()
        offsets = np.frombuffer(offsets, np.int64)[part.offset : part.offset + n + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield Chunk(base + at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
            at = end
        base += n

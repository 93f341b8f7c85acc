"""Statistics of whole documents for the quality models, counted with numpy on UTF-8 bytes.

``COUNTS`` are exact integers; ``FEATURES`` are ratios made from them. Null
and empty texts have zero counts and zero features.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from derrick.llm.chunks import Chunk, chunks, mix, sums_between

REPEAT_WINDOW = 8

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "log_words",
    "word_length",
    "symbols_per_word",
    "upper_share",
    "digit_share",
    "punctuation_share",
    "stress_per_word",
    "bar_per_word",
    "letter_words_share",
    "same_as_last_share",
    "repeat_share",
    "dup_line_share",
    "words_per_line",
    "long_word_share",
]
SCHEMA = ", ".join([f"{c} long" for c in COUNTS] + [f"{c} double" for c in FEATURES])


def _byte_table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_SYMBOL = _byte_table("#*$%&|<>")
_UPPER = _byte_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _byte_table("0123456789")
_LETTER = _UPPER | _byte_table("abcdefghijklmnopqrstuvwxyz")
_LETTER[0x80:] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[0x21:0x7F] = True
_PUNCTUATION &= ~(_LETTER | _DIGIT | _SYMBOL)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Marks the keys that occur twice or more."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.zeros(len(keys), bool)
    equal = ranked[1:] == ranked[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    out = np.zeros(len(keys), bool)
    out[order[same]] = True
    return out


def counts(chunk: Chunk) -> dict[str, np.ndarray]:
    """The base counts of the contract for each document of a chunk."""
    starts, ends = chunk.words
    bounds = chunk.word_bounds
    n_words = np.diff(bounds)

    keys, at = chunk.windows(REPEAT_WINDOW)
    doc_of_word = np.repeat(np.arange(chunk.n), n_words)
    twice = at[_repeated(mix(keys + chunk.doc_keys[doc_of_word[at]]))] if len(at) else at
    cover = np.zeros(len(starts) + REPEAT_WINDOW + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + REPEAT_WINDOW, -1)
    covered = np.cumsum(cover)[: len(starts)] > 0

    line_starts, line_ends = chunk.runs(chunk.data != 0x0A)
    filled = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    line_starts, line_ends = line_starts[filled], line_ends[filled]
    line_bounds = np.searchsorted(line_starts, chunk.bounds)
    n_lines = np.diff(line_bounds)
    doc_of_line = np.repeat(np.arange(chunk.n), n_lines)
    line_keys = mix(chunk.hashes(line_starts, line_ends) + chunk.doc_keys[doc_of_line])
    _, firsts = np.unique(line_keys, return_index=True)
    distinct = np.bincount(doc_of_line[firsts], minlength=chunk.n)

    return {
        "n_words": n_words,
        "word_chars": sums_between(chunk.in_word & chunk.is_point, chunk.bounds),
        "n_symbols": sums_between(_SYMBOL[chunk.data], chunk.bounds),
        "n_dup_lines": n_lines - distinct,
        "n_repeat_words": sums_between(covered, bounds),
        "n_lines": n_lines,
    }


def features(chunk: Chunk, base: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    data, bounds, word_bounds = chunk.data, chunk.bounds, chunk.word_bounds
    starts, ends = chunk.words
    words = np.maximum(base["n_words"], 1)
    chars = np.maximum(base["word_chars"], 1)
    lines = np.maximum(base["n_lines"], 1)
    letters = _LETTER[data]
    n_letters = np.maximum(sums_between(letters & chunk.is_point, bounds), 1)
    hashes = chunk.word_hashes
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    firsts = word_bounds[:-1][base["n_words"] > 0]
    same[firsts] = False
    letter_total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(letters, out=letter_total[1:])
    return {
        "log_words": np.log1p(base["n_words"]),
        "word_length": base["word_chars"] / words,
        "symbols_per_word": base["n_symbols"] / words,
        "upper_share": sums_between(_UPPER[data], bounds) / n_letters,
        "digit_share": sums_between(_DIGIT[data], bounds) / chars,
        "punctuation_share": sums_between(_PUNCTUATION[data], bounds) / chars,
        "stress_per_word": sums_between((data == 0x21) | (data == 0x3F), bounds) / words,
        "bar_per_word": sums_between(data == 0x7C, bounds) / words,
        "letter_words_share": sums_between(letter_total[ends] > letter_total[starts], word_bounds) / words,
        "same_as_last_share": sums_between(same, word_bounds) / words,
        "repeat_share": base["n_repeat_words"] / words,
        "dup_line_share": base["n_dup_lines"] / lines,
        "words_per_line": base["n_words"] / lines,
        "long_word_share": sums_between(ends - starts > 20, word_bounds) / words,
    }


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """All statistics of an Arrow string column, one array per name."""
    out: dict[str, list[np.ndarray]] = {name: [] for name in COUNTS + FEATURES}
    for chunk in chunks(texts):
        base = counts(chunk)
        both = base | features(chunk, base)
        for name, parts in out.items():
            parts.append(both[name])
    kinds = {name: np.int64 for name in COUNTS} | {name: np.float64 for name in FEATURES}
    return {name: np.concatenate(parts).astype(kinds[name]) if parts else np.zeros(0, kinds[name]) for name, parts in out.items()}


def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: replaces the column ``text`` by the statistics."""
    for batch in batches:
        stats = measure(batch.column("text"))
        kept = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([batch.column(name) for name in kept] + [pa.array(v) for v in stats.values()], names=[*kept, *stats])

"""Language identification with bit-sliced Bloom filters of n-grams.

A slot of the filter is a word of language bits: the AND of a gram's slots
returns all languages that contain it at once. A document's languages get the
popcount of their bit over its grams, corrected for the known rate of false
positives and for how many of its own grams a language usually recognises; the best
share decides.

Grams are ``GRAM`` bytes of the letters of a text (ASCII and Latin-1 letters in
lower case, every other byte from 0x80 as it is, everything else a space). A language keeps the
grams that occur ``LEAST_COUNT`` times and make up at least ``LEAST_SHARE`` of its learning text, and its
``LEAST_GRAMS`` most frequent ones in any case, so the filter is
bounded whatever the input and no language with a letter is lost. The profiles are learned from the first
``SAMPLE`` documents of each language by the hash of their id.

Cases: a text that is null or has no letter is ``und`` with score 0; a text
none of whose grams is known gets the most frequent learned language with
score 0; ties go to the language that comes first by name; without any learned
language everything is ``und``. Only doc_id, text and, for learning, lang are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrick.llm.chunks import Chunk, chunks, mix, sums_between
from derrick.llm.common import held_out
from derrick.session import cut_lineage

GRAM = 4
SAMPLE = 4_000
LEAST_GRAMS = 500  # of every language, be they ever so rare
LEAST_SHARE = 1e-5
LEAST_COUNT = 3
SLOTS_PER_GRAM = 16
PROBES = 2
UNKNOWN = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def grams(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every gram with a letter and without double spaces, and where each document's grams begin."""
    data = chunk.data
    # A space on either side of each document, so that word edges show and grams don't cross.
    text = np.full(len(data) + 2 * chunk.n, 0x20, np.uint8)
    shift = np.repeat(2 * np.arange(chunk.n) + 1, np.diff(chunk.bounds))
    at = np.arange(len(data)) + shift
    folded = _FOLD[data]
    upper = (data >= 0x80) & (data <= 0x9E)
    upper[1:] &= data[:-1] == 0xC3
    upper[:1] = False
    folded[upper] += 0x20
    text[at] = folded
    bounds = chunk.bounds + 2 * np.arange(chunk.n + 1)
    n = len(text) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(chunk.n + 1, np.int64)
    blank = text == 0x20
    double = blank[:-1] & blank[1:]
    key = np.zeros(n, np.uint64)
    bad = np.zeros(n, bool)
    for k in range(GRAM):
        key = key << np.uint64(8) | text[k : k + n].astype(np.uint64)
        if k + 1 < GRAM:
            bad |= double[k : k + n]
    good = np.flatnonzero(~bad)
    return mix(key[good]), np.searchsorted(good, bounds)


@dataclass
class LanguageFilter:
    names: list[str]
    words: np.ndarray  # slots x ceil(languages / 64)
    false_rate: np.ndarray
    own_rate: np.ndarray
    default: int

    @classmethod
    def build(cls, names: list[str], keys: list[np.ndarray], own_rate: np.ndarray, sizes: np.ndarray) -> LanguageFilter:
        """``keys``: the gram hashes of each language; ``own_rate``: the share of its own text they cover."""
        most = max([1, *map(len, keys)])
        slots = 1 << int(np.ceil(np.log2(most * SLOTS_PER_GRAM)))
        words = np.zeros((slots, max(1, -(-len(names) // 64))), np.uint64)
        for lang, own in enumerate(keys):
            for probe in cls._probes(own, slots):
                words[probe, lang // 64] |= np.uint64(1 << lang % 64)
        fill = np.array([np.mean(words[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(names))])
        return cls(names, words, fill**PROBES, own_rate, int(np.argmax(sizes)) if len(sizes) else 0)

    @staticmethod
    def _probes(keys: np.ndarray, slots: int) -> list[np.ndarray]:
        return [(keys >> np.uint64(32 * k) & np.uint64(slots - 1)).astype(np.int64) for k in range(PROBES)]

    def masks(self, keys: np.ndarray) -> np.ndarray:
        """Bits of all languages that contain each gram (with false positives)."""
        first, *rest = self._probes(keys, len(self.words))
        out = self.words[first]
        for probe in rest:
            out &= self.words[probe]
        return out

    def decide(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language (-1: no letter) and score of each document of a chunk."""
        keys, bounds = grams(chunk)
        masks, n = self.masks(keys), np.diff(bounds)
        share = np.zeros((chunk.n, len(self.names)))
        for lang in range(len(self.names)):
            hits = sums_between(masks[:, lang // 64] >> np.uint64(lang % 64) & np.uint64(1), bounds)
            true = (hits - n * self.false_rate[lang]) / (1 - self.false_rate[lang])
            share[:, lang] = np.maximum(true, 0) / (np.maximum(n, 1) * self.own_rate[lang])
        total = share.sum(1)
        best = share.argmax(1)
        score = np.where(total > 0, share[np.arange(chunk.n), best] / np.where(total > 0, total, 1), 0.0)
        best[total <= 0] = self.default
        plain = sums_between((chunk.data | 0x20) - 0x61 < 26, chunk.bounds) > 0
        for doc in np.flatnonzero(~plain):
            text = chunk.data[chunk.bounds[doc] : chunk.bounds[doc + 1]].tobytes().decode("utf-8")
            if not any(map(str.isalpha, text)):
                best[doc], score[doc] = -1, 0.0
        return best, score


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = batch.column("lang").dictionary_encode()
        lang_of_doc = codes.indices.to_numpy()
        found: dict[int, list[np.ndarray]] = {}
        for chunk in chunks(batch.column("text")):
            keys, bounds = grams(chunk)
            lang = np.repeat(lang_of_doc[chunk.first : chunk.first + chunk.n], np.diff(bounds))
            for code in np.unique(lang):
                found.setdefault(int(code), []).append(keys[lang == code])
        for code, parts in found.items():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            names = pa.array([codes.dictionary[code].as_py()] * len(keys), pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(keys.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"])


def learn(docs: DataFrame, limit: int = SAMPLE) -> LanguageFilter:
    """Gram profiles of the languages from at most ``limit`` documents of each outside the held-out fold."""
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    ranked = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("hash")).distinct().withColumn("rank", rank).where(F.col("rank") <= limit)
    # The sample is what lies up to the last rank's hash: one small row per language instead of a join on ids.
    last = cut_lineage(ranked.groupBy("lang").agg(F.max(F.struct("hash", "doc_id")).alias("last")))
    sample = known.join(last, "lang").where(F.struct(F.xxhash64("doc_id").alias("hash"), "doc_id") <= F.col("last"))
    counted = sample.select("lang", "text").mapInArrow(_counted, "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    per_lang = Window.partitionBy("lang")
    place = F.row_number().over(per_lang.orderBy(F.desc("n"), "gram"))
    frequent = (F.col("n") >= LEAST_COUNT) & (F.col("n") >= F.col("total") * LEAST_SHARE)
    # However little text a language has, its best grams are learned.
    kept = totals.withColumns({"total": F.sum("n").over(per_lang), "place": place}).where(frequent | (F.col("place") <= LEAST_GRAMS))
    rows = kept.toArrow().sort_by([("lang", "ascending"), ("gram", "ascending")])
    names = sorted(set(rows.column("lang").to_pylist()))
    lang = rows.column("lang").to_numpy(zero_copy_only=False)
    gram, n, total = (rows.column(c).to_numpy() for c in ("gram", "n", "total"))
    own = [lang == name for name in names]
    sizes = np.array([total[k][0] for k in own])
    rate = np.array([n[k].sum() / total[k][0] for k in own])
    return LanguageFilter.build(names, [gram[k].view(np.uint64) for k in own], rate, sizes)


def identify(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""

    def decided(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.names, UNKNOWN], object)
        for batch in batches:
            found = [model.decide(chunk) if model.names else (np.full(chunk.n, -1), np.zeros(chunk.n)) for chunk in chunks(batch.column("text"))]
            best = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
            score = np.concatenate([f[1] for f in found]) if found else np.zeros(0)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(names[best], pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    source = docs.select("doc_id", held_out().alias("held_out"), "text")
    return source.mapInArrow(decided, "doc_id long, held_out boolean, lang_pred string, score double")

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as contract
from derrick.llm import byte_bpe, packing
from derrick.llm.chunks import chunks
from tests.llm.cases import TEXTS, empty, frame

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


def test_ids_equal_the_library(library, tokenizer):
    parts = ["'", "s", "t", "re", "ve", "ll", "d", "m", " ", "  ", "\n", "\t", "1", "é", "ß", "²", "''", "A", "l", "r", "v", "e", "漢", "😀", ".", "́", "<|endoftext|>", "\x1c", "\x85", " "]
    rng = random.Random(5)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(8000)]
    texts += ["<|endoftext|>" * 3, "a <|endoftext|> b<|endoftext|>", "<|endoftext", "|><|endoftext|>\n's", ""]
    texts += ["*" * 5000 + "a" * 3000 + " " * 2000, "ab" * 4000, None] + [t for _, t in TEXTS]
    want = {RANKS: library.encode_ordinary, JSON: lambda text: tokenizer.encode(text, add_special_tokens=False).ids}
    for path in (RANKS, JSON):
        bpe, at = byte_bpe.ByteBpe(path), 0
        for chunk in chunks(pa.array(texts, pa.string()), 4000):
            found = bpe.encode(chunk)
            for a, b in zip(found.bounds[:-1], found.bounds[1:], strict=True):
                text = texts[at] or ""
                assert found.ids[a:b].tolist() == want[path](text)
                assert bpe.decode(found.ids[a:b]) == text.encode()
                at += 1
        assert at == len(texts)


@pytest.mark.parametrize("path", [RANKS, JSON])
def test_classes_of_all_code_points_equal_the_library(library, tokenizer, path):
    """A contraction behind a letter is cut off by itself, behind a number or a sign it isn't, and a sign joins the apostrophe."""
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    texts = ["".join(f"{chr(p)}'s 1{chr(p)} " for p in points[a : a + 2000]) for a in range(0, len(points), 2000)]
    bpe = byte_bpe.ByteBpe(path)
    want = [library.encode_ordinary(t) for t in texts] if path == RANKS else [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    found = [c.ids[a:b].tolist() for chunk in chunks(pa.array(texts)) for c in [bpe.encode(chunk)] for a, b in zip(c.bounds[:-1], c.bounds[1:], strict=True)]
    wrong = [i for i, (a, b) in enumerate(zip(found, want, strict=True)) if a != b]
    assert not wrong, [hex(points[i * 2000]) for i in wrong]


def test_round_trip_of_edge_cases(spark, library):
    rows = byte_bpe.round_trip(frame(spark), RANKS).collect()
    want = Counter()
    for doc_id, text in TEXTS:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        want[doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, rows)) == want
    assert byte_bpe.round_trip(empty(spark), RANKS).count() == 0


def test_offsets_cut_the_text_at_its_tokens(spark, library):
    for row in byte_bpe.encoded(frame(spark), RANKS).collect():
        text = next((t or "") for i, t in TEXTS if i == row.doc_id).encode()
        ends = [*row.offsets[1:], len(text)]
        bpe = byte_bpe.ByteBpe.shared(RANKS)
        assert [text[a:b] for a, b in zip(row.offsets, ends, strict=True)] == [bpe.tokens[i] for i in row.ids] if row.ids else not text


def _first_fit_best(counts, limit):
    gaps = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            fitting = [g for g in gaps if g >= size]
            if fitting:
                gaps.remove(min(fitting))
                gaps.append(min(fitting) - size)
            else:
                gaps.append(limit - size)
    return len(gaps)


def test_schedule_is_as_tight_as_one_by_one():
    rng = random.Random(1)
    for _ in range(60):
        limit = rng.choice([10, 50, 1024])
        counts = {rng.randint(1, limit): rng.randint(1, 40) for _ in range(rng.randint(1, 60))}
        plan, sequences = packing.best_fit(counts, limit), {}
        for size, n in counts.items():
            for sequence, offset in zip(*plan.places(np.full(n, size), np.arange(n)), strict=True):
                sequences.setdefault(int(sequence), []).append((int(offset), size))
        for own in sequences.values():
            ends = [o + s for o, s in sorted(own)]
            assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= limit
        assert len(sequences) == plan.sequences <= _first_fit_best(counts, limit) * 1.02 + 1


def check_packing(rows, texts, tokenizer):
    """``texts``: id to text, each id once."""
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == set(texts)
    for doc_id, text in texts.items():
        ids, at = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], 0
        for k, r in enumerate(sorted(found[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 1024) and r.length <= 1024
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        ends = [o + n for o, n in sorted(own)]
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 1024
    return len(sequences), -(-sum(r.length for r in rows) // 1024)


def test_packing_of_the_table(spark, tokenizer):
    rows = contract.queries()["op8_best_fit_packing"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    used, least = check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, tokenizer)
    assert used <= least * 1.03 + 1


def test_packing_of_edge_cases(spark, tokenizer):
    once = {i: t for i, t in TEXTS}
    check_packing(packing.pack(frame(spark, list(once.items())), JSON).collect(), once, tokenizer)
    repeated = packing.pack(frame(spark, [(1, "a b c")] * 50 + [(None, None)] * 3), JSON).collect()
    assert len(repeated) == 53 and len({(r.sequence_id, r.offset) for r in repeated}) == 53
    assert packing.pack(empty(spark), JSON).count() == 0

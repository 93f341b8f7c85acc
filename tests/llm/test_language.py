import zlib

import numpy as np
import pyarrow as pa

import __spark_entry__ as contract
from derrick.llm import language_bits
from derrick.llm.chunks import chunks
from tests.llm.cases import SCHEMA, TEXTS, empty, frame, plain

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    found = contract.queries()["op2_language_id"](spark, FOLDER).join(docs, "doc_id").where("held_out").toPandas()
    assert (found.lang_pred == found.lang).mean() > 0.97 and found.score.between(0, 1).all()


def test_grams_equal_a_plain_walk():
    texts = ["Été à, b", None, "xy", "ÀB  cd-ef!", ""]
    (chunk,) = chunks(pa.array(texts, pa.string()))
    keys, bounds = language_bits.grams(chunk)
    for k, text in enumerate(texts):
        folded = "".join(c if ord(c) > 127 else c if c.isalpha() else " " for c in (text or "").lower())
        raw = f" {folded} ".encode()
        own = [raw[i : i + 4] for i in range(len(raw) - 3) if b"  " not in raw[i : i + 4]]
        want = language_bits.mix(np.array([int.from_bytes(g, "big") for g in own], np.uint64))
        assert keys[bounds[k] : bounds[k + 1]].tolist() == want.tolist()


def test_masks_hold_all_languages_of_a_gram():
    rng = np.random.default_rng(0)
    sets = [rng.integers(1, 2**63, 500, dtype=np.uint64) for _ in range(70)]
    sets[69] = np.concatenate([sets[69], sets[3][:50]])
    model = language_bits.LanguageFilter.build([f"l{k:02}" for k in range(70)], sets, np.ones(70), np.ones(70))
    masks = model.masks(sets[3][:50])
    assert all(masks[:, k // 64].astype(object).tolist() and (int(m) >> k % 64) & 1 for k in (3, 69) for m in masks[:, k // 64])
    other = model.masks(rng.integers(1, 2**63, 20_000, dtype=np.uint64))
    rate = np.array([np.mean(other[:, k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(70)])
    assert np.abs(rate - model.false_rate).max() < 0.01


def test_edge_cases(spark):
    docs = frame(spark)
    found = language_bits.identify(docs, language_bits.learn(docs)).collect()
    by_text = {r.doc_id: r for r in found}
    assert len(found) == len(TEXTS)
    assert all(by_text[k].lang_pred == "und" and by_text[k].score == 0 for k in (1, 2, 3, 12))
    assert by_text[9].lang_pred == "en" and by_text[4].lang_pred == "en"
    none = empty(spark)
    assert language_bits.identify(none, language_bits.learn(none)).count() == 0
    assert {r.lang_pred for r in language_bits.identify(docs, language_bits.learn(none)).collect()} == {"und"}


def test_a_language_of_one_document_is_learned(spark):
    """Rare languages keep their best grams: their own text is told, and the others aren't drawn to them."""
    row = lambda i, text, lang: (i, text, lang, "s", 1, 0.5, 1, 2, 3, 4, "d", 5, 6)
    odd = "zwyx qovv krrzt blimf quxxo vennf zwyx okkrat zimbul frotz kwengl"
    own = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 4 != 2)
    rows = [row(k, plain(80, k + 1), "en") for k in range(60)] + [row(own, odd, "xx"), row(2000, odd + " zimbul frotz", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language_bits.learn(docs)
    assert model.names == ["en", "xx"]
    found = {r.doc_id: r.lang_pred for r in language_bits.identify(docs, model).collect()}
    assert found == {r[0]: "xx" if odd in r[1] else "en" for r in rows}

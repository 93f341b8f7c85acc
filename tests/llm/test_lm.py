import re

import numpy as np
import pyarrow as pa

from derrick.llm import masked_lm
from derrick.llm.chunks import chunks
from tests.llm.cases import TEXTS, empty, frame


def one_by_one(net, ids):
    """Log-probability of every word, from the formula."""
    w, out = net.w, []
    for i, target in enumerate(ids):
        hidden = np.zeros(masked_lm.WIDTH)
        for k, step in enumerate([-2, -1, 1, 2]):
            near = ids[i + step] if 0 <= i + step < len(ids) else masked_lm.BLANK
            hidden += w["embed"][near] * w["place"][k]
        hidden = np.tanh(hidden)
        high, low = divmod(int(target), masked_lm.SIDE)
        first = hidden @ w["first"] + w["first_bias"]
        second = np.tanh(hidden + w["given"][high]) @ w["second"] + w["second_bias"][high]
        out.append(first[high] - np.log(np.exp(first).sum()) + second[low] - np.log(np.exp(second).sum()))
    return out


def test_scores_equal_the_formula(spark):
    docs = frame(spark)
    words = masked_lm.vocabulary(docs)
    net = masked_lm.train(docs, words)
    rows = masked_lm.score(docs, words, net).collect()
    assert len(rows) == len(TEXTS)
    small = {i: t for i, t in TEXTS if len(t or "") < 2000}
    for r in rows:
        if r.doc_id in small:
            (chunk,) = chunks(pa.array([small[r.doc_id]], pa.string()))
            want = one_by_one(net, words(chunk))
            assert r.n_words == len(want)
            assert np.isclose(r.log_prob, sum(want), rtol=1e-4, atol=1e-4)
            assert r.mean_log_prob is None if not want else np.isclose(r.mean_log_prob, np.mean(want), rtol=1e-4)


def test_counts_cover_all_words(spark):
    docs = frame(spark)
    words = masked_lm.vocabulary(docs)
    assert words.counts.sum() == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in TEXTS) and (words.counts >= 0).all()


def test_learns_from_both_sides(spark):
    rows = [(k, " ".join(f"a{(k + j) % 6} b{(k + j) % 6} c{(k + j) % 6}" for j in range(200))) for k in range(60)]
    docs = frame(spark, rows)
    words = masked_lm.vocabulary(docs)
    before = masked_lm.score(docs, words, masked_lm.Network.fresh(words.counts)).agg({"mean_log_prob": "avg"}).first()[0]
    after = masked_lm.score(docs, words, masked_lm.train(docs, words, 3)).agg({"mean_log_prob": "avg"}).first()[0]
    assert after > before + 0.5


def test_every_position_is_trained_on_once(monkeypatch):
    texts = pa.array([None, "", *(" ".join(f"w{n}-{k}" for k in range(n)) for n in range(1, 20))], pa.string())
    words = masked_lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.ones(masked_lm.WORDS))
    trained = []
    monkeypatch.setattr(masked_lm.Network, "step", lambda self, context, target, scale: trained.extend(zip(map(tuple, context), target, strict=True)))
    flat = masked_lm.Network.fresh(words.counts).flat
    (rows,) = masked_lm._coded(words)([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["doc_id", "text"])])
    # Two slices in one task, the second in two batches.
    for round_ in range(masked_lm.ROUNDS):
        slices = pa.array([0] * 9 + [1] * (len(texts) - 9))
        batch = pa.RecordBatch.from_arrays([slices, rows.column("ids")], names=["slice", "ids"])
        (out,) = masked_lm._train_once(flat, round_)([batch.slice(0, 12), batch.slice(12)])
        assert out.column("seen")[0].as_py() > 0
    (chunk,) = chunks(texts)
    ids = words(chunk)
    every = zip(map(tuple, masked_lm.contexts(ids, chunk.word_bounds, np.arange(len(ids)))), ids, strict=True)
    assert sorted(trained) == sorted(every)


def test_words_of_a_shared_id_have_their_own_probability(spark):
    frequent = " ".join(f"f{k}" for k in range(masked_lm.WORDS - masked_lm.RARE))
    inside = "f1 f2 {} f3 f4".format
    rows = [(1, inside("qqqqzz")), (2, inside("wwwwzz")), *((3 + k, f"{frequent} {frequent} qqqqzz") for k in range(4))]
    docs = frame(spark, rows)
    found = {r.doc_id: r.log_prob for r in masked_lm.pseudo_likelihood(docs).collect()}
    # Same context and shared id; one word occurs five times, the other once.
    assert np.isclose(found[1] - found[2], np.log(5), atol=1e-4)

    counts = masked_lm.word_counts(docs)
    words = masked_lm.vocabulary(docs, counts)
    new = frame(spark, [(1, inside("wwwwzz")), (2, inside("eeeezz")), (2, inside("eeeezz")), (3, None), (None, "")])
    net = masked_lm.Network.fresh(words.counts)
    found = [(r.doc_id, r.log_prob) for r in masked_lm.score(new, words, net, counts).collect()]
    probs = dict(found)
    assert len(found) == 5 and np.isclose(probs[1] - probs[2], np.log(1 / masked_lm.UNSEEN), atol=1e-4)
    assert probs[3] == probs[None] == 0


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    net = masked_lm.Network.fresh(np.ones(masked_lm.WORDS))
    context, target = rng.integers(0, masked_lm.WORDS, (5, 4)), rng.integers(0, masked_lm.WORDS, 5)
    start = net.log_probs(context, target).mean()
    scale = {name: np.zeros(shape, np.float32) for name, shape in masked_lm.Network.SHAPES.items()}
    net.step(context, target, scale, rate=0.01)
    assert net.log_probs(context, target).mean() > start


def test_scores_do_not_depend_on_the_partitioning(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "SLICE", 5000)
    rows = [(k, " ".join(f"a{(k * j) % 37} b{(k + j) % 6} c{j % (k + 2)}" for j in range(100))) for k in range(80)]
    docs = frame(spark, [*rows, (7, rows[7][1]), (None, rows[8][1])])
    found = [sorted(map(tuple, masked_lm.pseudo_likelihood(docs.repartition(n)).collect()), key=str) for n in (1, 4)]
    assert len(found[0]) == 82 and [r[:2] for r in found[0]] == [r[:2] for r in found[1]]
    # Only the last digits of float32 products depend on how many documents are scored together.
    assert np.allclose([r[2] for r in found[0]], [r[2] for r in found[1]], rtol=1e-7)


def test_listed_words_have_the_share_that_the_join_gives(spark, monkeypatch):
    frequent = " ".join(f"f{k}" for k in range(masked_lm.WORDS - masked_lm.RARE))
    docs = frame(spark, [(1, "f1 qqqqzz f2"), (2, "f1 wwwwzz f2"), *((3 + k, f"{frequent} {frequent} qqqqzz") for k in range(4))])
    counts = masked_lm.word_counts(docs)
    without = masked_lm.vocabulary(docs, counts)
    monkeypatch.setattr(masked_lm, "LISTED", 6000)
    listed = masked_lm.vocabulary(docs, counts)
    assert len(listed.hashes) == len(without.hashes) + 1  # qqqqzz: 5 of 24,588 words
    net = masked_lm.Network.fresh(listed.counts)
    one, other = ({r.doc_id: r.log_prob for r in masked_lm.score(docs, w, net, counts).collect()} for w in (without, listed))
    assert one.keys() == other.keys() and all(np.isclose(one[k], other[k], atol=1e-6) for k in one)


def test_one_document_longer_than_a_chunk(spark):
    text = "some words that repeat for long and one more " * 20_000
    docs = frame(spark, [(1, text), (2, "some words")])
    found = {r.doc_id: r.n_words for r in masked_lm.pseudo_likelihood(docs).collect()}
    assert found == {1: 180_000, 2: 2}


def test_empty_table(spark):
    none = empty(spark)
    assert masked_lm.pseudo_likelihood(none).count() == 0


def test_gradients_of_words_are_sums_over_those_that_occur():
    rng = np.random.default_rng(4)
    net = masked_lm.Network.fresh(np.ones(masked_lm.WORDS))
    rows = rng.normal(size=(500, masked_lm.WIDTH)).astype(np.float32)
    context = rng.choice([3, 70, 4000, masked_lm.BLANK], (500, 2 * masked_lm.REACH))
    embed, place = net._of_words(rows, context + masked_lm.PLACES)
    plain = np.zeros((2 * masked_lm.REACH, masked_lm.WORDS + 1, masked_lm.WIDTH))
    for k in range(2 * masked_lm.REACH):
        np.add.at(plain[k], context[:, k], rows)
    assert np.allclose(place, (plain * net.w["embed"]).sum(1), atol=1e-4)
    assert np.allclose(embed, (plain * net.w["place"][:, None, :]).sum(0), atol=1e-4)
    assert [len(x) for x in masked_lm._sum_by_key(rows[:0], context[:0])] == [0, 0]


def test_log_probabilities_of_large_outputs_stay_finite():
    for top in (5.0, 1000.0):
        x = np.array([[top] + [0.0] * 63, [-top] * 64], np.float32)
        found = masked_lm._log_softmax_at(x.copy(), np.array([1, 5]))
        assert np.allclose(found, [-np.log(np.exp(min(top, 700)) + 63) if top < 700 else -top, -np.log(64)], rtol=1e-5)
        error = masked_lm._error(x.copy(), np.array([0, 5]))
        assert np.isfinite(error).all() and np.allclose(error.sum(1), 0, atol=1e-5)


def test_counts_and_ids_of_several_chunks_equal_plain_ones():
    """Words are counted per chunk first; shared ids are made only for the words that need one."""
    texts = ["ab cd ab", "", None, "cd xyz é", " ".join(f"w{i % 997}x" for i in range(200_000)), "ab é zz"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = list(chunks(batch.column("text")))
    assert len(parts) > 1
    words, first, n = np.unique(np.concatenate([c.word_hashes for c in parts]), return_index=True, return_counts=True)
    rare = np.concatenate([masked_lm.rare_id(c) for c in parts])
    (found,) = masked_lm._counted([batch])
    for name, want in (("word", words.view(np.int64)), ("rare", rare[first]), ("n", n)):
        np.testing.assert_array_equal(found.column(name).to_numpy(), want)
    known = masked_lm.Vocabulary(words[::2], np.arange(len(words[::2])), np.zeros(masked_lm.WORDS), n[::2])
    for chunk in parts:
        places = np.arange(len(chunk.word_hashes))[::3]
        np.testing.assert_array_equal(masked_lm.rare_id(chunk, places), masked_lm.rare_id(chunk)[::3])
        ids, at = known.find(chunk)
        listed = np.isin(chunk.word_hashes, known.hashes)
        np.testing.assert_array_equal(known.hashes[at[listed]], chunk.word_hashes[listed])
        np.testing.assert_array_equal(ids[listed], at[listed])
        np.testing.assert_array_equal(ids[~listed], masked_lm.rare_id(chunk)[~listed])
        assert (at[~listed] == -1).all()


def test_places_by_first_bits_equal_a_binary_search():
    rng = np.random.default_rng(6)
    for n in (1, 2, 70, 5000):
        # Some share their first bits; the smallest and the largest hash are listed or not.
        known = np.unique(np.concatenate([rng.integers(0, 2**64, n, np.uint64), np.arange(5, 5 + n // 10, dtype=np.uint64)]))
        for listed in (known, np.unique(np.append(known, np.array([0, 2**64 - 1], np.uint64)))):
            words = masked_lm.Vocabulary(listed, np.zeros(len(listed), np.int64), np.zeros(masked_lm.WORDS))
            asked = np.concatenate([listed, listed + np.uint64(1), listed - np.uint64(1), rng.integers(0, 2**64, 300, np.uint64)])
            np.testing.assert_array_equal(words._place(asked), np.searchsorted(listed, asked))


def test_sums_of_short_and_long_runs_equal_plain_ones():
    rng = np.random.default_rng(7)
    for sizes in (rng.permutation(np.repeat(np.arange(1, 40), 3)), [1], [9], [300, 1, 2], [8] * 5):
        firsts = np.cumsum(sizes) - sizes
        rows = rng.normal(size=(np.sum(sizes), masked_lm.WIDTH)).astype(np.float32)
        np.testing.assert_allclose(masked_lm._sum_short_runs(rows, firsts), np.add.reduceat(rows, firsts, axis=0), rtol=1e-5, atol=1e-5)
    assert masked_lm._sum_short_runs(rows[:0], firsts[:0]).shape == (0, masked_lm.WIDTH)


def test_shares_of_words_need_no_sort_and_one_logarithm_per_word(spark):
    """Words met by a hash join, with their logarithm taken before it; one that the counts don't have is UNSEEN."""
    docs = frame(spark, [(1, "ab cd ab"), (2, "cd"), (3, None), (None, "ab")])
    counts = masked_lm.word_counts(docs)
    none = masked_lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.full(masked_lm.WORDS, 3.0))  # all words are shared and unlisted
    net = masked_lm.Network.fresh(none.counts)
    rows = masked_lm.score(docs, none, net, counts.filter("n > 2"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    before_join, after_join = plan.split("ShuffledHashJoin", 1)
    assert "ln(" not in before_join.lower() and "log(" not in before_join.lower() and ("ln(" in after_join.lower() or "log(" in after_join.lower())
    plain = {r.doc_id: r.log_prob for r in masked_lm.score(docs, none, net).collect()}
    found = {r.doc_id: (r.n_words, r.log_prob) for r in rows.collect()}
    ab, cd, total = np.log(3), np.log(masked_lm.UNSEEN), np.log(3 + masked_lm.UNSEEN)
    want = {1: (3, plain[1] + 2 * ab + cd - 3 * total), 2: (1, plain[2] + cd - total), 3: (0, 0.0), None: (1, plain[None] + ab - total)}
    assert found.keys() == want.keys() and all(found[k][0] == n and np.isclose(found[k][1], p, atol=1e-6) for k, (n, p) in want.items())

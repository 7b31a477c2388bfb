import math
import random

import numpy as np
import pyarrow as pa
import pytest

from gleanframe.llm import scoring as s

DOCS = "doc_id bigint, text string, n_words string, id string"
CHAIN = {"a": "bc", "b": "cd", "c": "de", "d": "ea", "e": "ab"}


def sentences(seed, n, length=60):
    """Each word allows two words behind it."""
    rng, out = random.Random(seed), []
    for k in range(n):
        word, text = "a", []
        for _ in range(rng.randrange(1, length)):
            text.append(word)
            word = rng.choice(CHAIN[word])
        out.append((k, " ".join(text)))
    return out


def docs(table, rows, parts=3):
    return table([(*r, "", "") for r in rows], DOCS, parts)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(*r, "", "") for r in sentences(1, 1500)]
    return s.train(spark.createDataFrame(rows, DOCS).repartition(3), epochs=3, batch_places=32)


def test_slope_is_the_gradient():
    rng = np.random.default_rng(3)
    line = rng.integers(0, s.SYMBOLS, 40)
    at = np.arange(2, 38)
    exact = s.Network(s.Network.fresh().vector.astype(float))
    slope = s.Network(s.Network.fresh().vector).slope(line, at)
    for i in rng.permutation(np.flatnonzero(np.abs(slope) > 1e-3))[:40]:
        losses = []
        for step in (1e-5, -1e-5):
            exact.vector[i] += step
            losses.append(-exact.logs(line, at).mean())
            exact.vector[i] -= step
        assert math.isclose((losses[0] - losses[1]) / 2e-5, slope[i], rel_tol=1e-2, abs_tol=1e-5)


def test_predictions_sum_to_one():
    network = s.Network.fresh()
    line = np.array([s.EDGE, s.EDGE, 0, 5, 9, s.EDGE, s.EDGE])
    total = 0.0
    for symbol in range(s.SYMBOLS):
        line[3] = symbol
        total += np.exp(network.logs(line, np.array([3]))[0])
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_scores_equal_a_plain_loop(table, model):
    rows = [(1, "a b d a"), (2, "A  c\te zzz"), (3, "e")]
    got = {r.doc_id: r for r in s.score(docs(table, rows), model).collect()}
    n = s.Network(model.weights.astype(float))
    for doc_id, text in rows:
        line, at, _, cost = s.places(pa.array([text]), model.symbols)
        total = 0.0
        for place, price in zip(at, cost):
            around = [line[place + k] for k in (-2, -1, 1, 2)]
            hidden = np.tanh(np.concatenate([n.embed[w] for w in around]) @ n.into + n.shift)
            bin_, inner = divmod(int(line[place]), s.BIN)
            for logits, k in ((hidden @ n.bins + n.bin_bias, bin_),
                              (hidden @ n.words[bin_] + n.word_bias[bin_], inner)):
                total += logits[k] - math.log(np.exp(logits).sum())
            total += price
        assert got[doc_id].n_words == len(at)
        assert math.isclose(got[doc_id].log_likelihood, total, rel_tol=1e-3)
        assert math.isclose(got[doc_id].per_word, total / len(at), rel_tol=1e-3)


def test_both_sides_are_learnt(table, model):
    """Given both neighbours, the chain leaves about one bit; a shuffled text is far less likely."""
    rng = random.Random(9)
    held_out = sentences(77, 60)
    shuffled = []
    for k, text in held_out:
        words = text.split()
        rng.shuffle(words)
        shuffled.append((k, " ".join(words)))
    good, bad = (s.score(docs(table, rows), model).selectExpr("sum(log_likelihood) / sum(n_words) as x").first().x
                 for rows in (held_out, shuffled))
    assert good > -0.9 and bad < good - 0.7


def test_nulls_empty_and_repeats(table, model):
    rows = [(1, None), (2, " \n"), (None, "a b"), (3, "a b"), (3, "a b")]
    got = sorted(((r.doc_id, r.n_words, round(r.log_likelihood, 4), round(r.per_word, 4))
                  for r in s.score(docs(table, rows), model).collect()), key=str)
    assert [(r[0], r[1]) for r in got] == [(1, 0), (2, 0), (3, 2), (3, 2), (None, 2)]
    assert got[0][2:] == got[1][2:] == (0, 0) and got[2][2:] == got[3][2:] == got[4][2:]
    assert s.score(docs(table, []), model).collect() == []


def test_nothing_to_learn_from(table):
    model = s.train(docs(table, [(1, None)]))
    assert s.score(docs(table, [(1, "a b"), (2, "")]), model).count() == 2
    assert s.train(docs(table, [])).weights.shape == (s.WEIGHTS,)


def test_counts_cover_every_word(table):
    rows = sentences(4, 50) + [(99, "A rare WORD word")]
    counts = s.count_words(docs(table, rows)).collect()
    assert sum(r.n for r in counts) == sum(len(t.split()) for _, t in rows)
    assert len(counts) == 7  # a to e, rare, word


def test_long_text(table, model):
    row = s.score(docs(table, [(1, "a b c d e " * 60_000)]), model).first()
    assert row.n_words == 300_000 and row.log_likelihood < 0


def test_words_of_a_class_have_their_own_terms(table):
    """Beyond the symbols, a word's count by its class's decides."""
    rows = [(n, " ".join(f"f{k}" for k in range(s.SYMBOLS))) for n in range(30)]
    rows += [(n + 30, f"w{n}qz" + " oftenqz" * 7) for n in range(3)]
    rows += [(None, "w1qz"), (40, "w1qz"), (41, "oftenqz")]
    model = s.train(docs(table, rows))
    got = {r.doc_id: r.log_likelihood for r in s.score(docs(table, [*rows, (42, "newqz")]), model).collect()}
    hashes, tails, _ = s._words(pa.array(["oftenqz w1qz newqz"]))
    assert len(got) == 37 and len(set(tails)) == 1 and not set(hashes) & set(model.symbols.hashes)
    assert math.isclose(got[41] - got[42], math.log(22), rel_tol=1e-4)
    assert math.isclose(got[40] - got[42], math.log(3), rel_tol=1e-4) and math.isclose(got[None], got[40], rel_tol=1e-6)


def test_shares_of_a_class_sum_to_one(table):
    rows = [(n, " ".join(f"w{k}" for k in range(n, 1500))) for n in range(3)]
    model = s.train(docs(table, rows))
    hashes, tails, _ = s._words(pa.array([rows[0][1]]))
    _, cost = model.symbols.of(hashes, tails)
    n = {r.word: r.n for r in model.counts.collect()}
    shares = np.zeros(s.TAILS)
    for h, tail, c in zip(hashes.view(np.int64), tails, cost):
        shares[tail] += n[int(h)] * math.exp(c) if c else 0
    shares += np.exp(model.symbols.tail_logs)  # all words that were never counted
    assert np.allclose(shares, 1)


def test_symbols_grow_with_the_distinct_words(spark, table, monkeypatch):
    monkeypatch.setattr(s, "DISTINCT", 1)
    rows = [(n, " ".join(f"w{k}" for k in range(1600))) for n in range(2)]
    model = s.train(docs(table, rows))
    assert model.symbols.bins == 40 and len(model.weights) == s.n_weights(40) > s.WEIGHTS
    assert len(model.symbols.hashes) == 40 * s.BIN - s.TAILS
    assert s.score(docs(table, rows), model).filter("log_likelihood < 0 and n_words = 1600").count() == 2


def test_the_split_into_tasks_makes_no_difference(table, monkeypatch):
    """Several shards and takes, whatever the files."""
    monkeypatch.setattr(s, "SHARD_WORDS", 4000)
    monkeypatch.setattr(s, "TAKE", 500)
    rows = [*sentences(5, 400), (None, "a b c"), (None, "d e"), (3, "a b"), (1000, "a b " * 700)]
    found = []
    for parts in (1, 4, 16):
        model = s.train(docs(table, rows, parts), batch_places=64)
        found.append(sorted((r.doc_id or -1, r.n_words, r.per_word) for r in s.score(docs(table, rows, parts), model).collect()))
    assert s.n_shards(sum(r[1] for r in found[0])) > 2
    for other in found[1:]:
        assert [r[:2] for r in other] == [r[:2] for r in found[0]]
        assert max(abs(a[2] - b[2]) for a, b in zip(other, found[0])) < 0.01


def test_stretches_hold_every_place_once(table, monkeypatch):
    monkeypatch.setattr(s, "STRETCH", 7)
    rows = [(1, " ".join("abcde"[k % 5] for k in range(40))), (2, None), (3, "a"), (4, "b c d e a b c")]
    symbols = s.choose_symbols(s.count_words(docs(table, rows)))
    got = {}
    for r in s.stretches(docs(table, rows), symbols).orderBy("id", "place").collect():
        got.setdefault(r.id, []).append(np.frombuffer(r.line, np.uint16).astype(int))
    for doc_id, text in rows:
        line, at, _, _ = s.places(pa.array([text]), symbols)
        want = [(line[p], tuple(line[p + s._OFFSETS])) for p in at]
        assert [(x[k], tuple(x[k + s._OFFSETS])) for x in got.get(doc_id, []) for k in range(2, len(x) - 2)] == want
        assert all(len(x) <= 11 for x in got.get(doc_id, []))

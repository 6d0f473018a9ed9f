import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from brute import WORD, lower

from innsight.llm import hmm


def tiny(states=2, classes=3, seed=0):
    rng = np.random.default_rng(seed)
    unit = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(rng.uniform(0.1, 1, s))
    return hmm.Model(unit(states), unit(states, states), unit(states, classes))


def paths(model, seq):
    for z in itertools.product(range(len(model.start)), repeat=len(seq)):
        p = model.start[z[0]] * model.emit[z[0], seq[0]]
        for a, b, c in zip(z, z[1:], seq[1:]):
            p *= model.move[a, b] * model.emit[b, c]
        yield z, p


def test_likelihood_and_expectations_equal_enumeration():
    model, sequences = tiny(), [[0, 2, 1, 1], [2], [1, 0, 2]]
    flat, lengths = np.array(sum(sequences, [])), np.array([len(s) for s in sequences])
    got = hmm.likelihood(flat, lengths, model)
    counts = np.zeros(2 + 4 + 6)
    for s, value in zip(sequences, got):
        total = sum(p for _, p in paths(model, s))
        assert math.isclose(value, math.log(total), rel_tol=1e-12)
        for z, p in paths(model, s):
            counts[z[0]] += p / total
            for a, b in zip(z, z[1:]):
                counts[2 + 2 * a + b] += p / total
            for a, c in zip(z, s):
                counts[6 + 3 * a + c] += p / total
    assert np.allclose(hmm.expectations(flat, lengths, model), counts)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(9)
    flat, lengths = rng.integers(0, 3, 900), np.array([300, 1, 599])
    model = tiny(seed=5)
    values = []
    for _ in range(6):
        values.append(hmm.likelihood(flat, lengths, model).sum())
        c = hmm.expectations(flat, lengths, model)
        model = hmm.Model(c[:2] / c[:2].sum(), (m := c[2:6].reshape(2, 2)) / m.sum(1, keepdims=True), (e := c[6:].reshape(2, 3)) / e.sum(1, keepdims=True))
    assert all(b >= a - 1e-9 for a, b in zip(values, values[1:]))
    assert list(hmm.pieces(np.array([300, 1, 128]), 128)) == [128, 128, 44, 1, 128]


def expected(rows):
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, WORD.findall(lower(t)) + ["\n"]) for i, t in rows]
    counts = Counter(w for i, ws in tokens if not out(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {i: (out(i), len(ws), sum(w in counts for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens}


@pytest.mark.parametrize("chunk", [8_000_000, 20_000])
def test_counts_and_base_equal_brute_force(spark, chunk):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "Never seen ÄB äb")], docs.schema)
    both = docs.union(extra).selectExpr("*", "1 AS score", "'x' AS chunk")
    want = expected([(r.doc_id, r.text) for r in both.collect()])
    got = hmm.score_documents(both, chunk_chars=chunk).collect()
    assert len(got) == len(want)
    for r in got:
        held, n, known, total, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.score < 0 and math.isfinite(r.score)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string")
    got = hmm.score_documents(df).collect()
    total = sum(want for i, want in ((1, 3), (1, 3), (2, 1)) if zlib.crc32(str(i).encode()) % 7 != 2) + 3
    assert sorted((str(r.doc_id), r.n_tokens, r.train_tokens) for r in got) == [("1", 3, total), ("1", 3, total), ("2", 1, total), ("None", 3, total)]
    assert hmm.score_documents(df.limit(0)).collect() == []


def test_cuts_lose_nothing():
    rng = np.random.default_rng(2)
    lengths = np.array([1, 7, 40, 3, 21, 8, 1, 90])
    flat, model = rng.integers(0, 5, lengths.sum()), tiny(3, 5, 4)
    whole, values = hmm.expectations(flat, lengths, model, 1000), hmm.likelihood(flat, lengths, model, 1000)
    assert math.isclose(whole[:3].sum(), len(lengths)) and math.isclose(whole[3:12].sum(), lengths.sum() - len(lengths))
    for piece in (1, 2, 7, 8, 39):
        assert np.allclose(hmm.expectations(flat, lengths, model, piece), whole, rtol=1e-9)
        assert np.allclose(hmm.likelihood(flat, lengths, model, piece), values, rtol=1e-12)


def test_training_counts_whole_texts_with_all_states_and_rounds():
    assert (hmm.STATES, hmm.ROUNDS) == (6, 4)
    lengths = np.array([3000, 200, 5])
    tokens = np.random.default_rng(1).integers(0, 9, lengths.sum()).astype("<i4")
    docs = np.array([(i, True, False, n) for i, n in enumerate(lengths)], hmm._META)
    vocabulary = np.arange(9, dtype="<u8").tobytes() + np.arange(9, dtype="<u2").tobytes()
    lexicon = hmm.Lexicon.of(np.ones((hmm.ENDINGS + 1, 2), np.int64), np.zeros((0, 3), np.int64))
    frame = pd.DataFrame({"docs": [docs.tobytes()], "tokens": [tokens.tobytes()], "entries": [vocabulary]})
    counts = next(hmm._expected(lexicon, hmm.Model.fresh(lexicon.tokens))(iter([frame])))["value"].to_numpy()
    assert math.isclose(counts[:6].sum(), 3) and math.isclose(counts[6:42].sum(), lengths.sum() - 3)

import itertools
import math
from fractions import Fraction

import numpy as np
import pandas as pd

from innsight.llm import toxicity


def test_messages_equal_enumeration():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 1, 3])
    odds, moves = rng.uniform(0.1, 4, 8), (1.0, 0.3, 0.6, 2.5)
    ahead, back = toxicity.messages(odds, lengths, moves)
    got, at = ahead * back / (1 + ahead * back), 0
    for n in lengths:
        total, tagged = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.prod([odds[at + i] for i, y in enumerate(path) if y]) * np.prod([moves[2 * a + b] for a, b in zip(path, path[1:])])
            total += w
            tagged += w * np.array(path)
        assert np.allclose(got[at : at + n], tagged / total)
        at += n


def _auc(score, label):
    ranks = pd.Series(score).rank()
    n1 = label.sum()
    return (ranks[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(label) - n1))


def test_held_out_documents(spark):
    from innsight.llm.registered import op1_toxicity

    got = op1_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    docs = pd.read_parquet("/root/testdata/sf0.1/documents.parquet")
    assert len(got) == len(docs) and got["score"].between(0, 1).all()
    both = got.merge(labels, on="doc_id")
    both = both[both["held_out"]]
    assert (both["predicted"][both["toxic"] == 0] == 1).mean() < 0.005
    assert (both["predicted"][both["toxic"] == 1] == 1).mean() > 0.85
    assert _auc(both["score"].to_numpy(), both["toxic"].to_numpy()) > 0.9
    row = got[(got["predicted"] == 1)].iloc[0]
    assert all(e > b for b, e in zip(row["span_begin"], row["span_end"]))


def test_edges(spark):
    model = toxicity.train([(f"this is some{k} idiot word{k} here", 1) for k in "abcdefghijklmn"] + [(f"this is a fine {k} day", 0) for k in "abcdefghijklmnopqrstuvwxyzäöü"])
    rows = [(1, None), (2, ""), (3, "... 123"), (4, "so IDIOT idiot."), (None, "fine day"), (4, "so IDIOT idiot."), (5, "fine day " * 20000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS toxicity", "2 AS score")
    got = toxicity.with_toxicity(df, model).collect()
    assert [len(got), [c for c in got[0].asDict()]] == [7, ["doc_id", "text", "score", "toxicity"]]
    by = {r.text: r.toxicity for r in got}
    assert by[None].score == by[""].score == by["... 123"].score < 0.5
    assert by["so IDIOT idiot."].predicted == 1 and (by["so IDIOT idiot."].span_begin, by["so IDIOT idiot."].span_end) == ([3], [14])
    assert by["fine day " * 20000].predicted == 0
    assert 0 <= toxicity.train([]).fold[0] + 5 and toxicity.with_toxicity(df.limit(0), model).count() == 0


def test_every_clean_document_trains_the_field():
    letters = "abcdefghijklmnopqrst"
    names = [x + y + z for x in letters for y in letters for z in letters]
    rows = [(f"{k} idiot {k[::-1]}x", 1) for k in names[:200]] + [(f"a fine {k} day", 0) for k in names[:1300]] + [(f"zzz last zebra {k}", 0) for k in names[:40]]
    docs, vocabulary = toxicity.numbered([t for t, _ in rows])
    model = toxicity.fit_field(docs, [y for _, y in rows], vocabulary)
    assert {"idiot", "zebra", "last"} <= model.weights.keys()
    parts = toxicity.fit_field(docs, [y for _, y in rows], vocabulary, most_tokens=50)
    assert parts.weights.keys() == model.weights.keys() and all(abs(parts.weights[k] - w) < 1e-6 for k, w in model.weights.items())


def test_one_test_of_chance_at_every_size():
    from innsight.llm.toxicity import log_tail

    for n, a, rate in ((10, 4, 0.3), (400, 232, 0.3), (500, 290, 0.3), (401, 401, 0.55), (1000, 120, 0.11)):
        exact = sum(math.comb(n, k) * Fraction(rate) ** k * (1 - Fraction(rate)) ** (n - k) for k in range(a, n + 1))
        assert math.isclose(log_tail(a, n, rate), math.log(exact.numerator) - math.log(exact.denominator), rel_tol=1e-9)

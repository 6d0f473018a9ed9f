import numpy as np
import pandas as pd

from innsight.llm import language


def test_held_out_documents(spark):
    from innsight.llm.registered import op3_language

    got = op3_language(spark, "/root/testdata/sf0.1").toPandas()
    docs = pd.read_parquet("/root/testdata/sf0.1/documents.parquet")
    both = got.merge(docs[["doc_id", "lang"]], on="doc_id")
    out = both[both["held_out"]]
    assert len(got) == len(docs) and got["score"].between(0, 1).all()
    assert (out["lang_pred"] == out["lang"]).mean() > 0.98


def test_mixture_is_recovered_and_penalised():
    rng = np.random.default_rng(1)
    # 300 words of language 0, 100 of language 2; each word 20 times likelier under its own.
    truth = np.array([0] * 300 + [2] * 100)
    like = np.full((400, 3), np.log(0.05))
    like[np.arange(400), truth] = 0.0
    both = np.vstack([like[rng.permutation(400)], like[:5]])
    share = language.proportions(both, np.array([400, 5]), steps=50)
    assert np.allclose(share[0], [0.75, 0, 0.25], atol=0.03) and share[0, 1] == 0
    assert list(share[1]) == [1, 0, 0]


def test_edges(spark):
    model = language.train([("the cat and the dog that was there", "en"), ("el perro y la casa que es grande", "es"), (None, "en")])
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the dog that was"), (4, "the dog that was"), (None, "la casa que es"), (5, "the cat " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS lang_pred")
    got = [(r.doc_id, r.language.lang_pred, r.language.score) for r in language.with_language(df, model).collect()]
    assert [g[1] for g in got] == ["und", "und", "und", "en", "en", "es", "en"] and [g[2] for g in got[:3]] == [0.0, 0.0, 0.0]
    empty = language.train([])
    assert {r.language.lang_pred for r in language.with_language(df, empty).collect()} == {"und"}
    assert language.with_language(df.limit(0), model).collect() == []

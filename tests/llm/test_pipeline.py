import duckdb
import pandas as pd
from brute import jaccard_components
from test_packing import check

import corpus_pipeline
from innsight.llm import registered, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_rows_equal_a_plain_version(spark):
    db = duckdb.connect()
    for table in ("documents", "labels"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    good = {i for i, kept in db.sql(f"SELECT doc_id, kept FROM ({registered.ORACLE['op2_quality_rules']})").fetchall() if kept}
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    docs = docs[docs["doc_id"].isin(good)]
    frame = spark.createDataFrame(docs[["doc_id", "text"]])
    model = toxicity.fit(frame, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.with_toxicity(frame, model).where("toxicity.predicted = 1").collect()}
    texts = {i: t for i, t in zip(docs["doc_id"], docs["text"]) if i not in toxic}
    groups = jaccard_components(list(texts.items()))
    want = {i: t for i, t in texts.items() if groups[i][1] == i}
    assert 0 < len(want) < len(texts) <= len(docs)
    check(corpus_pipeline.run(spark, FOLDER).collect(), want)


def test_stages_keep_the_columns_and_take_edges(spark):
    text = " ".join(f"word{k}" for k in range(80))
    rows = [(1, text, "en", "a", 5), (2, text + " more", None, None, None), (2, text + " more", None, None, None), (None, text, "en", "a", 5), (3, None, "en", "a", 5), (4, "", "en", "a", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS score", "2 AS component_id")
    for kept, (_, stage) in zip(([1, 2, 2, None], [1, 2, 2, None], [1, None]), corpus_pipeline.STAGES[:3]):
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "component_id"]
        assert sorted(map(str, (r.doc_id for r in docs.collect()))) == sorted(map(str, kept))
    other = " ".join(f"else{k}" for k in range(80))
    shared = spark.createDataFrame([(7, text), (7, other), (7, other), (8, other + " x"), (6, None)], "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["jaccard_join"]
    assert sorted((r.doc_id, r.text or "") for r in stage(spark, shared, FOLDER).collect()) == sorted([(7, text), (7, other), (6, "")])
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).collect() == []

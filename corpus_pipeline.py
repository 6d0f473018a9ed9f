"""Training-data pipeline: each stage is one operator, its rows written as Parquet and read again by the next.

``quality_rules`` and ``toxicity`` drop the documents they reject, ``jaccard_join`` keeps the
one with the smallest id of each group of near copies, ``packing`` fills token windows with
what is left. Rows without an id pass the join unchanged, as nothing can name them. Rows are
told apart by a 64-bit hash of id and text, so of rows that share an id only equal or linked
texts fall together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innsight.llm import jaccard, packing, quality, toxicity
from innsight.sources.storage import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.with_quality(docs, into="_quality").where("_quality.kept").select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Trains on the labelled documents among ``docs`` outside the held-out fold."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), folds=5, fold=0)
    return toxicity.with_toxicity(docs, model, into="_toxicity").where("_toxicity.predicted = 0").select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = docs.where("doc_id IS NOT NULL").withColumn("_row", F.xxhash64("doc_id", "text"))
    groups = jaccard.jaccard_components(named, doc_id="_row").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group")).distinct()
    first = groups.join(named.select("_row", "doc_id"), "_row").groupBy("_group").agg(F.min(F.struct("doc_id", "_row")).alias("_first")).select("_first._row")
    kept = named.join(first, "_row", "left_semi").dropDuplicates(["_row", "doc_id"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("toxicity", toxicity_stage), ("jaccard_join", jaccard_join), ("packing", packing_stage)]
#: A trained field and a tokenizer have no SQL; tests compare the rows with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

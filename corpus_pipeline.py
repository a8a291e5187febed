"""Corpus pipeline: toxicity, near-duplicates, decontamination, PII, mixing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame.  ``run`` writes each result as Parquet in the shared
folder and reads it back as the next stage's input.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.decontaminate import drop_contaminated
from tidewatch.llm.mixing import mix_sources
from tidewatch.llm.near_dup import near_duplicates
from tidewatch.llm.pii import redact
from tidewatch.llm.store import Scratch
from tidewatch.llm.toxicity import THRESHOLD, labelled_sample, score_documents, train
from tidewatch.session import checkpoint_root, ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold by a model of the labels."""
    model = train(labelled_sample(docs, _table(spark, sf_dir, "labels")))
    return score_documents(docs, model, out_col="toxicity_score").where(f"toxicity_score < {THRESHOLD}").drop("toxicity_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles,
    similarity 0.8): the one with the smallest doc_id."""
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    null = docs.where("doc_id IS NULL")
    return docs.join(kept, "doc_id", "left_semi").select(docs.columns).unionByName(null)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a test item."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def remove_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in every text replaced by its kind."""
    return redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to equal weight by Poisson replication, globally shuffled."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("pii", remove_pii),
    ("mixing", mix),
]

# training a model and aligning passages have no SQL form; tests/llm/test_pipeline.py
# holds each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the mixture that the last one returns."""
    checkpoint_root(spark)
    ship_package(spark)
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"{k}_{name}")
        if k:
            scratch.drop(f"{k - 1}_{STAGES[k - 1][0]}")
    return docs

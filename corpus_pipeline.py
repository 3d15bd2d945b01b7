"""Training-data pipeline: five stages over ``documents``, each one an operator of ``tiers.llm``.

Every stage takes what its predecessor kept, learns or looks up what it needs in
the other tables of the data folder, and returns a DataFrame that is written as
Parquet and read again as the next one's documents.

No DuckDB twin exists: learned models, similarity groups and sampled
segmentations are not SQL. ``tests/llm/test_pipeline.py`` compares the stages
with brute-force versions instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm import decontaminate, quality, sentencepiece, simhash
from tiers.llm import toxicity as toxic
from tiers.llm.frame import DOCUMENT_COLUMNS, read, take, written

TOKENIZER = "piece_bpe_32k.model"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay; the model learns from labelled ones not held out."""
    docs = take(docs, *DOCUMENT_COLUMNS)
    labels = read(spark, sf_dir, "labels").filter(~toxic.held_out(F.col("doc_id")))
    model = toxic.fit(docs, labels)
    return (docs.withColumn("_score", toxic.score(spark, model, F.col("text")))
            .filter("_score < 0.5").drop("_score"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and no learned rule rejects stay."""
    docs = take(docs, *DOCUMENT_COLUMNS)
    rules = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.judge(docs, rules, into="_verdict").filter("_verdict.kept").drop("_verdict")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Rows equal in id and text count as one document; of a group without ids the
    row with the smallest text digest stays.
    """
    return simhash.keep_one(take(docs, *DOCUMENT_COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item stay."""
    return decontaminate.clean(take(docs, *DOCUMENT_COLUMNS), read(spark, sf_dir, "benchmark"))


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document."""
    return sentencepiece.encode(docs, public_tokenizers.path(TOKENIZER), k=2)


STAGES = [
    ("toxicity", toxicity),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", segmentation),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data folder; the last one's rows are returned."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

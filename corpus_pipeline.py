"""The corpus pipeline: from documents to packed training sequences.

Each stage works on what the one before kept and is written before the next one starts.
``run(spark, sf_dir)`` applies all stages to ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabcast.llm import mixing, ngram_join, packing, pii, toxicity
from tabcast.llm.common import materialise, table
from tabcast.llm.queries import tokenizer_path, toxic_labels


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not show as toxic."""
    # Only ids are written beside the terms that the model is fitted on; the rows, which are large, are scored as they are read.
    model, _ = toxicity.fit(docs, toxic_labels(spark, sf_dir), keep=["doc_id"])
    # The row travels as one value, so its columns may have any names.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.col("text"))
    return toxicity.score_with(rows, model).where("predicted = 0").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and as far as the source mix takes them."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in the training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Nearest-example scores, similarity groups and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus pipeline over the operators of ``medallion.llm``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. A stage works on all documents its predecessor kept,
written as Parquet and read again; all stages but the last return the columns
of ``documents``. ``run`` applies them to ``documents`` and returns the last
stage's rows: one per document in the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medallion.llm import decontamination, mixing, quality, signature_join, token_files
from medallion.llm.common import table, written
from medallion.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the smallest doc_id."""
    return signature_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled to the target weights."""
    return mixing.sample(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as token-id files; returns their index."""
    import public_tokenizers

    return token_files.write_and_read(
        docs, public_tokenizers.path("word_bpe_49k.json"), scratch_path(spark, "llm", "token_files")
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

# Training a classifier, raking and encoding have no SQL form; tests compare
# the pipeline with brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs

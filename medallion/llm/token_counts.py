"""Token counts through a digest cache.

The cache is a Parquet table (content, tokenizer, n_tokens): the SHA-256 of a
text's content and the digest of the tokenizer version that counted it. A run
joins the digests of its documents to the stored ones, encodes each distinct
missing content once, appends those counts, and reads all counts back from the
cache. The content is normalised only in ways that keep every count: null is
the empty text.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
give repeated rows; an empty table gives an empty result; a null doc_id is
kept; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import table
from medallion.llm.encoding import shared_encoder
from medallion.session import scratch_path

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"
LIMIT = 512


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and the library version that reads it."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(tokenizers.__version__.encode() + b"\0" + f.read()).hexdigest()


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache at ``path``; a missing one is made empty."""
    empty = spark.range(0).select(
        F.lit(None).cast("binary").alias("content"),
        F.lit(None).cast("string").alias("tokenizer"),
        F.lit(None).cast("long").alias("n_tokens"),
    )
    empty.write.mode("append").parquet(path)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def _encode(path: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(path, "count")
        for batch in batches:
            counts = [sum(encoder.values(t.as_py())) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                ["content", "tokenizer", "n_tokens"],
            )

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of ``docs``; the cache at
    ``cache_path`` gains the counts it lacked."""
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    text = F.coalesce(F.col("text"), F.lit(""))
    content = F.unhex(F.sha2(text, 256)).alias("content")
    known = open_cache(spark, cache_path).where(F.col("tokenizer") == version).select("content")
    missing = (
        docs.select(content, text.alias("text"))
        .join(known, "content", "left_anti")
        .groupBy("content")
        .agg(F.first("text").alias("text"))  # copies meet in the partial step, before the shuffle
    )
    missing.mapInArrow(_encode(tokenizer_path, version), CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counts = (
        spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
        .where(F.col("tokenizer") == version)
        .groupBy("content")  # two runs at once may both have stored a count
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    keyed = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), content)
    return keyed.join(counts, "content", "left").select("doc_id", "n_bytes", "n_tokens")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents with a cache of this run's own."""
    import public_tokenizers

    counts = count_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        scratch_path(spark, "llm", "token_cache"),
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)

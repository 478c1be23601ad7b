"""From raw documents to packed sequences: five stages, each one of the text operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of documents. ``run`` writes each stage's result as Parquet in the shared folder and reads it back for the next,
so that a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm import decontaminate, near_dedup, packing, quality_rules, secrets
from gaugeworks.llm.columns import share_code, staged

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    share_code(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    share_code(spark)
    return near_dedup.without_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    share_code(spark)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    share_code(spark)
    return secrets.mask_secrets(docs, length="n_chars" if "n_chars" in docs.columns else None)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    import public_tokenizers

    share_code(spark)
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontaminate", benchmark),
    ("secrets", mask),
    ("pack", pack),
]

#: Compression, signatures and tokenizers aren't SQL; tests/llm compares the result with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), spark)
    return docs

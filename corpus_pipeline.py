"""From raw documents to token shards: quality, near duplicates, decontamination, mixing, tokens.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the next stage's documents.  Every stage works on all that its predecessor kept, and
all but the last return the columns of the documents.

Edge cases: each stage takes NULLs in any column, empty and very long texts, ties, repeated
rows, an empty table and extra columns, as its operator's module states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dealscope.llm import decontaminate, mixing, quality, simhash, tokens
from dealscope.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from ``labels`` and ``docs``."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near duplicates."""
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which passages of ``benchmark`` cover less than 5 % of the words."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them: a document taken twice is there twice."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the token table it writes."""
    import public_tokenizers
    return tokens.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

#: Hashing, training and rounding are not SQL; tests/llm holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

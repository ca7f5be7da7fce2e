"""From documents to token ids: quality rules, line de-duplication, near-duplicates, benchmark
decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the docs of the next one. All but the last return the columns of documents. Null texts
count as empty; rows are removed only by the decision of a stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import bpe, decontaminate, host_quality, line_align, simhash
from meterloom.llm.common import ship, table
from meterloom.sources.scratch import scratch_path

#: No SQL engine at hand has XXH64 or byte-pair merges; the stages are tested by brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, and those of rejected hosts, go."""
    ship(spark)
    return host_quality.keep_good(spark, docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that an earlier document has are cut out; every document stays."""
    ship(spark)
    left = line_align.replace_texts(spark, docs)
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", size).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: four-word shingles, at most 4 of 64 bits."""
    ship(spark)
    return simhash.keep_first(spark, docs, threshold=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontaminate.drop_documents(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids: the token ids of what is left."""
    ship(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode_documents(docs, path, public_tokenizers.PATTERN)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what stands between two stages is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

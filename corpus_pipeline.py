"""From raw documents to packed training sequences, in five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of `documents` (the last: packed pieces). Its result
is written as Parquet and read again as the next one's docs, so a lost executor costs at most a stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontam, langid, packing, simhash, suffixdedup
from ledgerline.llm.common import tidy
from ledgerline.llm.queries import word_tokenizer


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter have no language and go."""
    return langid.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (fingerprints linked at 3 bits) the document with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings go, but for the smallest doc_id's; documents that lose all of a text go."""
    return suffixdedup.dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces, each with its sequence and its place there."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: SQL can express neither the classifier, the components nor the tokenizer; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. A stage's own tables go when its result is written, and that goes when the next stage's is."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with tidy() as keep:
            kept = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last is not None:
            last.drop()
        docs, last = kept.df, kept
    return STAGES[-1][1](spark, docs, sf_dir)

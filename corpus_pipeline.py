"""A corpus pipeline: toxic texts out, copies out, near copies out, benchmark leaks out, tokens.

Every stage takes what its predecessor kept, as a table that was written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import bpe, decontaminate, exact, nearmin, toxicity
from chartloom.llm.common import fresh_dir
from chartloom.queries.inputs import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_copies(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearmin.drop_near_copies(docs)


def unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return bpe.there_and_back(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", clean),
    ("exact_dedup", unique),
    ("near_dedup", distinct),
    ("decontaminate", unleaked),
    ("byte_bpe", tokens),
]
#: The toxicity model has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

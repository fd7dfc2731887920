"""Corpus pipeline: quality, near duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorebase.llm import bpe, decontaminate, jaccard_join, quality, secrets
from lorebase.llm.queries import VOCABULARY
from lorebase.sources.tables import materialise, read_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked."""
    return secrets.mask_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    rows = docs.select("doc_id", "lang", "source", "text")
    return bpe.encode(rows, VOCABULARY, outputs=("n_tokens", "ids", "decoded_sha256"), keep_text=False)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("bpe", tokens),
]

#: SQL expresses none of the classifier, the components and the tokenizer; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline over ``documents``: quality, near-duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. ``run`` writes each result as Parquet to
the shared folder and rereads it as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontaminate, ngram_join, packing, quality, secret_scan
from tillroll.llm.common import materialise, read_table
from tillroll.llm.queries import BYTE_TOKENIZER, tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: that of the smallest doc_id."""
    return ngram_join.deduplicate(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go; documents that consist of them mostly go whole."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Values judged secret are replaced; no document goes."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, tokenizer_path(BYTE_TOKENIZER), end_id=0).drop("ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secrets),
    ("packing", pack),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{k}")
    return docs

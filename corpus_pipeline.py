"""The training-data pipeline: ``documents`` to packed sequences.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all that the one
before it kept. ``run`` writes every stage as Parquet in the shared folder and
reads it again, so a lost executor repeats no more than its stage; what a stage
needs on the way goes when it is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import mixing, packing, rules, secrets, simhash
from riskloom.llm.common import read
from riskloom.storage import scratch_path, scratch_run


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the latest policy keeps."""
    return rules.accept(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redacted(docs, secrets.fit(spark, secrets.labelled_findings()))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, whole, as often as it takes them."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Fingerprints, the forest and the tokenizer are not SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"llm-stage-{name}")
        with scratch_run(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""From raw documents to token ids: quality, near duplicates, secrets, mixing, encoding.

Each stage gets the documents that the stage before kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stallbook.llm import bpe, mixing, quality, secret_scan, simhash
from stallbook.operators.materialize import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the top grade is at least one half."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced in the texts; no document goes."""
    return secret_scan.redacted(docs, secret_scan.trained(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, in the order of the output shards."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed as little-endian uint32."""
    return bpe.encoded(docs, keep=[c for c in docs.columns if c != "text"])


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", drop_near_duplicates),
    ("secret scan", remove_secrets),
    ("source mixing", mix_sources),
    ("bpe encoding", encode),
]

# The classifier, the forest and the fingerprints have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{i}-{name.replace(' ', '-')}")
    return docs

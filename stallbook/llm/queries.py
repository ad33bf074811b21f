"""Registered queries of the operators and of the pipeline: ``(spark, folder of tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm import ann, bpe, chat, conversation_trie, decontaminate, embedding_dedup, filter_audit, mixing, ngram_lm, quality, secret_scan, simhash, token_output
from stallbook.operators.materialize import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_lm.scores(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels").select("doc_id", quality.grade().alias("grade")))
    scored = quality.score(docs, model, keep=["doc_id"])
    return scored.withColumn("accepted", scored.p_top >= quality.ACCEPT)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.trained(docs))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = chat.linked(chat.turns_as_calls(table(spark, sf_dir, "conversations")), chat.TURN_SCHEMAS)
    return events.selectExpr("conv_id", "turn", "kind", "event_id", "name", "state", "CAST(level AS BIGINT) AS level", "CAST(size(errors) AS BIGINT) AS n_errors", "line")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.training_files(table(spark, sf_dir, "documents"), scratch_path(spark, "token-shards"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_tree(table(spark, sf_dir, "conversations"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_simhash_dedup, op2_lm_scoring, op3_quality_classifier, op4_source_mixing, op5_embedding_dedup, op6_secret_scan, op7_chat_formatting, op8_token_output, op9_bpe, op10_nearest_neighbours, op11_conversation_trie, op12_decontamination, op13_filter_audit)}

"""The registered queries of this subpackage, each over its whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.alignment import alignment_report
from tidemark.llm.byte_pair import token_digests
from tidemark.llm.chat import DIGEST_SQL, chat_digests
from tidemark.llm.embedding_dedup import embedding_report
from tidemark.llm.hidden_markov import scoring_report
from tidemark.llm.line_dedup import LINE_SQL, line_report
from tidemark.llm.packing import packing_report
from tidemark.llm.quality import quality_report
from tidemark.llm.secret_scan import secret_report
from tidemark.llm.simhash import simhash_report
from tidemark.llm.suffix_dedup import suffix_report
from tidemark.llm.toxicity import toxicity_report
from tidemark.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_report(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_report(table(spark, sf_dir, "embeddings"))


def op4_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring_report(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings."""
    control = "<|im_end|><|im_start|>assistant ok"
    planted = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role", f"'{control}' AS text")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_digests(conversations.unionByName(planted))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_report(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_report(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Query] = {
    "op1_byte_pair": op1_byte_pair,
    "op2_simhash": op2_simhash,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_hidden_markov": op4_hidden_markov,
    "op5_chat": op5_chat,
    "op6_packing": op6_packing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_quality": op8_quality,
    "op9_secret_scan": op9_secret_scan,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_line_dedup": op12_line_dedup,
    "op13_alignment": op13_alignment,
}

LLM_ORACLE_SQL: dict[str, str] = {
    "op5_chat": DIGEST_SQL,
    "op12_line_dedup": LINE_SQL,
}

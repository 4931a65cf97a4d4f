"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfare.llm.bpe import bpe_query
from wayfare.llm.embeddings import embedding_query
from wayfare.llm.fingerprints import fingerprint_query
from wayfare.llm.language import language_query
from wayfare.llm.minhash import near_duplicate_query
from wayfare.llm.oracles import ORACLE_SQL  # noqa: F401
from wayfare.llm.packing import packing_query
from wayfare.llm.prefix_trie import trie_query
from wayfare.llm.quotes import chat_query
from wayfare.llm.repair import repair_query
from wayfare.llm.secrets import secrets_query
from wayfare.llm.segment import segment_query
from wayfare.llm.substring import substring_query
from wayfare.llm.tokenfile import token_file_query


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark, d):
    return substring_query(_table(spark, d, "documents"))


def op2_best_fit_packing(spark, d):
    return packing_query(_table(spark, d, "documents"))


def op3_token_ids(spark, d):
    return token_file_query(_table(spark, d, "documents"))


def op4_secret_scan(spark, d):
    return secrets_query(_table(spark, d, "documents"))


def op5_sentencepiece(spark, d):
    return segment_query(_table(spark, d, "documents"))


def op6_language_id(spark, d):
    return language_query(_table(spark, d, "documents"))


def op7_quotation_linking(spark, d):
    return chat_query(_table(spark, d, "conversations"))


def op8_minhash(spark, d):
    return near_duplicate_query(_table(spark, d, "documents"))


def op9_embedding_dedup(spark, d):
    return embedding_query(_table(spark, d, "embeddings"))


def op10_fingerprints(spark, d):
    return fingerprint_query(_table(spark, d, "documents"))


def op11_bpe(spark, d):
    return bpe_query(_table(spark, d, "documents"))


def op12_repair(spark, d):
    return repair_query(_table(spark, d, "conversations"))


def op13_prefix_trie(spark, d):
    return trie_query(_table(spark, d, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_best_fit_packing, op3_token_ids, op4_secret_scan, op5_sentencepiece,
        op6_language_id, op7_quotation_linking, op8_minhash, op9_embedding_dedup, op10_fingerprints, op11_bpe, op12_repair, op13_prefix_trie)}



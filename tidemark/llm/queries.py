"""The registered queries of the training-data operators and their SQL.

Each applies one operator, with its production parameters, to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (alignment, ann, bpe, language, licenses, packing, prefix_trie, quality,
                          simhash, sql, token_counts, token_files, url_filter, warc)
from tidemark.llm.common import table

def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"),
                       F.col("vec_id") % 20 == 0)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"),
                                   shingle=3, bits=3)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents", "doc_id", "text"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"),
                             public_tokenizers.path("byte_bpe_50k.json"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"),
                        public_tokenizers.path("word_bpe_49k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"),
                                  public_tokenizers.path("byte_bpe_50k.json"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_nodes(table(spark, sf_dir, "conversations", "conv_id", "turn",
                                           "role", "text"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents", "doc_id", "text"),
                           public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_ann, op3_simhash_near_dedup, op4_token_counts, op5_language_id,
    op6_bpe_encode_decode, op7_warc, op8_packing, op9_quality_rules, op10_license_scan, op11_token_files, op12_prefix_trie,
    op13_tokenizer_alignment)}

#: DuckDB SQL with the same rows; the other queries are tested against brute force.
ORACLE = {"op1_url_filter": sql.URLS, "op7_warc": sql.WARC, "op9_quality_rules": sql.QUALITY}

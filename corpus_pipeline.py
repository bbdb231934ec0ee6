"""Corpus pipeline: quality rules, language, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage
before it kept. ``run`` writes each stage's rows as Parquet in the cluster's
shared folder and reads them again, so a lost executor repeats one stage's
tasks at most.

* quality rules: documents that fail the base rules or are depleted go;
* language: documents without a letter, or without one language that covers
  half of their words, go (the model is learned from the rows it is given);
* near-duplicates: one document of each SimHash component stays;
* packing: the rest is encoded and packed into sequences of 2048 tokens.

Defined results, for every stage:

* null or empty text: rejected by the quality rules (fewer than 50 words), so later stages
  see none in a run; on their own, language rejects it, near-duplicates groups it (fingerprint
  zero) and packing gives it its end id alone;
* null ``doc_id``, ``lang`` or ``source``: an id is carried and compared as a value like any other, a null
  ``lang`` is no training label, null ``source`` values are one host;
* very long texts: read whole by every stage; none is cut but by packing, into pieces;
* ties: language takes the label that sorts first; of a group of near-duplicates the document with the
  smallest id stays, and of rows with that id the one with the smallest text hash;
* repeated rows: equal rows pass or fail the first two stages together; near-duplicates keeps
  one row of them, and of rows that repeat id and text with other columns one as well;
* an empty table, or a stage that rejects all: empty tables to the end, with their columns;
* extra columns: carried unchanged to packing, whatever their names; packing returns its own
  columns only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import language, packing, quality, simhash
from tidemark.llm.common import materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=3, bits=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_rules", quality_rules), ("language_id", language_id),
          ("near_dedup", near_dedup), ("packing", pack)]

#: SimHash components, the language model and the packing are not plain SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

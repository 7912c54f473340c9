"""A training corpus from the documents table, stage by stage.

Each stage gets the documents that its predecessor kept, as they were written to Parquet, and
returns whole documents with the columns of the table; the last one writes the corpus as
token shards in training order and returns the list of its sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trustline.llm.decontaminate import decontaminate
from trustline.llm.mixing import mix
from trustline.llm.neardup import drop_near_duplicates
from trustline.llm.order import materialise
from trustline.llm.quality import select_good, train
from trustline.llm.shared import stored, table, tidy


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds good; it learns from the rated ones among them."""
    return select_good(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return drop_near_duplicates(docs)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mix(docs)


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of the corpus with their slots and places in the written shards."""
    return materialise(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("contamination", contamination),
    ("mixture", mixture),
    ("training_order", training_order),
]

#: SQL has neither the classifier's fit nor MinHash candidates or the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        tidy(spark)
    return STAGES[-1][1](spark, docs, sf_dir)

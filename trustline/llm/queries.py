"""The registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustline.llm.chat import format_chats
from trustline.llm.decontaminate import contaminated, find_benchmark
from trustline.llm.fingerprints import compare_edits
from trustline.llm.html import extract
from trustline.llm.mixing import schedule, taken
from trustline.llm.neardup import find_groups, keeps
from trustline.llm.negatives import mine
from trustline.llm.order import materialise
from trustline.llm.packing import pack_documents
from trustline.llm.passages import find_repeats
from trustline.llm.quality import TAIL, grade, train
from trustline.llm.shared import table
from trustline.llm.tokens import count_tokens
from trustline.llm.trie import prefix_trie


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document go into the mix."""
    found = taken(*schedule(table(spark, sf_dir, "documents")))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the passages that an earlier one has."""
    found = find_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.when(F.col("kept").isNull(), F.lower(F.hex("digest"))).otherwise(F.sha2("kept", 256)).alias("kept_sha256"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold passages of the benchmark, and how much of them."""
    found = find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    items = F.array_sort(F.array_distinct(F.col("report.matches.item_id")))
    return found.select(
        F.col("k0").alias("doc_id"),
        F.col("report.n_words"),
        F.col("report.n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        contaminated(F.col("report.n_hit"), F.col("report.n_words")).alias("contaminated"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of each document, and whether it is selected."""
    docs = table(spark, sf_dir, "documents")
    found = grade(docs, train(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return found.select(F.col("k0").alias("doc_id"), "expected_grade", "p_clean", "p_good", (F.col("p_good") >= TAIL).alias("kept"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation that isn't the beginning of a longer one, rendered."""
    return format_chats(table(spark, sf_dir, "conversations"))


TOKEN_LIMIT = 1024


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document, and how many of its bytes the limit holds, from the stored counts of its prefixes."""
    found = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), TOKEN_LIMIT)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fitting_bytes")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and of its edited text."""
    return compare_edits(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    found = extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of each document, at a similarity of 0.85."""
    found = find_groups(table(spark, sf_dir, "documents"), threshold=0.85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), keeps(F.col("id"), F.col("component")).alias("kept"))


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence of the corpus with its global slot and its place in the written shards."""
    return materialise(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three hard negatives of each of the first five positives of every anchor."""
    ident, label = F.col("vec_id"), F.col("label")
    moved = F.when(ident % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(table(spark, sf_dir, "embeddings"), ident % 50 == 0, label=moved)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence of at most 2,048 tokens and its place there."""
    found = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality": op4_quality,
    "op5_chat_format": op5_chat_format,
    "op6_token_counts": op6_token_counts,
    "op7_fingerprints": op7_fingerprints,
    "op8_html_extraction": op8_html_extraction,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op10_training_order": op10_training_order,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_bestfit_packing": op13_bestfit_packing,
}

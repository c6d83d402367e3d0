"""One thin query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modeloom.llm import (
    embedding,
    exact_dedup,
    katz,
    lexical,
    line_dedup,
    mixing,
    ngram_join,
    order,
    packing,
    phrases,
    prefix_trie,
    quality,
    topk_search,
)
from modeloom.plans.staging import staging_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of similar shingle sets."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that resemble an earlier one."""
    lean = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return lean.select(
        "doc_id",
        F.col("_lines").alias("n_lines"),
        F.col("_gone").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot of every sequence, read back from the written shards."""
    path = staging_path(spark, "shards")
    total = order.write_order(table(spark, sf_dir, "documents"), path)
    rows = order.read_slots(spark, path, 0, total)
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-equal vectors of one label."""
    return embedding.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores, learnt from labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    held_out = quality.remainder(F.col("doc_id"), 5) == 0
    model = quality.fit(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of all texts, learnt outside the held-out tenth."""
    return katz.katz_scores(table(spark, sf_dir, "documents"))


def op9_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without passages that a document of smaller id holds."""
    results, _ = phrases.repeated_phrases(table(spark, sf_dir, "documents"))
    return results


def op10_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from each document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations, with subtree totals."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    documents, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return lexical.ranked_documents(documents, items)


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty highest products of every twentieth vector."""
    return topk_search.top_products(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    plain = (
        op1_curve_packing, op2_ngram_join, op3_exact_dedup, op4_line_dedup, op5_training_order,
        op6_lattice_dedup, op7_compression_quality,
        op8_katz_backoff, op9_phrase_dedup, op10_entropy_mixing,
        op11_prefix_trie, op12_ranked_search, op13_topk_search,
    )
    return {query.__name__: query for query in plain}

"""The corpus pipeline: documents through five operators, each stage stored and reread."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modeloom.llm import line_dedup, mixing, ngram_join, packing, quality
from modeloom.llm.flow import stage, unused

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = quality.remainder(F.col("doc_id"), 5) == 0
    return quality.keep_good(docs, quality.fit(docs, labels, learn=~held_out))


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that resemble an earlier one; n_chars follows the text."""
    lean = line_dedup.dedup_lines(docs)
    changed = F.when(F.col(lean.columns[-1]) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return lean.withColumn("n_chars", changed.cast("long")).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar documents: that of the smallest id, a NULL id last.

    A row is known by id and text: another text of the same id is a document of its own.  Of
    rows equal in both, one stays.  Rows without words all stay.
    """
    parts = ngram_join.shingled_components(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body")).alias("first")
    grouped = parts.where("component is not null").groupBy("component").agg(first)
    number, body, other, same, worded, turn = unused(
        docs.columns, "number", "body", "other", "same", "worded", "turn"
    )
    empty = parts.where("component is null").select("doc_id", "body").distinct()
    stays = grouped.select("first.doc_id", "first.body", F.lit(True).alias(worded)).union(
        empty.withColumn(worded, F.lit(False))
    )
    stays = stays.withColumnsRenamed({"doc_id": other, "body": same})
    keyed = docs.withColumn(number, F.col("doc_id").cast("long")).withColumn(
        body, F.xxhash64("text")
    )
    held = keyed.join(
        stays, F.col(number).eqNullSafe(F.col(other)) & (F.col(body) == F.col(same))
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    turns = Window.partitionBy(number, body).orderBy(F.xxhash64(*columns))
    one = held.where(worded).withColumn(turn, F.row_number().over(turns)).where(F.col(turn) == 1)
    return one.select(*columns).union(held.where(~F.col(worded)).select(*columns))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the part of a copy that meets a source's
    target exactly is cut by whole words."""
    copies = mixing.take_copies(docs)
    return copies.withColumn(
        "n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")
    ).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed token sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("lines", distinct_lines),
    ("ngrams", distinct_documents),
    ("mixing", target_mix),
    ("packing", packed_sequences),
]

# Compression scores, MinHash and tokens cannot be written in SQL; tests compare the line and
# document stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

"""Frequency dictionaries of categorical columns and lookups in them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modeloom.plans.staging import materialise

LABEL_SCHEMA = "col string, idx long, label string, cnt long"


@dataclass(frozen=True)
class Dictionary:
    """``table``: (col, idx, label, cnt) by falling count, label ascending on ties."""

    table: DataFrame
    sizes: Mapping[str, int]
    types: Mapping[str, str]

    def of(self, column: str) -> DataFrame:
        return self.table.where(F.col("col") == F.lit(column))


def label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col, label, cnt) of all columns from one scan; NULL is not a label."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    if len(columns) == 1:
        long = texts.select(F.lit(columns[0]).alias("col"), F.col(columns[0]).alias("label"))
    else:
        long = texts.unpivot([], list(columns), "col", "label")
    return (
        long.where(F.col("label").isNotNull())
        .groupBy("col", "label")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def ranked_labels(counts: DataFrame) -> DataFrame:
    """Zero-based frequency rank within each column, without a one-task window.

    Labels are range-partitioned in rank order; a label's rank is its place in its own
    partition plus the labels of the column in earlier partitions.
    """
    order = [F.col("col"), F.col("cnt").desc(), F.col("label")]
    parts = materialise(
        counts.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    )
    sizes = parts.groupBy("col", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row per partition and column; the window below runs on these totals only.
    earlier = Window.partitionBy("col").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "col", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("col", "part").orderBy(F.col("cnt").desc(), F.col("label"))
    return (
        parts.withColumn("place", F.row_number().over(inside))
        .join(F.broadcast(offsets), ["col", "part"])
        .select("col", (F.col("before") + F.col("place") - 1).alias("idx"), "label", "cnt")
    )


def category_dictionary(df: DataFrame, columns: Sequence[str]) -> Dictionary:
    """Count, rank and materialise the labels of every categorical column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name in columns}
    table = materialise(ranked_labels(label_counts(df, columns)))
    return measured(table, columns, types)


def measured(table: DataFrame, columns: Sequence[str], types: Mapping[str, str]) -> Dictionary:
    """A dictionary with its number of labels per column."""
    rows = table.groupBy("col").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {r["col"]: r["n"] for r in rows}
    return Dictionary(table, {c: sizes.get(c, 0) for c in columns}, dict(types))


def grown_dictionary(dictionary: Dictionary, df: DataFrame) -> Dictionary:
    """The dictionary with the labels of more rows: every known label keeps its index, new ones
    follow the last index of their column by falling count, label ascending on ties.

    Counts of known labels are added up.  ``since`` names the version a label came with, 1 for
    those of a dictionary that has not grown; what was encoded under an older version decodes
    the same under a newer one.
    """
    columns, old = list(dictionary.sizes), dictionary.table
    if "since" not in old.columns:
        old = old.withColumn("since", F.lit(1))
    version = (old.agg(F.max("since")).first()[0] or 1) + 1
    more = label_counts(df, columns).withColumnRenamed("cnt", "more")
    both = materialise(old.join(more, ["col", "label"], "full_outer"))
    count = F.coalesce("cnt", F.lit(0)) + F.coalesce("more", F.lit(0))
    known = both.where("idx is not null").select("col", "idx", "label", count.alias("cnt"), "since")
    fresh = ranked_labels(both.where("idx is null").select("col", "label", F.col("more").alias("cnt")))
    taken = F.lit(0).cast("long")
    for column, size in dictionary.sizes.items():
        taken = F.when(F.col("col") == F.lit(column), F.lit(size)).otherwise(taken)
    fresh = fresh.select(
        "col", (F.col("idx") + taken).alias("idx"), "label", "cnt", F.lit(version).alias("since")
    )
    return measured(materialise(known.unionByName(fresh)), columns, dictionary.types)


def as_of(dictionary: Dictionary, version: int) -> Dictionary:
    """The dictionary as it was in an older version; its counts are those of now."""
    if "since" not in dictionary.table.columns:
        return dictionary
    table = dictionary.table.where(F.col("since") <= F.lit(version))
    return measured(table, list(dictionary.sizes), dictionary.types)


def _lookup(df: DataFrame, on: str, pairs: DataFrame, out: str) -> DataFrame:
    """Left join ``df.on`` with ``pairs`` (key, val).

    One join and no hint: the engine broadcasts the dictionary where its statistics show
    that it is small, and otherwise shuffles, splitting partitions that a frequent label,
    known or new, makes large.
    """
    side = pairs.select(F.col("key").alias("__key"), F.col("val").alias(out))
    return df.join(side, df[on] == F.col("__key"), "left").drop("__key")


def index_labels(
    df: DataFrame,
    column: str,
    dictionary: Dictionary,
    *,
    unknown: str = "error",
    out: str = "idx",
) -> DataFrame:
    """Append the dictionary index of a label.

    A label that is not in the dictionary fails the job (``error``), gets the slot past
    the last one (``keep``), or its row is left out (``skip``).
    """
    if unknown not in ("error", "keep", "skip"):
        raise ValueError(f"unknown must be 'error', 'keep' or 'skip', not {unknown!r}")
    text = f"__text_{out}"
    pairs = dictionary.of(column).select(
        F.col("label").alias("key"), F.col("idx").alias("val")
    )
    size = dictionary.sizes[column]
    keyed = df.withColumn(text, F.col(column).cast("string"))
    found = _lookup(keyed, text, pairs, out)
    strange = F.col(out).isNull() & F.col(text).isNotNull()
    if unknown == "keep":
        found = found.withColumn(out, F.when(strange, F.lit(size)).otherwise(F.col(out)))
    elif unknown == "skip":
        found = found.where(~strange)
    else:
        message = F.concat(F.lit(f"label not in the dictionary of {column}: "), F.col(text))
        found = found.withColumn(
            out, F.when(strange, F.raise_error(message).cast("long")).otherwise(F.col(out))
        )
    return found.select(*df.columns, F.col(out).cast("long").alias(out))


def labels_of(
    df: DataFrame, index: str | Column, dictionary: Dictionary, column: str, out: str = "label"
) -> DataFrame:
    """Append the label of a dictionary index, in the column's own type."""
    place = f"__place_{out}"
    pairs = dictionary.of(column).select(
        F.col("idx").alias("key"), F.col("label").alias("val")
    )
    source = F.col(index) if isinstance(index, str) else index
    text = f"__label_{out}"
    keyed = df.withColumn(place, source.cast("long"))
    found = _lookup(keyed, place, pairs, text)
    return found.select(*df.columns, F.col(text).cast(dictionary.types[column]).alias(out))

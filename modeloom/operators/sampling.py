"""Samples and ranges that bound how much a fit or a run reads."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeloom.functions.draws import SAMPLE, hash_uniform
from modeloom.operators.order_stats import column_values, order_statistics

# Fixed value: rows a fit needs at most.
FIT_SAMPLE_ROWS = 100_000


def hash_sample(
    df: DataFrame, fraction: float, key: Sequence[str], seed: int = 42, method: str = "md5"
) -> DataFrame:
    """Bernoulli sample decided by the row key alone; steps of 2^-32, or 2^-53 by ``xxhash64``."""
    return df.where(hash_uniform(key, seed, SAMPLE, method=method) < F.lit(float(min(1.0, fraction))))


def fit_sample(
    df: DataFrame, key: Sequence[str], *, target: int = FIT_SAMPLE_ROWS, seed: int = 42
) -> DataFrame:
    """About ``target`` rows: one count, then a hash sample with the fraction capped at 1."""
    rows = df.count()
    if rows == 0:
        raise ValueError("cannot sample an empty table")
    return hash_sample(df, min(1.0, target / rows), key, seed)


def block_sample(df: DataFrame, percent: float, seed: int = 42) -> DataFrame:
    """``TABLESAMPLE (percent PERCENT)``; Spark samples rows, not storage blocks."""
    return df.sparkSession.sql(
        f"SELECT * FROM {{source}} TABLESAMPLE ({Decimal(repr(float(percent))):f} PERCENT) REPEATABLE ({int(seed)})",
        source=df,
    )


def folder_sample(
    df: DataFrame, percent: float, by: Sequence[str] = ("chunk",), seed: int = 42
) -> DataFrame:
    """About ``percent`` of a stored table's folders, whole, by a hash of their partition values.

    The others are pruned before anything of them is read.  The same folders on every run;
    a folder keeps its place when others are added.
    """
    return df.where(hash_uniform(by, seed, SAMPLE) < F.lit(min(1.0, percent / 100.0)))


def file_sample(df: DataFrame, percent: float, seed: int = 42) -> DataFrame:
    """About ``percent`` of a stored table's files, whole, by a hash of their names.

    Files are pruned when the scan is planned.  The same files as long as they are stored.
    """
    name = F.concat(F.lit(f"{SAMPLE}|{int(seed)}|"), F.col("_metadata.file_name"))
    head = F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double")
    return df.where(head < F.lit(4294967296.0 * min(1.0, percent / 100.0)))


def first_rows(df: DataFrame, n: int, id_column: str) -> DataFrame:
    """The ``n`` rows with the smallest ids, for a unique numeric id.

    The n-th id is found as an order statistic and pushed down as a filter, so no task
    holds all n rows the way an ordered limit would.
    """
    found = order_statistics(column_values(df, [id_column], as_type="bigint"), {0: [n]})
    if not found:
        return df
    return df.where(F.col(id_column) <= F.lit(int(found[(0, n)])))


def chunk_by_range(id_column: str, chunk_rows: int) -> Column:
    """Chunk number of an id when chunks are consecutive id ranges; exact for all ids."""
    return floor_div(F.col(id_column), chunk_rows)


def floor_div(number: Column, by: int) -> Column:
    """``floor(number / by)`` in whole numbers, exact past 2^53 and below 0."""
    whole, by = number.cast("long"), F.lit(int(by)).cast("long")
    # neither the quotient nor the remainder leaves the range, unlike number - remainder
    quotient = F.call_function("div", whole, by).cast("long")
    return quotient - F.when((whole % by) < 0, 1).otherwise(0)


def chunk_by_modulo(id_column: str, n_chunks: int) -> Column:
    """Chunk number of an id when ids are dealt round-robin: disjoint and complete."""
    return F.pmod(F.col(id_column), F.lit(int(n_chunks))).cast("long")


def range_condition(id_column: str, chunk: int, chunk_rows: int) -> Column:
    """Whether an id lies in a range chunk, as two bounds."""
    low = int(chunk) * int(chunk_rows)
    return (F.col(id_column) >= F.lit(low)) & (F.col(id_column) < F.lit(low + int(chunk_rows)))


def range_chunk(df: DataFrame, id_column: str, chunk: int, chunk_rows: int) -> DataFrame:
    """Rows of one id range; both bounds reach the file statistics."""
    return df.where(range_condition(id_column, chunk, chunk_rows))

"""A large column drawn from the percentile profile of a small one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from modeloom.functions.arrays import number
from modeloom.functions.draws import SYNTH, hash_uniform
from modeloom.operators.sampling import floor_div

# The brackets of the compatible form.  Each bracket is tried in turn
# with its own chance, so the chances that reach it multiply.
BRACKETS = (("p25", "p50"), ("p50", "p75"), ("p75", "p90"), ("p90", "p95"), ("p95", "p99"))
BRACKET_CHANCES = (0.25, 0.75, 0.90, 0.95)
# The knots of the inverse distribution function.
KNOTS = (
    (0.0, "min"), (0.25, "p25"), (0.5, "p50"), (0.75, "p75"),
    (0.9, "p90"), (0.95, "p95"), (0.99, "p99"), (1.0, "max"),
)


# Rows of one generating task.
TASK_ROWS = 5_000_000
# Batches that get a folder each; of more, small ones share folders of about so many rows.
FOLDERS = 1000
FOLDER_ROWS = 1_000_000


def bracket_probabilities() -> list[float]:
    out, left = [], 1.0
    for chance in BRACKET_CHANCES:
        out.append(left * chance)
        left *= 1 - chance
    return [*out, left]


def _pieces(profile: Mapping[str, float], compat: str | None):
    """(from, to, low, high): uniform range and the value range it maps to."""
    if compat is None:
        values = [(q, float(profile[name])) for q, name in KNOTS]
        return [(a, b, low, high) for (a, low), (b, high) in zip(values, values[1:])]
    if compat != "bracket":
        raise ValueError(f"compat must be None or 'bracket', not {compat!r}")
    pieces, start = [], 0.0
    for share, (low, high) in zip(bracket_probabilities(), BRACKETS, strict=True):
        pieces.append((start, start + share, float(profile[low]), float(profile[high])))
        start += share
    return pieces


def inverse_cdf(uniform: Column, profile: Mapping[str, float], compat: str | None = None) -> Column:
    """Piecewise-linear value of a uniform draw."""
    pieces = _pieces(profile, compat)
    value = None
    for start, stop, low, high in reversed(pieces):
        piece = number(low) + (uniform - number(start)) / number(stop - start) * number(high - low)
        value = piece if value is None else F.when(uniform < number(stop), piece).otherwise(value)
    return value


def synthesize(
    spark: SparkSession,
    rows: int,
    profile: Mapping[str, float],
    *,
    seed: int = 42,
    compat: str | None = None,
    partitions: int | None = None,
    column: str = "amount",
) -> DataFrame:
    """``id`` 0..rows-1 with a value each; a row's value depends on id and seed only.

    ``compat='bracket'`` draws between the 25th and 99th percentile with the uneven
    bracket chances of the sequential form; the default covers min to max.
    """
    parts = partitions or max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
    ids = spark.range(0, rows, 1, parts)
    staged = ids.withColumn("__u", hash_uniform(["id"], seed, SYNTH))
    return staged.select("id", inverse_cdf(F.col("__u"), profile, compat).alias(column))


def generate_dataset(
    spark: SparkSession,
    path: str,
    rows: int,
    profile: Mapping[str, float],
    *,
    batch_rows: int | None = None,
    partitions: int | None = None,
    **options,
) -> dict[str, int]:
    """Write ``rows`` synthetic rows as ``batch=N`` folders and count them as they are written.

    Batches are id ranges, so each task's rows fall into few of them and one job without a
    shuffle writes everything.  A folder costs a file and a listing however few its rows:
    beyond ``FOLDERS`` batches, small ones are stored together in ``batch_from=N`` folders, N
    the first of them, and their rows keep ``batch`` as a column.  ``batch*`` reads either form.
    """
    batch_rows = batch_rows or max(1, min(10_000_000, rows // 10))
    data = synthesize(spark, rows, profile, partitions=partitions, **options)
    batched = data.withColumn("batch", floor_div(F.col("id"), batch_rows))
    folder, together = "batch", max(1, FOLDER_ROWS // batch_rows)
    if -(-rows // batch_rows) > FOLDERS and together > 1:
        folder = "batch_from"
        first = floor_div(F.col("batch"), together) * F.lit(together)
        batched = batched.withColumn(folder, first)
    seen = Observation()
    # one stage writes: every task's rows count once, whatever is tried again
    counted = batched.observe(seen, F.count(F.lit(1)).alias("written"))
    counted.write.mode("overwrite").partitionBy(folder).parquet(path)
    return {"expected": rows, "written": seen.get["written"]}

"""Fits that remember their chunks: redo one chunk, refit without reading the others.

The summary of every chunk is stored (see :mod:`modeloom.operators.cells`).  When a chunk is
redone its cells replace the old ones, and all chunks' cells are merged and fitted: the same
cells, and so the same fit, as one scan of the whole table gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modeloom.operators.cells import CELL_SCHEMA, CELLS, gathered, merged
from modeloom.operators.mixture import MixtureModel, fit_cells
from modeloom.sources.sinks import write_chunks

STORED = CELL_SCHEMA + ", chunk long"
# A chunk without rows keeps one line under this column number.
NO_COLUMN = -1


def store_cells(
    df: DataFrame,
    columns: Sequence[str | Column],
    path: str,
    *,
    chunk: Column,
    chunks: Sequence[int] | None = None,
    limit: int = CELLS,
) -> None:
    """Write the summaries of the chunks in ``df`` below ``path``, in place of older ones.

    ``chunks`` names the chunks that are redone: only their rows are taken, and one that has no
    rows any more is emptied.  Other chunks are left as they are.
    """
    spark = df.sparkSession
    if chunks is not None:
        df = df.where(chunk.isin(*[int(c) for c in chunks]))
    cells = gathered(df, columns, limit=limit, chunk=chunk)
    if chunks is not None:
        none = spark.createDataFrame([(int(c),) for c in chunks], "chunk long").select(
            "chunk", F.lit(NO_COLUMN).alias("c"), F.lit(64).alias("bits"),
            F.lit(0).cast("long").alias("part"),
            *[F.lit(0.0).alias(n) for n in ("n", "mean", "m2", "low", "high")],
        )
        cells = cells.unionByName(none)
    write_chunks(cells.hint("rebalance", F.col("chunk")), path)


def stored_cells(spark: SparkSession, path: str, *, limit: int = CELLS) -> DataFrame:
    """The summary of all stored chunks together."""
    parts = spark.read.schema(STORED).parquet(path).where(F.col("c") != NO_COLUMN)
    return merged(parts.drop("chunk"), limit=limit)


def fit_stored(
    spark: SparkSession, path: str, columns: Sequence[str], *, limit: int = CELLS, **options
) -> dict[str, MixtureModel]:
    """Fit the stored columns; reads no row of the table."""
    models = fit_cells(stored_cells(spark, path, limit=limit), len(columns), **options)
    return dict(zip(columns, models, strict=True))

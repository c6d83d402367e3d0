"""Whole jobs: read, validate, fit, encode, save - at once or by chunk."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modeloom.operators.evaluate import encoding_stats
from modeloom.operators.quality import quality_report, validate, watched
from modeloom.operators.sampling import (
    block_sample,
    chunk_by_modulo,
    chunk_by_range,
    range_condition,
)
from modeloom.operators.synth import generate_dataset
from modeloom.operators.table import TableEncoder, fit_table
from modeloom.sources.sinks import write_chunks
from modeloom.spec import Categorical, Continuous, Mixed

LOG = logging.getLogger(__name__)


def encode_job(
    df: DataFrame,
    spec: Mapping[str, Continuous | Mixed | Categorical],
    *,
    key: Sequence[str],
    save: Callable[[DataFrame], None] | None = None,
    fit_on: DataFrame | None = None,
    **options,
) -> tuple[TableEncoder, DataFrame, DataFrame]:
    """Validate, fit (on ``fit_on`` or on all rows), encode and, if asked, save.

    Returns the encoder, the encoded table and the quality report; bad values are logged.  A
    job that saves counts them while it writes; ``save`` must write all rows in its first job.
    """
    if save is None:
        report = checked(df, list(spec))
    else:
        require(df, list(spec))
    encoder = fit_table(df if fit_on is None else fit_on, spec, key=key, **options)
    encoded = encoder.encode(df)
    if save is not None:
        seen, counted = watched(df, list(spec))
        save(encoder.encode(seen))
        report = logged(counted())
    return encoder, encoded, report


def require(df: DataFrame, columns: Sequence[str]) -> None:
    if not validate(df, columns):
        raise ValueError(f"data validation failed: {sorted(set(columns) - set(df.columns))} missing")


def checked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The quality report of all columns, from one pass; missing columns are an error.

    Columns with NULL, NaN or empty values are logged.  The report is a few lines.
    """
    require(df, columns)
    return logged(quality_report(df, columns))


def logged(report: DataFrame) -> DataFrame:
    """The report, computed once, with a log line for every column with bad values."""
    lines = report.collect()
    for row in lines:
        if row["nulls"] + row["nans"] + row["empties"] > 0:
            LOG.warning(
                "%s: %d null, %d NaN, %d empty of %d rows",
                row["col"], row["nulls"], row["nans"], row["empties"], row["rows"],
            )
    return report.sparkSession.createDataFrame(lines, report.schema)


def with_chunk(
    df: DataFrame, id_column: str, *, n_chunks: int | None = None, chunk_rows: int | None = None
) -> DataFrame:
    """Append ``chunk``: id ranges of ``chunk_rows``, or ``n_chunks`` dealt by modulo."""
    if (n_chunks is None) == (chunk_rows is None):
        raise ValueError("give either n_chunks or chunk_rows")
    number: Column = (
        chunk_by_modulo(id_column, n_chunks)
        if chunk_rows is None
        else chunk_by_range(id_column, chunk_rows)
    )
    return df.withColumn("chunk", number)


def chunk_filter(
    df: DataFrame, id_column: str, chunks: Sequence[int], chunk_rows: int
) -> DataFrame:
    """Rows of the named range chunks; the ranges reach the file statistics."""
    ranges = [range_condition(id_column, c, chunk_rows) for c in sorted(set(chunks))]
    return df.where(reduce(lambda a, b: a | b, ranges, F.lit(False)))


def encode_chunks(
    df: DataFrame,
    encoder: TableEncoder,
    path: str,
    *,
    id_column: str,
    n_chunks: int | None = None,
    chunk_rows: int | None = None,
    only: Sequence[int] | None = None,
    gather: bool = True,
) -> DataFrame:
    """Encode into ``path/chunk=N`` in one job and return the stored table.

    ``only`` redoes the named chunks and leaves the others as they are; of range chunks,
    only their id ranges are read.  ``gather`` brings the rows of a chunk together before
    they are encoded, in partitions of the engine's advisory size: small chunks are one
    file each, and large chunks are split over many tasks.
    """
    checked(df, list(encoder.kinds))
    if only is not None and chunk_rows is not None:
        df = chunk_filter(df, id_column, only, chunk_rows)
    chunked = with_chunk(df, id_column, n_chunks=n_chunks, chunk_rows=chunk_rows)
    if only is not None:
        chunked = chunked.where(F.col("chunk").isin(*[int(c) for c in only]))
    if gather:
        chunked = chunked.hint("rebalance", F.col("chunk"))
    write_chunks(encoder.encode(chunked), path)
    return df.sparkSession.read.parquet(path)


def chunked_job(
    source: DataFrame,
    spec: Mapping[str, Continuous | Mixed | Categorical],
    path: str,
    *,
    id_column: str,
    n_chunks: int,
    sample_percent: float | None = None,
    seed: int = 42,
    **options,
) -> tuple[TableEncoder, DataFrame]:
    """Fit once, on a table sample if asked, then encode every chunk; returns the encoder
    with the :func:`encoding_stats` of the stored table."""
    fit_on = source if sample_percent is None else block_sample(source, sample_percent, seed)
    encoder = fit_table(fit_on, spec, key=[id_column], seed=seed, **options)
    stored = encode_chunks(source, encoder, path, id_column=id_column, n_chunks=n_chunks)
    return encoder, encoding_stats(stored)


def ensure_rows(
    spark: SparkSession, path: str, rows: int, profile: Mapping[str, float], **options
) -> dict[str, int]:
    """Generate the dataset only where fewer than ``rows`` rows are stored at ``path``."""
    try:
        stored = spark.read.parquet(path).count()
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        stored = 0
    if stored >= rows:
        return {"expected": rows, "written": stored}
    return generate_dataset(spark, path, rows, profile, **options)

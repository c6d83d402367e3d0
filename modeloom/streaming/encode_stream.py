"""Encoding new rows as they arrive.

A fitted encoder is a stateless projection, so the same ``encode`` runs on a streaming
DataFrame.  ``available_now`` drains what is there and stops: a restartable batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from modeloom.operators.table import TableEncoder


def read_parquet_stream(
    spark: SparkSession, folder: str, schema, *, pattern: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of the parquet files that appear in ``folder``."""
    reader = spark.readStream.schema(schema)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def encode_stream(
    stream: DataFrame,
    encoder: TableEncoder,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start writing the encoded stream to parquet at ``path``; files are exactly-once."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return (
        encoder.encode(stream)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )

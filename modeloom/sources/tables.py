"""Readers: catalog tables, external connectors, SQL, parquet folders, CSV samples."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    name: str,
    *,
    format: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A whole table by name.

    Without ``format`` the name is looked up in the session catalog.  With one, the
    connector of that name must be on the session's class path; it gets the table name
    as its ``table`` option.
    """
    if format is None:
        return spark.read.table(name)
    return spark.read.format(format).options(**dict(options or {})).option("table", name).load()


def read_query(
    spark: SparkSession,
    query: str,
    *,
    format: str | None = None,
    options: Mapping[str, str] | None = None,
    **views: DataFrame,
) -> DataFrame:
    """The rows of a SQL text.

    With ``format`` the text is handed to the connector, which runs it at the source;
    otherwise Spark runs it, with ``{name}`` standing for each DataFrame given.
    """
    if format is None:
        return spark.sql(query, **views)
    return spark.read.format(format).options(**dict(options or {})).option("query", query).load()


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One or many parquet folders; globs such as ``root/batch=*`` read as one table."""
    return spark.read.parquet(*paths)


def read_partitioned(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """The folders below ``root`` that match ``pattern``, keeping the partition column."""
    return spark.read.option("basePath", root).parquet(f"{root.rstrip('/')}/{pattern}")


def read_csv_sample(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A CSV file with a header.  Give the schema where it is known: inferring it reads
    the file twice."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)

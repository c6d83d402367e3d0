"""Writers: parquet folders, catalog tables, external connectors, chunked tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a folder."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_table(
    df: DataFrame,
    name: str,
    *,
    format: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Overwrite a table, in the catalog or through a connector (``table`` option)."""
    if format is None:
        df.write.mode("overwrite").saveAsTable(name)
        return
    writer = df.write.format(format).options(**dict(options or {})).option("table", name)
    writer.mode("overwrite").save()


def write_chunks(df: DataFrame, path: str, chunk: str = "chunk") -> None:
    """Replace just the chunks present in ``df``; all other chunks of ``path`` stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        chunk
    ).parquet(path)


# The table property that names the stages a merged table was made of.
MERGED = "merged_from"


def merge_stages(spark: SparkSession, stages: Sequence[str], name: str) -> None:
    """One catalog table out of the stage tables, which are then dropped.

    Can be run again wherever it was stopped, and gives the same table: the new table is
    written under another name, marked with its stages and renamed; stages go only then.  A
    run that finds stages missing drops the rest if the mark says that the table holds them,
    and fails if not.  The catalog has no swap: between two commands the name is free.
    """
    mark = ",".join(stages)
    missing = [s for s in stages if not spark.catalog.tableExists(s)]
    if missing and _property(spark, name, MERGED) != mark:
        raise ValueError(f"stage tables are missing: {missing}")
    if not missing:
        merged = spark.read.table(stages[0])
        for stage in stages[1:]:
            merged = merged.unionByName(spark.read.table(stage))
        fresh = f"{name}__next"
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        merged.write.saveAsTable(fresh)
        spark.sql(f"ALTER TABLE {fresh} SET TBLPROPERTIES ('{MERGED}' = '{mark}')")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    for stage in stages:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")


def _property(spark: SparkSession, name: str, key: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows}.get(key)

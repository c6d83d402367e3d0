"""Shared-storage materialisation.

Loops and two-pass operators must not re-read the source, and must give the same
rows on both passes even if an executor is lost in between.  They cut the lineage
with a reliable checkpoint in the folder the session names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# local, local[8], local[*, 2]; not local-cluster, whose executors are processes of their own
LOCAL = re.compile(r"local(\[.*\])?")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder; an error on a cluster that names none.

    A temporary folder is made only for a local master, where one process holds every task.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and LOCAL.fullmatch(context.master):
        named = tempfile.mkdtemp(prefix="modeloom-checkpoint-")
    if named is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(named)
    return named


def materialise(df: DataFrame) -> DataFrame:
    """``df`` computed once, with its lineage cut, in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for staged tables."""
    root = checkpoint_folder(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"

"""Helpers to move numpy arrays through Spark shuffles, and global running totals.

Shuffling one packed row per (task, bucket) instead of one row per entry keeps the
bytes moved and the JVM's work small.  Spark still partitions, spills and retries.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modeloom.plans.staging import materialise, staging_path

# Entries of one task are sent on once they take this much memory.
FLUSH_BYTES = 48 << 20
# Bytes of text whose entries share a bucket.
BUCKET_TEXT = 8 << 20
# Buckets that one task works on, one after the other, where there are more than tasks.
TASK_BUCKETS = 8


def bucket_count(spark: SparkSession, factor: int = 2) -> int:
    """Buckets of packed arrays: they follow the session's shuffle partitions."""
    return max(1, factor * int(spark.conf.get("spark.sql.shuffle.partitions")))


def buckets_for(docs: DataFrame, text: str = "text", factor: int = 2) -> int:
    """Buckets of packed arrays made from texts: one for every ``BUCKET_TEXT`` bytes of them.

    A bucket is worked on by one task in memory, so their number follows the data; it is never
    below :func:`bucket_count`.
    """
    size = docs.agg(F.sum(F.octet_length(text)).alias("size")).collect()[0]["size"] or 0
    return max(bucket_count(docs.sparkSession, factor), -(-size // BUCKET_TEXT))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 64-bit hash, from its upper half."""
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


class Packer:
    """Gathers parallel arrays by bucket; ``rows`` gives batches of packed rows.

    Columns in ``runs`` mostly repeat from one entry to the next: a run is sent as one
    value, with its length in the column ``<name>_n``.
    """

    def __init__(self, names: list[str], runs: tuple[str, ...] = (), limit: int = FLUSH_BYTES):
        self.names, self.runs, self.limit = names, runs, limit
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, bucket: np.ndarray, *arrays: np.ndarray) -> None:
        if len(bucket):
            self.parts.append((bucket, *arrays))
            self.size += bucket.nbytes + sum(a.nbytes for a in arrays)

    def full(self) -> bool:
        return self.size >= self.limit

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        bucket, *arrays = (np.concatenate(a) for a in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[starts[1:], len(bucket)]
        arrays = [a[order] for a in arrays]
        # a few rows at a time, so that no batch holds more than a bounded share
        for low in range(0, len(starts), 64):
            at = slice(low, low + 64)
            columns = [pa.array(bucket[starts[at]], pa.int32())]
            names = ["bucket"]
            for name, a in zip(self.names, arrays, strict=True):
                cuts = [a[s:e] for s, e in zip(starts[at], ends[at], strict=True)]
                if name in self.runs:
                    first = [np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) for c in cuts]
                    sizes = [
                        np.diff(np.r_[f, len(c)]).astype(np.uint32)
                        for f, c in zip(first, cuts, strict=True)
                    ]
                    columns.append(pa.array([x.tobytes() for x in sizes], pa.binary()))
                    names.append(f"{name}_n")
                    cuts = [c[f] for f, c in zip(first, cuts, strict=True)]
                columns.append(pa.array([x.tobytes() for x in cuts], pa.binary()))
                names.append(name)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def schema(self) -> str:
        parts = ["bucket int"]
        for name in self.names:
            parts += [f"{name}_n binary"] * (name in self.runs) + [f"{name} binary"]
        return ", ".join(parts)


def unpack(table: pa.Table, name: str, dtype: str) -> np.ndarray:
    """One packed column of a group of rows as a single array."""
    pieces = [np.frombuffer(x.as_buffer(), dtype) for x in table.column(name)]
    whole = np.concatenate(pieces) if pieces else np.zeros(0, dtype)
    if f"{name}_n" in table.column_names:
        return np.repeat(whole, unpack(table, f"{name}_n", "<u4"))
    return whole


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as keep it apart from ``columns``."""
    held = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in held:
            name = "_" + name
        held.add(name.lower())
        out.append(name)
    return out


def by_bucket(packed: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Run ``work`` on all packed rows of each bucket."""
    return packed.groupBy("bucket").applyInArrow(work, schema)


def whole_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one bucket after another, from rows sorted by bucket."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        if not len(bucket):
            continue
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for s, e in zip(starts, [*starts[1:], len(bucket)], strict=True):
            if held and bucket[s] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = bucket[s]
            held.append(batch.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def along_buckets(
    packed: DataFrame,
    work: Callable[[Iterator[pa.Table]], Iterator[pa.RecordBatch]],
    schema: str,
    buckets: int,
) -> DataFrame:
    """Run ``work`` on the buckets of each task, one after the other.

    Buckets are dealt evenly to tasks.  What ``work`` sums up may cover several buckets, so
    more and smaller buckets need less memory without more rows made.
    """
    parts = min(buckets, max(bucket_count(packed.sparkSession, 1), -(-buckets // TASK_BUCKETS)))
    dealt = packed.repartitionById(parts, F.pmod("bucket", F.lit(parts)))
    return dealt.sortWithinPartitions("bucket").mapInArrow(
        lambda batches: work(whole_buckets(batches)), schema
    )


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Return free memory that Arrow and the C library hold for later to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(work: Work) -> Work:
    """``work``, after which a worker is as small as before.

    Spark keeps its Python workers for later tasks, of other operators too; what one of them
    holds is missing there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the session's shared folder and read it back.

    The table is compressed, survives lost executors and cuts the lineage.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def running_total(
    df: DataFrame, order: list[str], size: str, name: str = "before"
) -> tuple[DataFrame, int]:
    """Add the sum of ``size`` over all rows before each row in ``order``; and the grand total.

    Rows are range-partitioned by ``order``; only one sum per partition reaches the
    driver.  The result keeps the partitions in order and the rows sorted in them.
    ``df`` should be materialised, since range partitioning reads it twice.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialise(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    )
    sums = (
        ranged.groupBy(F.spark_partition_id().alias("part"))
        .agg(F.sum(F.col(size).cast("long")).alias("total"))
        .collect()
    )
    totals = np.zeros(max([row["part"] for row in sums], default=-1) + 2, np.int64)
    for row in sums:
        totals[row["part"] + 1] = row["total"] or 0
    base = np.cumsum(totals)
    starts = base.tolist()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = starts[min(TaskContext.get().partitionId(), len(starts) - 1)]
        for batch in batches:
            values = batch.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = at + np.cumsum(values)
            if len(ends):
                at = int(ends[-1])
            yield batch.append_column(name, pa.array(ends - values, pa.int64()))

    schema = T.StructType([*ranged.schema.fields, T.StructField(name, T.LongType())])
    return ranged.mapInArrow(add, schema), int(base[-1])

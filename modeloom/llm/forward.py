"""Subtree totals of huge trees by time-forward processing.

Nodes are sorted by reverse level order, so every node comes after all its descendants.  A node
takes the totals its children have sent, adds its own values and sends the sum to its parent:
a message in a priority queue ordered like the nodes.  The queue keeps a bounded number of
messages in memory and spills sorted runs; Spark sorts the nodes.

The tree is cut into shards by ranges of (owner, depth).  A parent must never come after its
child in that order, so totals leave a shard only towards earlier ones: messages whose address
is not in the shard are its shard roots' totals.  They are added up by address and passed to the
shards that hold the addresses, round by round, until none is left.  A round reads only shards
that got messages; there are as many rounds as shards that a path to the root enters, at most
the number of shards.
"""

from __future__ import annotations

import heapq
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.llm.flow import stage

# Nodes of one shard, at least and at most, and messages a queue keeps in memory.
LEAST_NODES = 1 << 14
SHARD_NODES = 1 << 20
QUEUE_LIMIT = 1 << 17
# Messages read back at once from a spilled run.
RUN_BLOCK = 4096

ADDRESS = ["owner", "depth"]
PASSED = "sent boolean, shard int, owner long, depth long, leaves long, saved long"


class MessageQueue:
    """A priority queue of equal-length tuples of whole numbers with bounded memory.

    Runs go to unnamed files that vanish with the task, beside Spark's own spills; no other
    task reads them.
    """

    def __init__(self, limit: int = QUEUE_LIMIT, width: int = 4):
        self.limit, self.width = limit, width
        self.heap: list[tuple] = []
        # the next message of every run, with the run it came from
        self.heads: list[tuple[tuple, int, Iterator[tuple]]] = []
        self.runs = 0

    def push(self, message: tuple) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, message)

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        np.array(sorted(self.heap), np.int64).tofile(file)
        file.seek(0)
        self.heap = []
        self.runs += 1
        self._next(self.runs, self._read(file))

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while data := file.read(RUN_BLOCK * self.width * 8):
                yield from map(tuple, np.frombuffer(data, np.int64).reshape(-1, self.width).tolist())

    def _next(self, run: int, messages: Iterator[tuple]) -> None:
        first = next(messages, None)
        if first is not None:
            heapq.heappush(self.heads, (first, run, messages))

    def peek(self) -> tuple | None:
        """The smallest message, or None."""
        low = self.heap[0] if self.heap else None
        if self.heads and (low is None or self.heads[0][0] < low):
            return self.heads[0][0]
        return low

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            message, run, rest = heapq.heappop(self.heads)
            self._next(run, rest)
            return message
        return heapq.heappop(self.heap)


class Shard:
    """Time-forward processing of one shard's sorted nodes and incoming messages."""

    def __init__(self, limit: int = QUEUE_LIMIT):
        self.queue = MessageQueue(limit)
        self.out: list[tuple] = []

    def upto(self, address: tuple[int, int]) -> tuple[int, int]:
        """What was sent to ``address``; messages to addresses before it leave the shard."""
        leaves = saved = 0
        while (first := self.queue.peek()) is not None and first[:2] <= address:
            depth, owner, more_leaves, more_saved = self.queue.pop()
            if (depth, owner) == address:
                leaves, saved = leaves + more_leaves, saved + more_saved
            else:
                self._leave(depth, owner, more_leaves, more_saved)
        return leaves, saved

    def _leave(self, depth: int, owner: int, leaves: int, saved: int) -> None:
        """A message to another shard; those to one address follow each other and add up."""
        if self.out and self.out[-1][0] and self.out[-1][1:3] == (owner, -depth):
            last = self.out.pop()
            leaves, saved = leaves + last[3], saved + last[4]
        self.out.append((True, owner, -depth, leaves, saved))

    def take(self, node: bool, depth: int, owner: int, above: int | None, leaves, saved) -> None:
        """The next row: a message for a node to come, or a node."""
        if not node:
            self.queue.push((-depth, owner, leaves, saved))
            return
        more_leaves, more_saved = self.upto((-depth, owner))
        leaves, saved = leaves + more_leaves, saved + more_saved
        if leaves or saved:
            self.out.append((False, owner, depth, leaves, saved))
            if above is not None:
                self.queue.push((1 - depth, above, leaves, saved))

    def end(self) -> None:
        while self.queue.peek() is not None:
            depth, owner, leaves, saved = self.queue.pop()
            self._leave(depth, owner, leaves, saved)


def shard_pass(rows: DataFrame, limit: int = QUEUE_LIMIT) -> DataFrame:
    """One pass over rows (node, shard, owner, depth, above, leaves, saved) sorted by shard and
    reverse level order, messages before nodes: totals of nodes, and messages sent out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = Shard(limit), None

        def results():
            rows, shard.out = shard.out, []
            sent, owner, depth, leaves, saved = zip(*rows, strict=True)
            kinds = [pa.bool_(), pa.int32(), *[pa.int64()] * 4]
            columns = [sent, [number] * len(rows), owner, depth, leaves, saved]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["sent", "shard", *ADDRESS, "leaves", "saved"],
            )

        for batch in batches:
            for at, node, owner, depth, above, leaves, saved in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if at != number:
                    shard.end()
                    if shard.out:
                        yield results()
                    shard, number = Shard(limit), at
                shard.take(node, depth, owner, above, leaves, saved)
                # the last message may still grow
                if len(shard.out) > 20_000 and not shard.out[-1][0]:
                    yield results()
        shard.end()
        if shard.out:
            yield results()

    return rows.mapInArrow(work, PASSED)


def _in_order(rows: DataFrame, parts: int) -> DataFrame:
    ordered = rows.select("shard", "node", *ADDRESS, "above", "leaves", "saved")
    return ordered.repartition(parts, "shard").sortWithinPartitions(
        "shard", F.desc("depth"), "owner", "node"
    )


def subtree_totals(
    nodes: DataFrame,
    *,
    least_nodes: int = LEAST_NODES,
    shard_nodes: int = SHARD_NODES,
    limit: int = QUEUE_LIMIT,
) -> DataFrame:
    """(owner, depth, leaves, saved): sums over the subtree of every node.

    ``nodes`` has unique (owner, depth), ``above`` (the parent's owner; its depth is one less;
    NULL for a root) and the node's own ``leaves`` and ``saved``.  ``above <= owner`` must hold.
    Nodes whose sums are 0 are left out.  There are as many shards as shuffle partitions, but
    none is cut below ``least_nodes`` or left above ``shard_nodes`` on average.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.select(*ADDRESS, "above", "leaves", "saved")
    count = rows.count()
    parts = max(1, min(parts, -(-count // least_nodes)), -(-count // shard_nodes))
    placed = rows.repartitionByRange(parts, *ADDRESS).withColumn("shard", F.spark_partition_id())
    placed = stage(placed.withColumn("node", F.lit(True)), "shards")
    starts = placed.groupBy("shard").agg(F.min(F.struct(*ADDRESS)).alias("low")).collect()
    starts = sorted((r["low"]["owner"], r["low"]["depth"], r["shard"]) for r in starts)

    def shard_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners = np.array([s[0] for s in starts], np.int64)
        for batch in batches:
            found = []
            for owner, depth in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                at = int(np.searchsorted(owners, owner, side="right")) - 1
                while starts[at][:2] > (owner, depth):
                    at -= 1
                found.append(starts[at][2])
            yield batch.append_column("shard", pa.array(found, pa.int32()))

    work, totals = placed, []
    while True:
        passed = stage(shard_pass(_in_order(work, parts), limit), "passed")
        totals.append(passed.where("not sent").select(*ADDRESS, "leaves", "saved"))
        sent = passed.where("sent").groupBy(*ADDRESS).agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
        )
        sent = stage(
            sent.mapInArrow(shard_of, "owner long, depth long, leaves long, saved long, shard int"),
            "messages",
        )
        reached = [r["shard"] for r in sent.select("shard").distinct().collect()]
        if not reached:
            break
        zero = F.lit(0).cast("long")
        again = placed.where(F.col("shard").isin(reached))
        messages = sent.withColumn("node", F.lit(False)).withColumn("above", F.lit(None).cast("long"))
        work = again.withColumn("leaves", zero).withColumn("saved", zero).unionByName(messages)
    whole = totals[0]
    for part in totals[1:]:
        whole = whole.union(part)
    return whole.groupBy(*ADDRESS).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )

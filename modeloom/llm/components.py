"""Connected components of a link table: forests of tasks, then alternating stars, in Spark.

Each task first reduces its links to a forest.  Up to ``TASK_LINKS`` links are then joined by
one task; more are dealt to tasks of about so many, which reduce them once more, and then
every node hands its larger neighbours to its smallest neighbour, and its smaller ones
likewise, until nothing changes.  A hub's links are spread by the engine's skew splitting;
minima combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.plans.staging import materialise

# Links that a task holds at once; whatever their number, no task joins more.
TASK_LINKS = 1 << 20


def rooted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node that the links name, and the smallest node it reaches by them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    x, y = at[: len(a)], at[len(a) :]
    while True:
        x, y = root[x], root[y]
        apart = x != y
        if not apart.any():
            return nodes, nodes[root]
        x, y = x[apart], y[apart]
        # the larger root goes below the smallest one it meets
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _joined(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`rooted` over all links of a task, ``TASK_LINKS`` at a time."""
    held, size = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        size += batch.num_rows
        if size >= TASK_LINKS:
            held, size = [rooted(*map(np.concatenate, zip(*held, strict=True)))], 0
    return rooted(*map(np.concatenate, zip(*held, strict=True)))


def _links(nodes: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["a", "b"]
    )


def local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One link from each node of a task to the smallest node it is known to reach."""
    nodes, roots = _joined(batches)
    inner = nodes != roots
    yield _links(nodes[inner], roots[inner])


def whole_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node, the roots too, and the smallest node it reaches."""
    yield _links(*_joined(batches))


def _round(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    rest = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node with a link.

    Nodes that no link names are absent.  NULL ends and links of a node to itself
    are ignored.  No links give an empty table.
    """
    edges = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = materialise(edges.mapInArrow(local_forest, "a long, b long"))
    tasks = -(-edges.count() // TASK_LINKS)
    if tasks <= 1:
        whole = materialise(edges.coalesce(1).mapInArrow(whole_forest, "a long, b long"))
        return whole.withColumnsRenamed({"a": "node", "b": "component"})
    edges = edges.coalesce(tasks).mapInArrow(local_forest, "a long, b long")
    edges = materialise(edges.distinct())
    seen = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        state = (state["n"], state["h"])
        if state == seen or state[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = state
        edges = materialise(_round(edges))

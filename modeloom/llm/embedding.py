"""Near-dedup of embeddings by lattice hashing.

In each of several tables a random projection takes unit vectors to eight dimensions,
where they are scaled and decoded to the nearest point of the lattice E8.  A vector is
stored under its own lattice point, and also asks at the next nearest points.  Vectors of
equal label that meet are compared by their exact cosine.  Pairs that meet in several
cells count only in the first, which both vectors' own cells tell, so links are counted
and joined block by block without being listed; each cell hands on one count per vector
and a forest.

Equal vectors of a label are one node that counts as often as it occurs.  A cell of more
than ``CHUNK`` nodes is dealt to chunks, and each pair of chunks is a task of its own.

Defined results: vectors that are NULL, empty, zero, or hold NULL or non-finite numbers,
and vectors without label, link with nothing; so do rows without an id, which no result could
name: each is one row with no links, its component NULL.  Vectors of different lengths do not link.
Equal vectors link (cosine 1).  Rows that repeat an id count as vectors of their own, and
share a component.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.llm.components import components
from modeloom.llm.flow import Packer, bucket_count, bucket_of, stage
from modeloom.llm.text import MULTIPLIER, mix

COSINE = 0.93
TABLES = 16
PROBES = 3
CELL = 0.22
# Vectors compared at once inside a task.
BLOCK = 1024
# Nodes of one cell that go to one task; larger cells are dealt to pairs of such chunks.
CHUNK = 4096
# Sides of an entry: of a task that compares all its nodes, or only across its two chunks.
WITHIN, LOW, HIGH = 0, 1, 2


def decode(points: np.ndarray, most: int) -> np.ndarray:
    """Doubled coordinates of up to ``most`` near points of E8, nearest first.

    E8 is D8 (integers of even sum) and D8 shifted by one half.  In each part the
    candidates differ from plain rounding in the coordinates rounded worst.
    """
    found, cost = [], []
    rows = np.arange(len(points))
    for shift in (0.0, 0.5):
        moved = points - shift
        base = np.round(moved)
        error = moved - base
        step = np.where(error >= 0, 1.0, -1.0)
        worst = np.argsort(-np.abs(error), axis=1, kind="stable")
        odd = base.sum(axis=1) % 2 != 0
        # an odd sum needs one coordinate turned, an even one none or two
        for first, second in ((0, None), (1, None), (2, None)):
            turned = base.copy()
            at = worst[:, first]
            turned[rows[odd], at[odd]] += step[rows[odd], at[odd]]
            even = ~odd
            if first:
                for place in (0, first):
                    where = worst[:, place]
                    turned[rows[even], where[even]] += step[rows[even], where[even]]
            found.append(turned + shift)
            cost.append(((points - turned - shift) ** 2).sum(axis=1))
    order = np.argsort(np.round(np.stack(cost, axis=1), 12), axis=1, kind="stable")[:, :most]
    stacked = np.stack(found, axis=1)
    return np.round(stacked[rows[:, None], order] * 2).astype(np.int64)


class Lattice:
    """Cells of unit vectors in every table."""

    def __init__(self, dimension: int, tables: int = TABLES, probes: int = PROBES):
        random = np.random.default_rng(8 * 240 + dimension)
        self.tables, self.probes = tables, probes
        self.planes = [
            np.linalg.qr(random.standard_normal((max(dimension, 8), 8)))[0][:dimension]
            for _ in range(tables)
        ]
        # the scale of cells follows the length that projection leaves
        self.scale = CELL * np.sqrt(64 / max(dimension, 8))
        self.shifts = random.uniform(0, 1, (tables, 8))

    def cells(self, vectors: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """(vector, table, probe) hashes; the first probe is the vector's own cell."""
        out = np.empty((len(vectors), self.tables, self.probes), np.uint64)
        for table, plane in enumerate(self.planes):
            at = decode(np.round(vectors @ plane, 9) / self.scale + self.shifts[table], self.probes)
            key = np.full(at.shape[:2], table + 1, np.uint64)
            key = key * MULTIPLIER + labels.astype(np.int64).view(np.uint64)[:, None]
            for axis in range(8):
                key = key * MULTIPLIER + at[:, :, axis].view(np.uint64)
            out[:, table, :] = mix(key, 2)
        return out


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors at length 1, without overflow or underflow on the way."""
    wide = vectors.astype(np.float64)
    wide = wide / np.maximum(np.abs(wide).max(axis=1), 1e-300)[:, None]
    return wide / np.linalg.norm(wide, axis=1)[:, None]


def _meets(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether either vector of each pair asks at the other's own cell of a table."""
    return (one == other[:, :1]).any(axis=1) | (other == one[:, :1]).any(axis=1)


def _blocks(side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Blocks of members to compare, and whether both are the same block."""
    low, high = np.flatnonzero(side == LOW), np.flatnonzero(side == HIGH)
    for one in range(0, len(low), BLOCK):
        for other in range(0, len(high), BLOCK):
            yield low[one : one + BLOCK], high[other : other + BLOCK], False
    within = np.flatnonzero(side == WITHIN)
    for one in range(0, len(within), BLOCK):
        for other in range(one, len(within), BLOCK):
            yield within[one : one + BLOCK], within[other : other + BLOCK], one == other


def link_cell(
    own: np.ndarray, side: np.ndarray, times: np.ndarray, vectors: np.ndarray,
    cells: np.ndarray, table: int, cell: np.uint64, least: float,
) -> tuple[np.ndarray, np.ndarray]:
    """For each member of one cell, the rows it links with where no earlier cell holds the
    pair, and the smallest member it is joined to; pairs of one block at a time are held."""
    count, root = np.zeros(len(own), np.int64), np.arange(len(own))
    for a, b, same in _blocks(side):
        close = vectors[a] @ vectors[b].T >= least
        close &= own[a, None] | own[None, b]
        if same:
            close &= np.arange(len(a))[:, None] < np.arange(len(b))[None]
        i, j = np.nonzero(close)
        i, j = a[i], b[j]
        for earlier in range(table):
            if len(i) == 0:
                break
            new = ~_meets(cells[i, earlier], cells[j, earlier])
            i, j = i[new], j[new]
        if len(i) == 0:
            continue
        # within one table a pair may meet in both own cells: the smaller counts
        x, y = cells[i, table], cells[j, table]
        at_x, at_y = (y == x[:, :1]).any(axis=1), (x == y[:, :1]).any(axis=1)
        top = np.uint64(0xFFFFFFFFFFFFFFFF)
        first = np.minimum(np.where(at_x, x[:, 0], top), np.where(at_y, y[:, 0], top)) == cell
        i, j = i[first], j[first]
        np.add.at(count, i, times[j])
        np.add.at(count, j, times[i])
        root = _joined(root, i, j)
    return count, root


def _joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member that each member reaches, with links i - j added."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return root
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def _usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """vec_id, label, values and node (a hash of label and values) of vectors that can link."""
    v = F.col("v")
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        # -0.0 becomes 0.0
        F.transform(F.col(embedding).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("v"),
    ).where("label is not null and vec_id is not null and size(v) > 0")
    huge = F.lit(float("inf"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < huge))
    rows = rows.where(F.coalesce(sound, F.lit(False)) & F.exists(v, lambda x: x != 0.0))
    return rows.withColumn("node", F.xxhash64("label", "v"))


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, places in the batch, unit vectors) of a batch of nodes."""
    lists = batch.column("v")
    sizes = np.array([len(x) for x in lists], np.int64)
    for dimension in np.unique(sizes):
        at = np.flatnonzero(sizes == dimension)
        flat = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield int(dimension), at, unit(flat.reshape(-1, dimension))


def _large(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Cells of more than ``CHUNK`` nodes, sorted, and the chunks each is dealt to.

    They are at most 48 for every ``CHUNK`` nodes, so they fit the driver.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimension, at, values in _by_dimension(batch):
                labels = batch.column("label").to_numpy()[at]
                cells, n = np.unique(Lattice(dimension).cells(values, labels), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells.view(np.int64), pa.int64()), pa.array(n, pa.int64())],
                    names=["cell", "n"],
                )

    sizes = nodes.select("label", "v").mapInArrow(work, "cell long, n long")
    large = sizes.groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > CHUNK).toArrow()
    cells = large.column("cell").to_numpy().view(np.uint64)
    order = np.argsort(cells)
    return cells[order], -(-large.column("n").to_numpy()[order] // CHUNK)


NAMES = ["task", "cell", "table", "own", "side", "node", "rep", "times", "label", "vector"]


def _spread(nodes: DataFrame, buckets: int, large: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Every node once per cell it is stored or asks in, packed by bucket; in a large cell,
    once per pair of chunks that its own chunk is in."""
    hot, chunks = large

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packers: dict[int, Packer] = {}
        for batch in batches:
            for dimension, at, values in _by_dimension(batch):
                labels, node, rep, times = (
                    batch.column(c).to_numpy()[at] for c in ("label", "node", "rep", "times")
                )
                cells = Lattice(dimension).cells(values, labels)
                packer = packers.setdefault(dimension, Packer(NAMES))
                n, tables, probes = cells.shape
                flat = cells.reshape(-1)
                entry = np.arange(len(flat))
                for low in range(0, len(flat), 50_000):
                    e = entry[low : low + 50_000]
                    parts = np.ones(len(e), np.int64)
                    if len(hot):
                        found = np.minimum(np.searchsorted(hot, flat[e]), len(hot) - 1)
                        parts = np.where(hot[found] == flat[e], chunks[found], 1)
                    mine = mix(node[e // (tables * probes)].view(np.uint64), 13)
                    mine = (mine % parts.astype(np.uint64)).astype(np.int64)
                    for other in range(int(parts.max())):
                        take = parts > other
                        x, c = e[take], mine[take]
                        pair = np.minimum(c, other) * parts[take] + np.maximum(c, other)
                        task = mix(flat[x] + pair.astype(np.uint64) * MULTIPLIER, 14)
                        side = np.where(c == other, WITHIN, np.where(c < other, LOW, HIGH))
                        w = x // (tables * probes)
                        packer.add(
                            bucket_of(task, buckets),
                            task,
                            flat[x],
                            (x // probes % tables).astype(np.int16),
                            (x % probes).astype(np.int8),
                            side.astype(np.int8),
                            node[w],
                            rep[w],
                            times[w],
                            labels[w],
                            values[w],
                        )
                        if packer.full():
                            yield from _tag(packer, dimension)
        for dimension, packer in packers.items():
            yield from _tag(packer, dimension)

    return nodes.mapInArrow(work, Packer(NAMES).schema() + ", dimension int")


def _tag(packer: Packer, dimension: int) -> Iterator[pa.RecordBatch]:
    for batch in packer.rows():
        tag = pa.array([dimension] * batch.num_rows, pa.int32())
        yield batch.append_column("dimension", tag)


def _link_bucket(least: float):
    from modeloom.llm.flow import unpack

    def work(table: pa.Table) -> pa.Table:
        dimension = table.column("dimension")[0].as_py()
        task, cell = unpack(table, "task", "<u8"), unpack(table, "cell", "<u8")
        tables, own = unpack(table, "table", "<i2"), unpack(table, "own", "<i1") == 0
        side, node = unpack(table, "side", "<i1"), unpack(table, "node", "<i8")
        rep, times = unpack(table, "rep", "<i8"), unpack(table, "times", "<i8")
        labels = unpack(table, "label", "<i8")
        vectors = unpack(table, "vector", "<f8").reshape(-1, dimension)
        order = np.argsort(task, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(task[order]) != 0])
        found: list[tuple[np.ndarray, ...]] = []
        lattice = Lattice(dimension)
        for start, end in zip(starts, np.r_[starts[1:], len(order)], strict=True):
            members = order[start:end]
            if len(members) < 2 or not own[members].any():
                continue
            close = np.zeros(len(members), bool)
            for a, b, same in _blocks(side[members]):
                hit = vectors[members[a]] @ vectors[members[b]].T >= least
                close[a] |= hit.sum(axis=1) > same
                close[b] |= hit.sum(axis=0) > same
            members = members[close]
            if len(members) < 2:
                continue
            held = vectors[members]
            count, root = link_cell(
                own[members], side[members], times[members], held,
                lattice.cells(held, labels[members]),
                int(tables[members[0]]), cell[members[0]], least,
            )
            at = np.flatnonzero(count)
            found.append((node[members[at]], count[at], rep[members[at]], rep[members[root[at]]]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [np.zeros(0, np.int64)] * 4
        return pa.table(
            {
                name: pa.array(column, pa.int64())
                for name, column in zip(("node", "n", "rep", "root"), columns, strict=True)
            }
        )

    return work


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    least: float = COSINE,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``."""
    usable = _usable(vectors, vec_id, embedding, label)
    # one node for equal vectors, named for components by its smallest id
    nodes = stage(
        usable.groupBy("node").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("times"),
            F.first("label").alias("label"), F.first("v").alias("v"),
        ),
        "vectors",
    )
    buckets = bucket_count(vectors.sparkSession)
    # cosines are taken of unit vectors, so a hair is allowed for rounding
    found = stage(
        _spread(nodes, buckets, _large(nodes))
        .groupBy("bucket", "dimension")
        .applyInArrow(_link_bucket(least - 1e-12), "node long, n long, rep long, root long"),
        "links",
    )
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    linked = nodes.select("node", "rep", "times").join(counts, "node", "left").select(
        "node", "rep", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n")
    ).where("n > 0")
    linked = stage(usable.select("vec_id", "node").join(linked, "node"), "linked")
    counts = linked.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    links = linked.select("vec_id", "rep").union(found.select("rep", "root"))
    parts = components(links, "vec_id", "rep").withColumnRenamed("node", "vec_id")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"))
    joined = rows.join(counts, "vec_id", "left").join(parts, "vec_id", "left")
    root = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        root.alias("component_id"),
        F.coalesce(F.col("vec_id") == root, F.lit(True)).alias("kept"),
    )

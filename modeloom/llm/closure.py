"""From signatures to connected components, shared by the set-similarity operators.

Nodes that share a signature form a group.  Every member is first compared with the
group's smallest node.  Groups that the links found so far leave in several components
are then looked into by their own tasks, with sketches in place of sets: two sketches
differ in no more places than the sets do in elements, so a pair whose sketches differ too
much cannot link.  A sketch has at least as many bits as its set has elements, so it tells
large sets apart as well as small ones.  Of the pairs that may link, a task proposes at
first one or so for each of its components, these are compared by their whole sets, and the
groups are looked into again for pairs not yet compared, ``GROWTH`` times as many in each
round, until nothing is left to propose; a task that left no pair for later is done.  Pairs
already connected are never proposed, so a group of copies costs one comparison each, groups of documents that merely share a passage
propose nothing, and no link that joins components is missed.

Groups of more than ``CHUNK`` nodes, or of large sketches, are dealt to chunks, and each
pair of chunks is a task of its own; so a task holds a bounded number of nodes and pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.llm.components import components
from modeloom.llm.flow import stage
from modeloom.llm.text import mix, ragged

FOUND = "kind byte, a long, b long"
# Growth of the pairs proposed for each component from one round to the next.
GROWTH = 64
# Nodes, and elements of their sets, of one group that go to one chunk.
CHUNK = 1024
CHUNK_ELEMENTS = 1 << 26
# Members compared at once inside a task.
BLOCK = 512
# A task is known by its group and two chunks.
TASK = ["g", "low", "high"]
# Rows of tasks worked on together, and the members of tasks whose pairs are looked at together.
ROWS = 4096
SMALL = 64
# Classes of sketches made at once.
PLACES = 1 << 19
# Bytes of sketches compared at once.
PAIR_BYTES = 4 << 20

Bodies = Callable[[DataFrame], DataFrame]
# Whether each of the first bodies reaches the similarity with that of the second at its place.
Similar = Callable[[pa.Array, pa.Array], list[bool]]


def sketches(values: np.ndarray, offsets: np.ndarray, bits: int) -> pa.Array:
    """Per set, whether each of its hash classes holds an odd number of its elements.

    A set has ``bits`` classes (a power of two), doubled until there is one for every element.
    Folding the halves of a sketch together gives the sketch of half as many classes.
    """
    sizes = np.diff(offsets)
    wide = np.full(len(sizes), bits, np.int64)
    while (wide < sizes).any():
        wide = np.where(wide < sizes, wide * 2, wide)
    ends = np.r_[0, np.cumsum(wide)]
    # sets one after the other, about PLACES classes at a time
    part = ends[:-1] // PLACES
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(sizes) else [0]
    rows = []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        inside = mix(values[offsets[low] : offsets[high]], 9)
        inside &= np.repeat((wide[low:high] - 1).astype(np.uint64), sizes[low:high])
        place = np.repeat(ends[low:high] - ends[low], sizes[low:high]) + inside.astype(np.int64)
        count = np.bincount(place, minlength=int(ends[high] - ends[low]))
        rows.append(np.packbits((count & 1).astype(np.uint8)))
    data = np.concatenate([np.zeros(0, np.uint8), *rows])
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer((ends // 8).astype(np.int32)), pa.py_buffer(data)]
    )


def _lengths(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Bytes of each sketch."""
    return pc.binary_length(column).to_numpy().astype(np.int64)


def _words(column: pa.Array, at: np.ndarray, size: int) -> np.ndarray:
    """Some sketches as rows of 64-bit words, folded to ``size`` bytes."""
    out = np.zeros((len(at), size // 8), np.uint64)
    if len(at) == 0:
        return out
    _, ends, data = column.buffers()
    starts = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    raw, lengths = np.frombuffer(data or b"", np.uint8), np.diff(starts)[at]
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        whole = raw[starts[at[rows], None].astype(np.int64) + np.arange(length)].view(np.uint64)
        out[rows] = np.bitwise_xor.reduce(whole.reshape(len(rows), -1, size // 8), axis=1)
    return out


def _may_link(apart: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether sets of n and m elements whose sketches are so far apart can reach 0.8."""
    return (apart * 9 <= n + m) & (5 * n >= 4 * m) & (5 * m >= 4 * n)


def groups_of(node: np.ndarray, sign: np.ndarray) -> pa.Table:
    """Candidate pairs (kind 0) and groups of three and more nodes (kind 1) of one bucket."""
    if len(node) == 0:
        return pa.table(
            {"kind": pa.array([], pa.int8()), "a": pa.array([], pa.int64()),
             "b": pa.array([], pa.int64())}
        )
    order = np.lexsort((node, sign))
    sign, node = sign[order], node[order]
    new = np.r_[True, (sign[1:] != sign[:-1]) | (node[1:] != node[:-1])]
    sign, node = sign[new], node[new]
    starts = np.flatnonzero(np.r_[True, sign[1:] != sign[:-1]])
    sizes = np.diff(np.r_[starts, len(sign)])
    many = np.repeat(sizes > 1, sizes)
    first = np.repeat(node[starts], sizes)
    other = many & (node != first)
    pairs = np.unique(np.stack([first[other], node[other]], axis=1), axis=0)
    name = np.add.reduceat(mix(node, 11), starts) + sizes.astype(np.uint64)
    _, chosen = np.unique(name, return_index=True)
    chosen = chosen[sizes[chosen] > 2]
    members = np.concatenate(
        [np.arange(starts[g], starts[g] + sizes[g]) for g in chosen] or [np.zeros(0, np.int64)]
    )
    kind = np.r_[np.zeros(len(pairs), np.int8), np.ones(len(members), np.int8)]
    left = np.r_[pairs[:, 0], np.repeat(name[chosen], sizes[chosen])]
    right = np.r_[pairs[:, 1], node[members]]
    return pa.table(
        {
            "kind": pa.array(kind, pa.int8()),
            "a": pa.array(left.view(np.int64), pa.int64()),
            "b": pa.array(right.view(np.int64), pa.int64()),
        }
    )


def candidates(found: DataFrame) -> DataFrame:
    """(node): every node that shares a signature with another."""
    pairs = found.where("kind = 0")
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def near_pairs(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs whose sketches let them link."""

    def side(name: str) -> DataFrame:
        return known.select(
            F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("sketch").alias(f"s{name}")
        ).hint("shuffle_hash")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            one, other = batch.column("sa"), batch.column("sb")
            apart = np.zeros(batch.num_rows, np.int64)
            sizes = np.minimum(_lengths(one), _lengths(other))
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                differ = np.bitwise_count(_words(one, at, size) ^ _words(other, at, size))
                apart[at] = differ.sum(axis=1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(_may_link(apart, n, m), pa.bool_()))

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(near, "a long, b long")


def verified(pairs: DataFrame, bodies: DataFrame, similar: Similar) -> DataFrame:
    """The pairs whose whole sets reach the similarity."""
    whole = pairs.join(
        bodies.select(F.col("node").alias("b"), F.col("body").alias("other")), "b"
    ).join(bodies.select(F.col("node").alias("a"), F.col("body").alias("one")), "a")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = similar(batch.column("one"), batch.column("other"))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return whole.select("a", "b", "one", "other").mapInArrow(linked, "a long, b long")


def similar_sets(ones: pa.Array, others: pa.Array) -> list[bool]:
    """Whether two sorted sets of 64-bit hashes reach Jaccard 0.8, for each two."""
    return [_similar(one, other) for one, other in zip(ones, others, strict=True)]


def _similar(one: pa.Scalar, other: pa.Scalar) -> bool:
    x = np.frombuffer(one.as_buffer(), "<u8")
    y = np.frombuffer(other.as_buffer(), "<u8")
    if len(x) == 0 or len(y) == 0:
        return False
    at = np.minimum(np.searchsorted(x, y), len(x) - 1)
    common = int((x[at] == y).sum())
    return 100 * common >= 80 * (len(x) + len(y) - common)


def _near_blocks(
    table: pa.Table, component: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a task that lie in different components and may link, block by block.

    Members of side 0 are compared with each other, those of side 1 with those of side 2.
    """
    n, side = table.column("n").to_numpy(), table.column("side").to_numpy()
    sketch = table.column("sketch").combine_chunks()
    sizes = _lengths(sketch)
    for size in np.unique(sizes).tolist():
        # sets that may link differ by a factor 5/4 at most, their sketches by a factor 2
        same, twice = np.flatnonzero(sizes == size), np.flatnonzero(sizes == 2 * size)
        for wide, once in ((same, True), (twice, False)):
            for x, y in ((0, 0), (1, 2)) if once else ((0, 0), (1, 2), (2, 1)):
                ones, others = same[side[same] == x], wide[side[wide] == y]
                for low in range(0, len(ones), BLOCK):
                    a = ones[low : low + BLOCK]
                    words = _words(sketch, a, size)
                    halves = once and x == 0
                    for next_low in range(low if halves else 0, len(others), BLOCK):
                        b = others[next_low : next_low + BLOCK]
                        more = _words(sketch, b, size)
                        apart = np.zeros((len(a), len(b)), np.int64)
                        for word in range(words.shape[1]):
                            apart += np.bitwise_count(words[:, word, None] ^ more[None, :, word])
                        fit = _may_link(apart, n[a, None], n[None, b])
                        fit &= component[a, None] != component[None, b]
                        i, j = np.nonzero(fit)
                        if halves and low == next_low:
                            i, j = i[i < j], j[i < j]
                        yield a[i], b[j]


def whole_tasks(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.Table]:
    """About ``rows`` rows of whole tasks at a time, from rows sorted by task."""
    held, size, least = [], 0, rows
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = int(np.flatnonzero(_begins(table))[-1])
        if last:
            yield table.slice(0, last)
        held, size = table.slice(last).to_batches(), table.num_rows - last
        least = max(rows, 2 * size)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _begins(table: pa.Table) -> np.ndarray:
    """Whether a row is the first of its task."""
    begins = np.ones(table.num_rows, bool)
    keys = [table.column(c).to_numpy() for c in TASK]
    begins[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return begins


def _near(
    table: pa.Table, task: np.ndarray, component: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows as of :func:`_near_blocks`, from several tasks one after the other.

    The pairs of all small tasks are looked at together.
    """
    starts = np.flatnonzero(np.r_[True, task[1:] != task[:-1]]) if len(task) else task
    sizes = np.diff(np.r_[starts, len(task)])
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        part = table.slice(start, size)
        for i, j in _near_blocks(part, component[start : start + size]):
            yield i + start, j + start
    n, side = table.column("n").to_numpy(), table.column("side").to_numpy()
    ends = np.repeat(starts + sizes, sizes)
    rows = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    after = ends[rows] - rows - 1
    i, j = np.repeat(rows, after), ragged(rows + 1, after)
    # members of side 0 with each other, those of side 1 with those of side 2
    fit = (side[i] + side[j] == 3) | ((side[i] == 0) & (side[j] == 0))
    fit &= (side[i] != side[j]) | (side[i] == 0)
    fit &= (component[i] != component[j]) & _may_link(0, n[i], n[j])
    i, j = i[fit], j[fit]
    sketch = table.column("sketch").combine_chunks()
    wide = _lengths(sketch)
    least = np.minimum(wide[i], wide[j])
    for size in np.unique(least).tolist():
        x, y = i[least == size], j[least == size]
        taken, at = np.unique(np.r_[x, y], return_inverse=True)
        words, left, right = _words(sketch, taken, size), at[: len(x)], at[len(x) :]
        step = max(1, PAIR_BYTES // size)
        for low in range(0, len(x), step):
            a, b = x[low : low + step], y[low : low + step]
            differ = words[left[low : low + step]] ^ words[right[low : low + step]]
            differ = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
            near = _may_link(differ, n[a], n[b])
            yield a[near], b[near]


def _active(table: pa.Table, task: np.ndarray | None = None) -> pa.Table:
    """(node): members that may link with another member of their task."""
    node = table.column("node").to_numpy()
    hit = np.zeros(len(node), bool)
    tasks = np.zeros(len(node), np.int64) if task is None else task
    for i, j in _near(table, tasks, np.arange(len(node))):
        hit[i] = hit[j] = True
    return pa.table({"node": pa.array(node[hit], pa.int64())})


def _actives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_tasks(batches):
        yield from _active(table, np.cumsum(_begins(table))).to_batches()


def _proposed(table: pa.Table, most: int) -> pa.RecordBatch:
    """Pairs of several tasks not asked before; one is left for later only if both its
    components have ``most`` pairs in this round.  Rows of side -1 are the pairs asked.

    ``more`` tells whether the task has left a pair for later.
    """
    task = np.cumsum(_begins(table))
    old = table.column("side").to_numpy() < 0
    ends = [table.column(c).to_numpy()[old] for c in ("node", "component")]
    table, asked, task = table.filter(pa.array(~old)).combine_chunks(), task[old], task[~old]
    node = table.column("node").to_numpy()
    names, code = np.unique(node, return_inverse=True)
    before = np.zeros(0, np.int64)
    if len(asked) and len(node):
        # all asked pairs are of these tasks, and their nodes are still here or connected
        key = task * len(names) + code
        order = np.argsort(key)
        rows, here = [], np.ones(len(asked), bool)
        for end in ends:
            at = np.minimum(np.searchsorted(names, end), len(names) - 1)
            wanted = asked * len(names) + at
            row = order[np.minimum(np.searchsorted(key, wanted, sorter=order), len(key) - 1)]
            here &= (names[at] == end) & (key[row] == wanted)
            rows.append(row)
        x, y = (row[here] for row in rows)
        before = np.minimum(x, y) * len(node) + np.maximum(x, y)
    _, component = np.unique(table.column("component").to_numpy(), return_inverse=True)
    # a component counts for itself in every task
    _, component = np.unique(task * (len(node) + 1) + component, return_inverse=True)
    taken = np.zeros(len(node), np.int64)
    later = np.zeros(int(task[-1]) + 1 if len(task) else 1, bool)
    out_a, out_b = [], []
    for i, j in _near(table, task, component):
        fresh = ~np.isin(np.minimum(i, j) * len(node) + np.maximum(i, j), before)
        i, j = i[fresh], j[fresh]
        for p, q, x, y in zip(
            i.tolist(), j.tolist(), component[i].tolist(), component[j].tolist(), strict=True
        ):
            if taken[x] < most or taken[y] < most:
                taken[x] += 1
                taken[y] += 1
                out_a.append(p)
                out_b.append(q)
            else:
                later[task[p]] = True
    out = np.array(out_a, np.int64)
    a, b = node[out], node[np.array(out_b, np.int64)]
    same = [pa.array(table.column(c).to_numpy()[out], pa.int64()) for c in TASK]
    pair = [pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())]
    more = pa.array(later[task[out]], pa.bool_())
    return pa.RecordBatch.from_arrays([*same, *pair, more], names=[*TASK, "a", "b", "more"])


PROPOSED = "g long, low long, high long, a long, b long, more boolean"


def _propose(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_tasks(batches):
            yield _proposed(table, most)

    return work


def _by_task(
    members: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Run ``work`` on the members of whole tasks, several tasks in a row."""
    return members.repartition(*TASK).sortWithinPartitions(*TASK).mapInArrow(work, schema)


def _chunks(members: DataFrame, known: DataFrame) -> DataFrame:
    """``members`` (g, node) with the number of chunks of their group."""
    sizes = members.join(known.select("node", "n"), "node").groupBy("g").agg(
        F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("n") / CHUNK_ELEMENTS)).alias("chunks")
    )
    # at most one for every CHUNK members
    large = F.broadcast(sizes.where("chunks > 1"))
    return members.join(large, "g", "left").withColumn(
        "chunks", F.coalesce("chunks", F.lit(1)).cast("long")
    )


def _dealt(members: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """Every member once for each task, a pair of chunks that its chunk is in; and its side.

    ``tasks``, if given, are the only ones that get any.
    """
    mine = F.pmod(F.xxhash64("node"), F.col("chunks"))
    dealt = members.withColumn("mine", mine)
    if tasks is None:
        dealt = dealt.withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
        )
    else:
        ends = tasks.select("g", F.col("low").alias("mine"), F.col("high").alias("other"))
        ends = ends.union(ends.where("mine <> other").select("g", "other", "mine"))
        dealt = dealt.join(ends, ["g", "mine"])
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1)
    return (
        dealt.withColumn("low", F.least("mine", "other"))
        .withColumn("high", F.greatest("mine", "other"))
        .withColumn("side", side.otherwise(2))
        .drop("mine", "other", "chunks")
    )


def closed_components(
    found: DataFrame, known: DataFrame, bodies: Bodies, similar: Similar
) -> DataFrame:
    """(node, component) under all links among nodes that share a signature.

    ``found`` holds pairs and groups, ``known`` (node, n, sketch) of every candidate, and
    ``bodies`` gives (node, body) for a table of nodes.
    """
    pairs = stage(near_pairs(found.where("kind = 0").select("a", "b").distinct(), known), "near")
    members = found.where("kind = 1").select(F.col("a").alias("g"), F.col("b").alias("node"))
    members = stage(members.distinct(), "distinct")
    dealt = _dealt(_chunks(members, known)).join(known, "node")
    active = _by_task(dealt.select(*TASK, "node", "n", "side", "sketch"), _actives, "node long")
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(active).distinct()
    # only nodes that may link are ever compared by their whole sets
    ends = stage(ends, "ends")
    whole = stage(bodies(ends), "bodies")
    links = stage(verified(pairs, whole, similar), "links")
    members = _chunks(members.join(ends, "node", "left_semi"), known)
    members = stage(members.join(known, "node"), "members")
    columns = [*TASK, "node", "n", "side", "sketch", "component"]
    asked = later = None
    most = 1
    while True:
        parts = components(links)
        placed = members.join(parts, "node", "left").withColumn(
            "component", F.coalesce("component", "node")
        )
        several = placed.groupBy("g").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        ).where("low <> high").select("g")
        placed = _dealt(placed.join(several, "g", "left_semi"), later).select(*columns)
        if later is not None:
            placed = placed.union(
                asked.select(
                    *TASK, F.col("a").alias("node"), F.lit(0).cast("long").alias("n"),
                    F.lit(-1).alias("side"), F.lit(None).cast("binary").alias("sketch"),
                    F.col("b").alias("component"),
                )
            )
        fresh = stage(_by_task(placed, _propose(most), PROPOSED), "proposed")
        if fresh.isEmpty():
            return parts
        more = verified(fresh.select("a", "b").distinct(), whole, similar)
        links = links.union(stage(more, "links"))
        # the others have no pair left that was not asked
        later = stage(fresh.where("more").select(*TASK).distinct(), "later")
        if later.isEmpty():
            return components(links)
        fresh = fresh.drop("more")
        asked = fresh if asked is None else asked.union(fresh)
        asked = asked.join(later, TASK, "left_semi").select(*TASK, "a", "b")
        members = stage(members.join(later.select("g").distinct(), "g", "left_semi"), "members")
        most *= GROWTH

"""N-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct five-word shingles.  Sets whose Jaccard similarity
reaches 0.8 differ in at most a ninth of the sum of their sizes.  Sizes are cut into bands
whose ends are a factor 5/4 apart, so that such sets lie in one band or in neighbours; a set
is signed for its own band and for the next.  For a band in which sets may differ in ``k``
elements, the features are dealt to ``k // 2 + 1`` first-level partitions (and a few more);
then at least one partition has at most one difference.  Each partition is dealt to three
cells, and the three pairs of cells are the enumerated subsets: one difference leaves one
pair of cells untouched, and its content is the shared signature.

A pair of cells may be empty, and empty signatures would join everything.  The extra
partitions make up for them: only if a set has more partitions with an empty subset than
there are extra ones is it signed again under another seed (and finally with its empty
subsets), so no pair is lost.

Equal sets form one node, so copies meet once; how groups become links and components is
told in ``closure``.

Defined results: a text with one to four words has its whole word sequence as its only
shingle.  NULL, empty and blank texts have no shingles and are their own components.
Shingles are compared by 64-bit hashes.  Rows that repeat an id are documents of their
own.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.llm.closure import (
    FOUND,
    candidates,
    closed_components,
    groups_of,
    similar_sets,
    sketches,
)
from modeloom.llm.flow import Packer, bucket_of, buckets_for, by_bucket, lean, stage, unpack
from modeloom.llm.text import (
    MULTIPLIER,
    distinct_per_owner,
    lower,
    mix,
    owners,
    rolled_words,
    slices,
    sums_per_owner,
    texts_of,
    windows,
)

WIDTH = 5
CELLS = 3
# Seeds tried for sets with too many empty subsets before these are signed as well.
SEEDS = 6
SKETCH_BITS = 512
# Bytes of signatures that a task gathers before it sends them on.
PACKED = 16 << 20


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text lower-cased in A-Z, and offsets."""
    hashes, offsets = rolled_words(lower(texts))
    found, ends = windows(hashes, offsets, width)
    owner = owners(ends)
    counts = np.diff(offsets)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for at, doc in enumerate(short):
            value = int(counts[doc])
            for word in hashes[offsets[doc] : offsets[doc + 1]].tolist():
                value = (value * int(MULTIPLIER) + word) & 0xFFFFFFFFFFFFFFFF
            whole[at] = value
        owner = np.r_[owner, short]
        found = np.r_[found, mix(whole, 5)]
    owner, found = distinct_per_owner(owner, found)
    sizes = np.bincount(owner, minlength=len(texts))
    return found, np.r_[0, np.cumsum(sizes)]


def nodes_of(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One hash per set; equal sets share it."""
    sums = sums_per_owner(offsets, mix(values, 7))
    return mix(sums + np.diff(offsets).astype(np.uint64) * MULTIPLIER, 8)


def band_ends(most: int) -> np.ndarray:
    """Largest set size of each band, up to the band of ``most`` and the one after it."""
    ends, low = [], 1
    while not ends or ends[-2:][0] < most:
        ends.append(low * 5 // 4)
        low = ends[-1] + 1
    return np.array([*ends, low * 5 // 4], np.int64)


def signatures(
    values: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of the set) of all sets, without those of sets that cannot link."""
    sizes = np.diff(offsets)
    if len(values) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = band_ends(int(sizes.max()))
    own_band = np.searchsorted(ends, sizes)
    features = mix(values, 3)
    signs, sets = [], []
    for later in (0, 1):
        band = own_band + later
        differing = 2 * ends[band] // 9
        base = differing // 2 + 1
        spare = base // 16
        # no difference allowed: such sets are equal, and equal sets are one node already
        active = np.flatnonzero((differing > 0) & (sizes > 0))
        for seed in range(SEEDS):
            if len(active) == 0:
                break
            parts = (base + spare)[active]
            first = np.r_[0, np.cumsum(parts)]
            at = np.repeat(np.arange(len(active)), sizes[active])
            element = np.repeat(offsets[:-1][active], sizes[active]) + (
                np.arange(len(at)) - np.repeat(np.cumsum(sizes[active]) - sizes[active], sizes[active])
            )
            dealt = mix(values[element], 100 + seed)
            part = ((dealt >> np.uint64(32)) % parts[at].astype(np.uint64)).astype(np.int64)
            cell = ((dealt & np.uint64(0xFFFFFFFF)) % np.uint64(CELLS)).astype(np.int64)
            place = (first[at] + part) * CELLS + cell
            total = np.zeros(first[-1] * CELLS, np.uint64)
            np.add.at(total, place, features[element])
            filled = np.bincount(place, minlength=len(total)).reshape(-1, CELLS)
            total = total.reshape(-1, CELLS)
            rest = total.sum(axis=1, dtype=np.uint64)[:, None] - total
            left = filled.sum(axis=1)[:, None] - filled
            weak = np.add.reduceat((left == 0).any(axis=1), first[:-1])
            sparse = weak > spare[active]
            last = seed == SEEDS - 1
            which = np.repeat(np.arange(len(active)), parts)
            number = np.arange(first[-1]) - first[which]
            tag = (band[active][which].astype(np.uint64) << np.uint64(40)) + (
                number.astype(np.uint64) << np.uint64(8)
            )
            sign = rest * MULTIPLIER + tag[:, None] + np.uint64(seed << 4) + np.arange(
                CELLS, dtype=np.uint64
            )
            emit = (left > 0) | (sparse[which] & last)[:, None]
            signs.append(mix(sign[emit], 4))
            sets.append(np.repeat(active[which], CELLS).reshape(-1, CELLS)[emit])
            active = active[sparse]
    # a batch may hold no words at all
    signs, sets = [np.zeros(0, np.uint64), *signs], [np.zeros(0, np.int64), *sets]
    return np.concatenate(signs), np.concatenate(sets)


def _marks(docs: DataFrame, width: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, offsets = shingle_sets(texts_of(part.column("text")), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("body"),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.array(nodes_of(values, offsets).view(np.int64), pa.int64()),
                        sketches(values, offsets, SKETCH_BITS),
                    ],
                    names=["doc_id", "body", "n_shingles", "node", "sketch"],
                )

    return docs.mapInArrow(
        lean(work), "doc_id long, body long, n_shingles long, node long, sketch binary"
    )


SIGNED = (["node", "low", "high"], ("node",))


def _signed(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """Signatures packed by bucket: the node, and 48 bits besides the bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(*SIGNED, limit=PACKED)
        for batch in batches:
            for part in slices(batch, "text"):
                values, offsets = shingle_sets(texts_of(part.column("text")), width)
                sign, at = signatures(values, offsets)
                order = np.argsort(at, kind="stable")
                sign, at = sign[order], at[order]
                packer.add(
                    bucket_of(sign, buckets),
                    nodes_of(values, offsets)[at],
                    (sign & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                    (sign >> np.uint64(32)).astype(np.uint16),
                )
                if packer.full():
                    yield from packer.rows()
        yield from packer.rows()

    return docs.select("text").mapInArrow(lean(work), Packer(*SIGNED).schema())


def _groups(table: pa.Table) -> pa.Table:
    sign = unpack(table, "low", "<u4") + (
        unpack(table, "high", "<u2").astype(np.uint64) << np.uint64(32)
    )
    return groups_of(unpack(table, "node", "<u8"), sign)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """node and the sorted set of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, offsets = shingle_sets(texts_of(part.column("text")), width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes_of(values, offsets).view(np.int64), pa.int64()),
                        pa.array(
                            [
                                values[s:e].tobytes()
                                for s, e in zip(offsets[:-1], offsets[1:], strict=True)
                            ],
                            pa.binary(),
                        ),
                    ],
                    names=["node", "body"],
                )

    return docs.select("text").mapInArrow(lean(work), "node long, body binary")


def ngram_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH
) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every row.

    A NULL id is never the smallest; documents that only rows without an id join are joined.
    """
    rows = shingled_components(docs, doc_id, text, width)
    return rows.select("doc_id", "n_shingles", "component_id")


def shingled_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH
) -> DataFrame:
    """:func:`ngram_components` with ``body``, a hash of the text, and ``component``, which tells
    components apart that share a smallest id; it is NULL for rows that link with nothing."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
        F.xxhash64(F.col(text)).alias("body"),
    )
    marks = stage(_marks(rows, width), "marks")
    buckets = buckets_for(rows)
    found = stage(
        by_bucket(_signed(rows, width, buckets), _groups, FOUND), "groups"
    )
    known = stage(
        marks.select("node", F.col("n_shingles").alias("n"), "sketch")
        .join(candidates(found), "node", "left_semi").dropDuplicates(["node"]),
        "known",
    )

    def bodies(nodes: DataFrame) -> DataFrame:
        # one carrier for each node; only these texts are read into sets
        carrier = marks.join(nodes, "node", "left_semi").groupBy("node").agg(
            F.min("body").alias("body")
        )
        texts = rows.join(carrier.select("body").distinct(), "body", "left_semi")
        sets = _sets(texts, width).join(nodes, "node", "left_semi")
        return sets.dropDuplicates(["node"])

    parts = closed_components(found, known, bodies, similar_sets)
    joined = marks.join(parts, "node", "left").withColumn(
        "component", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node"))
    )
    lowest = joined.where("component is not null").groupBy("component").agg(
        F.min("doc_id").alias("low"), F.count("*").alias("n")
    ).where("n > 1").select("component", "low")
    return joined.join(lowest, "component", "left").select(
        "doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id"), "body", "component"
    )

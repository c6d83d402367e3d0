"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Components become whole numbers, ``floor(64 * x)``.  Every task turns a block of vectors into
postings: for each component the vectors in which it is not zero, with their weights.  A query
is a sparse row; each of its weights scatters a posting list, multiplied by it, into the
query's dense score array over the block.  No vector is skipped and nothing is estimated.  The
best of a block are found by partial selection and merged into the best so far of that query;
Spark merges the lists of all tasks.

Queries are a stated set of rows and may be many: they visit the stored vectors in chunks of
``CHUNK`` queries, one job a chunk, so that what a task holds is bounded.  Every chunk's result
is written before the next begins.

Defined results: vectors that are NULL or hold a NULL, NaN or infinite component take no part,
neither do vectors whose products may leave 64 bits (size times the square of the largest
weight reaches 2**62).  An empty vector takes part and scores 0; of vectors that differ in
length the missing components count as 0.  Rows that share an id are rows of their own: each is
a query, and only the query's own row is left out of its candidates.  A NULL id is never a
query; as a candidate it comes after all ids among equal scores.  An empty table gives an empty
table.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modeloom.llm.flow import running_total, stage
from modeloom.plans.staging import staging_path

TOP = 20
SCALE = 64.0
# Every row whose id this divides is a query.
EACH = 20
# Queries that visit the stored vectors in one job.
CHUNK = 16384
# A posting list that holds this share of a block is kept as a plain column.
FULL = 0.5
NO_ID = np.iinfo(np.int64).max
RESULT = "query long, query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(row, vec_id, weights) of every vector that takes part; ``row`` tells rows apart."""
    values = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("v"),
    )
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    weights = F.transform("v", lambda x: F.floor(F.lit(SCALE) * x))
    largest = F.coalesce(
        F.array_max(F.transform("v", lambda x: F.abs(F.floor(F.lit(SCALE) * x).cast("double")))),
        F.lit(0.0),
    )
    fits = largest * largest * F.size("v") < float(2**62)
    return values.where(F.col("v").isNotNull() & sound & fits).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", weights.alias("weights")
    )


def ragged_weights(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All weights of a list column, and the offsets of its rows."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False).astype(np.int64), offsets


class Block:
    """Postings of a block of vectors, in the order of their ids (NULL last)."""

    def __init__(self, rows: np.ndarray, ids: pa.Array, weights: pa.Array):
        empty = ids.is_null().to_numpy(zero_copy_only=False)
        numbers = ids.fill_null(NO_ID).to_numpy()
        order = np.lexsort((rows, numbers, empty))
        flat, offsets = ragged_weights(weights)
        place = np.empty(len(rows), np.int64)
        place[order] = np.arange(len(rows))
        sizes = np.diff(offsets)
        owner = np.repeat(place, sizes)
        component = np.arange(len(flat)) - np.repeat(offsets[:-1], sizes)
        self.size, self.ids, self.empty = len(rows), numbers[order], empty[order]
        self.rows = rows[order]
        self.by_row = np.argsort(self.rows)
        self.largest = int(np.abs(flat).max(initial=0))
        self.longest = int(sizes.max(initial=0))
        # narrow sums where no product of this block can leave them
        self.columns: dict[int, tuple[np.ndarray | None, np.ndarray]] = {}
        real = np.flatnonzero(flat)
        real = real[np.argsort(component[real], kind="stable")]
        held = component[real]
        starts = np.flatnonzero(np.r_[True, held[1:] != held[:-1]]) if len(held) else []
        for start, end in zip(starts, [*starts[1:], len(held)], strict=True):
            at = real[start:end]
            where, value = owner[at], flat[at]
            if len(at) >= FULL * self.size:
                dense = np.zeros(self.size, np.int64)
                dense[where] = value
                where, value = None, dense
            self.columns[int(held[start])] = (where, value)
        self.narrow: dict | None = None

    def postings(self, narrow: bool) -> dict:
        if not narrow:
            return self.columns
        if self.narrow is None:
            self.narrow = {c: (w, v.astype(np.int32)) for c, (w, v) in self.columns.items()}
        return self.narrow

    def scores(self, components: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Inner products of one sparse query row with every vector of the block."""
        largest = int(np.abs(weights).max(initial=0))
        narrow = self.largest * largest * max(1, self.longest) < 2**31 - 1
        kind = np.int32 if narrow else np.int64
        postings = self.postings(narrow)
        out = np.zeros(self.size, kind)
        scaled = np.empty(self.size, kind)
        for component, weight in zip(components.tolist(), weights.tolist(), strict=True):
            found = postings.get(component)
            if found is None:
                continue
            where, value = found
            if where is None:
                np.multiply(value, kind(weight), out=scaled)
                out += scaled
            else:
                out[where] += value * kind(weight)
        return out

    def place_of(self, row: int) -> int:
        """Where the row stands in the block, or -1."""
        at = np.searchsorted(self.rows, row, sorter=self.by_row)
        if at < self.size and self.rows[self.by_row[at]] == row:
            return int(self.by_row[at])
        return -1


def selected(scores: np.ndarray, own: int, top: int, floor: int | None) -> np.ndarray:
    """Places of the ``top`` highest scores, the earlier place first among equals; only those
    that reach ``floor``."""
    places = np.arange(len(scores)) if floor is None else np.flatnonzero(scores >= floor)
    if own >= 0:
        places = places[places != own]
    if len(places) <= top:
        return places
    among = scores[places]
    cut = np.partition(among, len(among) - top)[len(among) - top]
    above = places[among > cut]
    return np.r_[above, places[among == cut][: top - len(above)]]


class Best:
    """The best candidates so far of one query."""

    __slots__ = ("scores", "ids", "empty")

    def __init__(self):
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.empty = np.zeros(0, bool)

    def floor(self, top: int) -> int | None:
        return int(self.scores[-1]) if len(self.scores) == top else None

    def merge(self, scores, ids, empty, top: int) -> None:
        if not len(scores):
            return
        scores = np.r_[self.scores, scores.astype(np.int64)]
        ids, empty = np.r_[self.ids, ids], np.r_[self.empty, empty]
        order = np.lexsort((ids, empty, -scores))[:top]
        self.scores, self.ids, self.empty = scores[order], ids[order], empty[order]


def search_chunk(stored: DataFrame, asked: list[tuple[int, int, bytes]], top: int) -> DataFrame:
    """The best ``top`` of every task for each query (row, id, weights as 64-bit numbers)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best() for _ in asked]
        queries = []
        for row, _, data in asked:
            weights = np.frombuffer(data, "<i8")
            components = np.flatnonzero(weights)
            queries.append((row, components, weights[components]))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            block = Block(batch.column(0).to_numpy(), batch.column(1), batch.column(2))
            for (row, components, weights), found in zip(queries, best, strict=True):
                scores = block.scores(components, weights)
                places = selected(scores, block.place_of(row), top, found.floor(top))
                found.merge(scores[places], block.ids[places], block.empty[places], top)
        for low in range(0, len(asked), 1024):
            part = range(low, min(low + 1024, len(asked)))
            sizes = [len(best[i].scores) for i in part]
            if not sum(sizes):
                continue
            scores = np.concatenate([best[i].scores for i in part])
            ids = np.concatenate([best[i].ids for i in part])
            empty = np.concatenate([best[i].empty for i in part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([asked[i][0] for i in part], sizes), pa.int64()),
                    pa.array(np.repeat([asked[i][1] for i in part], sizes), pa.int64()),
                    pa.array(ids, pa.int64(), mask=empty),
                    pa.array(scores, pa.int64()),
                ],
                names=["query", "query_id", "vec_id", "score"],
            )

    return stored.mapInArrow(work, RESULT)


def top_products(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    each: int = EACH,
    top: int = TOP,
    chunk: int = CHUNK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` highest products of every row whose id
    ``each`` divides, with all other rows."""
    spark = vectors.sparkSession
    stored = stage(whole_vectors(vectors, vec_id, embedding), "vectors")
    asked = stored.where(F.col("vec_id") % each == 0).select("row", "vec_id", "weights")
    asked, total = running_total(asked.withColumn("one", F.lit(1)), ["row"], "one")
    asked = stage(asked.drop("one"), "queries")
    path = staging_path(spark, "products")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    # an empty first write gives the table its columns where no row is a query
    spark.createDataFrame([], RESULT + ", rank int").write.parquet(path)
    for low in range(0, total, chunk):
        rows = asked.where(F.col("before").between(low, low + chunk - 1)).collect()
        queries = [
            (r["row"], r["vec_id"], np.array(r["weights"], "<i8").tobytes()) for r in rows
        ]
        found = search_chunk(stored, queries, top)
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        found.write.mode("append").parquet(path)
    results = spark.read.schema(RESULT + ", rank int").parquet(path)
    return results.select("query_id", "rank", "vec_id", "score")

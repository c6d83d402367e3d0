"""Packing along a space-filling curve.

Each document's token counts, hashed to ``BUCKETS`` features and scaled to unit length,
are projected to ``DIMENSIONS`` coordinates.  The Hilbert index of the coordinates' grid
cell orders the documents, so that neighbours on the curve are alike; documents are laid
end to end in that order and cut into sequences of ``length`` tokens.  Only the last
sequence of all has room left.

Range bounds come from quantiles of the order, token sums per range fix where each range
starts, and then every range is sorted and cut by its own task.  Documents of equal index
(copies) are ordered by a hash of their ids, so that they spread over ranges too.

Defined results: NULL text is empty; an empty text is one closing token.  Rows that repeat
an id, and NULL ids, are packed like all others.  A document longer than a sequence spans
several.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.llm.flow import buckets_for, stage
from modeloom.llm.text import mix, owners
from modeloom.llm.tokens import TOKENIZER, tokenised

LENGTH = 4096
BUCKETS = 256
DIMENSIONS = 4
BITS = 10
# The projections of unit vectors rarely leave this range; beyond it they are clipped.
SPAN = 3.0
TIE_BITS = 23


def projection() -> np.ndarray:
    """The fixed random projection of hashed features."""
    return np.random.default_rng(20240229).standard_normal((BUCKETS, DIMENSIONS))


def coordinates(ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Grid cell of every document's projected vector."""
    bucket = (mix(ids.astype(np.uint64), 1) % np.uint64(BUCKETS)).astype(np.int64)
    counts = np.bincount(
        owners(offsets) * BUCKETS + bucket, minlength=(len(offsets) - 1) * BUCKETS
    ).reshape(-1, BUCKETS)
    norms = np.sqrt((counts.astype(float) ** 2).sum(axis=1))
    points = counts @ projection() / np.maximum(norms, 1.0)[:, None]
    # rounding hides the last bits, which may differ between machines
    cells = np.floor((np.round(points, 9) + SPAN) / (2 * SPAN) * (1 << BITS))
    return np.clip(cells, 0, (1 << BITS) - 1).astype(np.int64)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of grid cells, by Skilling's transposition of the bits."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    for level in range(bits - 1, 0, -1):
        mask = (1 << level) - 1
        for axis in range(n):
            high = (x[:, axis] >> level) & 1 == 1
            swap = np.where(high, 0, (x[:, 0] ^ x[:, axis]) & mask)
            x[:, 0] = np.where(high, x[:, 0] ^ mask, x[:, 0] ^ swap)
            x[:, axis] ^= swap
    for axis in range(1, n):
        x[:, axis] ^= x[:, axis - 1]
    turn = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[:, n - 1] >> level) & 1 == 1, turn ^ ((1 << level) - 1), turn)
    x ^= turn[:, None]
    index = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            index = (index << 1) | ((x[:, axis] >> level) & 1)
    return index


def _curve(ids: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    return [pa.array(hilbert(coordinates(ids, offsets)), pa.int64())]


def _ranges(rows: DataFrame, bounds: list[int]) -> DataFrame:
    """Add ``part``, the range that a row's order falls into."""
    edges = np.array(bounds, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(edges, batch.column("place").to_numpy(), side="right")
            yield batch.append_column("part", pa.array(at, pa.int32()))

    schema = ", ".join(f"{n} {k}" for n, k in rows.dtypes)
    return rows.mapInArrow(work, f"{schema}, part int")


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end: int = 2,
    tokenizer: str = TOKENIZER,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset and ids.

    ``ids`` holds the piece's tokens as unsigned little-endian 32-bit numbers.
    """
    rows = stage(
        tokenised(docs, doc_id, text, end, tokenizer, (["curve long"], _curve)), "tokens"
    )
    tie = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - TIE_BITS)
    place = F.shiftleft(F.col("curve"), TIE_BITS).bitwiseOR(tie)
    rows = rows.select("doc_id", "n_tokens", place.alias("place"), "ids")
    parts = buckets_for(docs, text)
    fractions = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("place", fractions, 100 * parts)).first()[0]
    bounds = sorted(set(found or []))
    sums = _ranges(rows.select("place", "n_tokens"), bounds).groupBy("part").agg(
        F.sum("n_tokens").alias("n")
    )
    totals = np.zeros(len(bounds) + 2, np.int64)
    for row in sums.collect():  # one row per range
        totals[row["part"] + 1] = row["n"]
    starts = np.cumsum(totals)

    def cut(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("doc_id", "ascending")])
        counts = table.column("n_tokens").to_numpy()
        at = int(starts[table.column("part")[0].as_py()])
        pieces: dict[str, list] = {name: [] for name, _ in PIECE}
        for doc, n, data in zip(
            table.column("doc_id").to_pylist(), counts, table.column("ids"), strict=True
        ):
            raw = np.frombuffer(data.as_buffer(), f"<u{len(data.as_buffer()) // int(n)}")
            done = 0
            while done < n:
                take = min(int(n) - done, length - at % length)
                row = (doc, done, take, int(n), at // length, at % length)
                body = raw[done : done + take].astype("<u4").tobytes()
                for (name, _), value in zip(PIECE, (*row, body), strict=True):
                    pieces[name].append(value)
                done, at = done + take, at + take
        return pa.table({name: pa.array(pieces[name], kind) for name, kind in PIECE})

    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long,"
    return _ranges(rows, bounds).groupBy("part").applyInArrow(
        cut, f"{schema} offset long, ids binary"
    )


PIECE = [
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("ids", pa.binary()),
]

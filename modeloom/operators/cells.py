"""A bounded, mergeable summary of numeric columns: counts and moments of value cells.

A cell is all values that agree in their leading bits, the bits arranged in the order of the
numbers.  Cells of fewer bits contain whole cells of more bits, so summaries of any parts of a
table merge exactly: they are cut to the least number of bits among them and added up.  Every
task starts with single values and drops bits only when it holds more than ``limit`` cells of a
column; the merged summary has the most bits with which at most ``limit`` cells are occupied,
whatever the partitioning.  A column with no more distinct values than that is kept exactly.

The table is scanned once.  What is fitted, ranked or profiled afterwards reads the cells.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeloom.operators.order_stats import ordered_bits

# Cells kept of one column.
CELLS = 1 << 15
# Cells of all columns and chunks a task holds before it hands them on.
HELD = 1 << 21

CELL_SCHEMA = (
    "c int, bits int, part long, n double, mean double, m2 double, low double, high double"
)
NAMES = [f.split(" ")[0] for f in CELL_SCHEMA.split(", ")]
# Widths tried in one pass when merged cells are still too many.
TRIED = 8


class CellSet:
    """Cells of one column, sorted by ``part``: their leading bits, the others 0."""

    def __init__(self, bits: int, part, n, mean, m2, low, high):
        self.bits, self.part = bits, part
        self.n, self.mean, self.m2, self.low, self.high = n, mean, m2, low, high

    @classmethod
    def of_values(cls, x: np.ndarray) -> CellSet:
        part, first, n = np.unique(ordered_bits(x), return_index=True, return_counts=True)
        value = x[first] + 0.0
        return cls(64, part, n.astype(float), value, np.zeros(len(part)), value, value)

    @classmethod
    def joined(cls, sets: Sequence[CellSet], bits: int | None = None) -> CellSet:
        """All cells of the sets at their least width (or at ``bits``), equal ones added up."""
        bits = min([s.bits for s in sets] + ([] if bits is None else [bits]))
        part = np.concatenate([s.part for s in sets]) & leading(bits)
        part, first, where = np.unique(part, return_index=True, return_inverse=True)
        n, mean, m2, low, high = (
            np.concatenate([getattr(s, name) for s in sets])
            for name in ("n", "mean", "m2", "low", "high")
        )
        size = len(part)
        total = np.bincount(where, n, size)
        # deviations from one member's mean: members of a cell lie close together
        base = mean[first]
        away = mean - base[where]
        shift = np.bincount(where, n * away, size) / np.maximum(total, 1)
        spread = np.bincount(where, m2 + n * away**2, size) - total * shift**2
        lows, highs = np.full(size, np.inf), np.full(size, -np.inf)
        np.minimum.at(lows, where, low)
        np.maximum.at(highs, where, high)
        spread = np.where(lows == highs, 0.0, np.maximum(spread, 0.0))
        mean = np.clip(base + shift, lows, highs)
        return cls(bits, part, total, mean, spread, lows, highs)

    def __len__(self) -> int:
        return len(self.part)

    def width_for(self, limit: int) -> int:
        """The most leading bits with which at most ``limit`` cells are occupied."""
        if len(self.part) <= limit:
            return self.bits
        shared = np.sort(shared_bits(self.part[1:] ^ self.part[:-1]))
        # two neighbours fall together once no more bits are kept than they share
        return int(shared[limit - 1])

    def bounded(self, limit: int) -> CellSet:
        width = self.width_for(limit)
        return self if width == self.bits else CellSet.joined([self], width)

    def batch(self, c: int, chunk: int | None = None) -> pa.RecordBatch:
        columns = [
            pa.array([c] * len(self), pa.int32()), pa.array([self.bits] * len(self), pa.int32()),
            pa.array(self.part.view(np.int64)),
            *(pa.array(v) for v in (self.n, self.mean, self.m2, self.low, self.high)),
        ]
        if chunk is None:
            return pa.RecordBatch.from_arrays(columns, names=NAMES)
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(self), pa.int64()), *columns], names=["chunk", *NAMES]
        )


def leading(bits: int) -> np.uint64:
    return np.uint64((((1 << bits) - 1) << (64 - bits)) & 0xFFFFFFFFFFFFFFFF)


def shared_bits(difference: np.ndarray) -> np.ndarray:
    """Leading bits in which two numbers agree, from their difference by bits."""
    upper, lower = difference >> np.uint64(32), difference & np.uint64(0xFFFFFFFF)
    # exact: numbers of 32 bits are whole in a double
    top = np.frexp(upper.astype(float))[1]
    return np.where(upper > 0, 32 - top, 64 - np.frexp(lower.astype(float))[1])


class Gatherer:
    """The cells of each series seen by one task; a series is a column or a part of one."""

    def __init__(self, limit: int):
        self.limit = limit
        self.held: dict[tuple, list[CellSet]] = {}
        self.size = 0

    def add(self, key: tuple, x: np.ndarray) -> None:
        if len(x) == 0:
            return
        sets = self.held.setdefault(key, [])
        sets.append(CellSet.of_values(x))
        self.size += len(sets[-1])
        if sum(map(len, sets)) > 4 * self.limit:
            self._settle(key)

    def _settle(self, key: tuple) -> CellSet:
        sets = self.held[key]
        whole = CellSet.joined(sets).bounded(self.limit)
        self.size -= sum(map(len, sets)) - len(whole)
        self.held[key] = [whole]
        return whole

    def settled(self) -> Iterator[tuple[tuple, CellSet]]:
        for key in list(self.held):
            yield key, self._settle(key)
        self.held, self.size = {}, 0

    def full(self) -> bool:
        if self.size > HELD:
            for key in list(self.held):
                self._settle(key)
        return self.size > HELD


def gathered(
    df: DataFrame,
    columns: Sequence[str | Column],
    *,
    limit: int = CELLS,
    kept: Mapping[int, tuple[int, tuple[float, ...], bool]] | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Cells of every task, from one scan; NULL, NaN and the infinities are left out.

    Series ``i`` is column ``i``.  ``kept`` adds series of some of a column's values:
    ``{series: (column, values, wanted)}`` holds the rows whose value is (or is not) among them.
    With ``chunk``, cells are kept by chunk, in a column of that name; its NULL is -1.
    """
    series = dict(kept or {})
    values = [
        (F.col(c) if isinstance(c, str) else c).cast("double").alias(f"v{i}")
        for i, c in enumerate(columns)
    ]
    if chunk is not None:
        values.append(F.coalesce(chunk.cast("long"), F.lit(-1)).alias("chunk"))
    width, by_chunk = len(columns), chunk is not None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Gatherer(limit)

        def add(at, data):
            usable = [x[np.isfinite(x)] for x in data]
            for i, x in enumerate(usable):
                found.add((at, i), x)
            for i, (column, among, wanted) in series.items():
                x = usable[column]
                found.add((at, i), x[np.isin(x, among) == wanted])

        for batch in batches:
            data = [
                batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(width)
            ]
            if not by_chunk:
                add(None, data)
            else:
                at = batch.column(width).to_numpy()
                for one in np.unique(at).tolist():
                    add(one, [x[at == one] for x in data])
            if found.full():
                for (at, c), cells in found.settled():
                    yield cells.batch(c, at)
        for (at, c), cells in found.settled():
            yield cells.batch(c, at)

    schema = "chunk long, " + CELL_SCHEMA if by_chunk else CELL_SCHEMA
    return df.select(*values).mapInArrow(work, schema)


def _read(batch: pa.RecordBatch, columns: Sequence[str] = NAMES[2:]) -> list[np.ndarray]:
    out = [batch.column(name).to_numpy() for name in columns]
    out[0] = out[0].view(np.uint64)
    return out


def _added(parts: DataFrame, widths: Mapping[int, int]) -> DataFrame:
    """Cells cut to the given width of their column, equal ones added up over all tasks."""
    masks = {c: np.array([leading(w)], np.uint64).view(np.int64)[0].item() for c, w in widths.items()}
    mask = F.lit(0).cast("long")
    for c, value in masks.items():
        mask = F.when(F.col("c") == c, F.lit(value)).otherwise(mask)
    count = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[CellSet]] = {}
        for batch in batches:
            columns = batch.column("c").to_numpy()
            data = _read(batch)
            for c in np.unique(columns).tolist():
                at = columns == c
                held.setdefault(c, []).append(CellSet(widths[c], *(a[at] for a in data)))
                if len(held[c]) > 32:
                    held[c] = [CellSet.joined(held[c])]
        for c, sets in held.items():
            yield CellSet.joined(sets).batch(c)

    cut = parts.select(*NAMES).withColumn("part", F.col("part").bitwiseAND(mask))
    return cut.repartition(count, "c", "part").mapInArrow(work, CELL_SCHEMA)


def merged(parts: DataFrame, *, limit: int = CELLS) -> DataFrame:
    """One summary of all ``parts``: at most ``limit`` cells of every column.

    Only widths and counts reach the driver, one number per column.
    """
    parts = parts.persist(StorageLevel.MEMORY_AND_DISK)
    widths = {r["c"]: r["w"] for r in parts.groupBy("c").agg(F.min("bits").alias("w")).collect()}
    found = _added(parts, widths).persist(StorageLevel.MEMORY_AND_DISK)
    while True:
        sizes = found.groupBy("c").count().where(F.col("count") > limit).collect()
        if not sizes:
            return found
        wide = [r["c"] for r in sizes]
        tried = range(1, TRIED + 1)
        own = found.where(F.col("c").isin(wide))
        # the widths below the present one, all counted in one pass
        counts = own.groupBy("c").agg(
            F.first("bits").alias("w"),
            *[F.count_distinct(F.expr(f"shiftright(part, 64 - bits + {i})")).alias(f"n{i}") for i in tried],
        )
        for r in counts.collect():
            fits = [i for i in tried if r[f"n{i}"] <= limit]
            widths[r["c"]] = r["w"] - (fits[0] if fits else TRIED)
        found = _added(found, widths).persist(StorageLevel.MEMORY_AND_DISK)


def value_cells(df: DataFrame, columns: Sequence[str | Column], *, limit: int = CELLS) -> DataFrame:
    """The summary of the columns, numbered as they are given: one scan of ``df``."""
    return merged(gathered(df, columns, limit=limit), limit=limit)


def cell_moments(cells: DataFrame) -> DataFrame:
    """rows, mean, variance (of a sample), min and max of every column, from its cells."""
    whole = cells.groupBy("c").agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("mean")).alias("total"),
        F.min("low").alias("min"), F.max("high").alias("max"),
    )
    centre = whole.select("c", (F.col("total") / F.col("rows")).alias("centre"))
    around = cells.join(F.broadcast(centre), "c").groupBy("c").agg(
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("centre"), 2)).alias("ss"),
        F.first("centre").alias("mean"),
    )
    spread = F.when(F.col("rows") > 1, F.col("ss") / (F.col("rows") - 1)).otherwise(0.0)
    return whole.join(around, "c").select(
        "c", F.col("rows").cast("long").alias("rows"), "mean", spread.alias("var"), "min", "max"
    )

"""Exact order statistics and moments without a sort or a global window.

A quantile over all rows is usually one task's work.  Here it is found by counting: a
number's bits, arranged in the order of the numbers, are counted by their leading part;
the part that holds a wanted rank is known from the counts, and the next pass counts the
next bits of the numbers in it.  Five passes settle all bits.  Only counts are shuffled,
one row per task and part, and nothing is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeloom.functions.arrays import finite

# Bits counted in each pass; they add up to the width of a number.
PASS_BITS = (16, 12, 12, 12, 12)
TOP_BIT = np.uint64(1 << 63)


def column_values(
    df: DataFrame, columns: Sequence[str | Column], as_type: str = "double"
) -> DataFrame:
    """All usable values of the columns: ``(c, x)``, ``c`` numbering the columns.

    NULL, NaN and the infinities are left out.  A projection: nothing is shuffled.
    """
    values = df.select(
        *[
            (F.col(c) if isinstance(c, str) else c).cast(as_type).alias(f"v{i}")
            for i, c in enumerate(columns)
        ]
    )
    if len(columns) == 1:
        long = values.select(F.lit(0).alias("c"), F.col("v0").alias("x"))
    else:
        long = values.unpivot([], values.columns, "name", "x").select(
            F.substring("name", 2, 9).cast("int").alias("c"), "x"
        )
    return long.where(finite(F.col("x")))


def value_counts(
    df: DataFrame, columns: Sequence[str | Column], as_type: str = "double"
) -> DataFrame:
    """Distinct values with their row counts: ``(c, x, w)``; for columns known to be coarse.

    Counts are combined before the shuffle, so a value held by a third of the rows costs one
    row per task.
    """
    return column_values(df, columns, as_type).groupBy("c", "x").agg(F.count(F.lit(1)).alias("w"))


def value_blocks(values: DataFrame) -> DataFrame:
    """Values ``(c, x)`` or counts ``(c, x, w)`` packed for repeated passes.

    A block is at most one Arrow batch of rows: ``(c, x, w)`` with the numbers as bytes, and
    no bytes for ``w`` where every row counts once.  Handing over bytes spares the row by
    row conversion that would otherwise be most of a pass.
    """
    kind = "<i8" if dict(values.dtypes)["x"] == "bigint" else "<f8"
    weighted = "w" in values.columns

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            columns = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).to_numpy(zero_copy_only=False).astype(kind)
            w = batch.column(2).to_numpy(zero_copy_only=False).astype("<f8") if weighted else None
            present = np.unique(columns)
            held = [columns == c for c in present]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(present, pa.int32()),
                    pa.array([x[at].tobytes() for at in held], pa.binary()),
                    pa.array([b"" if w is None else w[at].tobytes() for at in held], pa.binary()),
                ],
                names=["c", "x", "w"],
            )

    names = ["c", "x", "w"] if weighted else ["c", "x"]
    return values.select(*names).mapInArrow(pack, "c int, x binary, w binary")


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """64-bit numbers in the order of the values; -0.0 counts as 0.0."""
    if x.dtype.kind == "i":
        return x.view(np.uint64) ^ TOP_BIT
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits & TOP_BIT, ~bits, bits | TOP_BIT)


def from_ordered_bits(bits: int, integer: bool) -> float | int:
    number = np.array([bits], np.uint64)
    if integer:
        return int((number ^ TOP_BIT).view(np.int64)[0])
    back = np.where(number & TOP_BIT, number ^ TOP_BIT, ~number)
    return float(back.view(np.float64)[0])


def _part_counts(
    blocks: DataFrame, wanted: Mapping[int, Sequence[int]], done: int, bits: int, integer: bool
) -> dict[int, dict[int, int]]:
    """Rows of each leading part of ``done + bits`` bits, below the wanted leading parts."""
    heads = {c: np.array(sorted(parts), np.uint64) for c, parts in wanted.items()}
    kind = "<i8" if integer else "<f8"

    def count(batches):
        import numpy as np
        import pyarrow as pa

        found: dict[int, list] = {}
        for batch in batches:
            for c, x, w in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if c not in heads:
                    continue
                key = ordered_bits(np.frombuffer(x, kind))
                weight = np.frombuffer(w, "<f8") if w else np.ones(len(key))
                if done:
                    head = key >> np.uint64(64 - done)
                    at = np.minimum(np.searchsorted(heads[c], head), len(heads[c]) - 1)
                    inside = heads[c][at] == head
                    key, weight = key[inside], weight[inside]
                part, where = np.unique(key >> np.uint64(64 - done - bits), return_inverse=True)
                held = found.setdefault(c, [])
                held.append((part, np.bincount(where, weights=weight, minlength=len(part))))
                if len(held) > 64:
                    found[c] = [_merged(held)]
        for c, held in found.items():
            part, n = _merged(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c] * len(part), pa.int32()),
                    pa.array(part.view(np.int64), pa.int64()),
                    pa.array(n.astype(np.int64), pa.int64()),
                ],
                names=["c", "part", "n"],
            )

    rows = blocks.mapInArrow(count, "c int, part long, n long").groupBy("c", "part").agg(
        F.sum("n").alias("n")
    )
    out: dict[int, dict[int, int]] = {c: {} for c in wanted}
    for row in rows.collect():  # as many rows as there are parts below the wanted ones
        out[row["c"]][row["part"] & 0xFFFFFFFFFFFFFFFF] = row["n"]
    return out


def _merged(held):
    parts = np.concatenate([p for p, _ in held])
    counts = np.concatenate([n for _, n in held])
    part, where = np.unique(parts, return_inverse=True)
    return part, np.bincount(where, weights=counts, minlength=len(part))


def block_order_statistics(
    blocks: DataFrame, ranks: Mapping[int, Sequence[int]], integer: bool = False
) -> dict[tuple[int, int], float]:
    """The ``rank``-th smallest value (from 1) of each column ``c`` of packed values.

    ``ranks`` is small by nature (a few per column) and so is the answer; ranks beyond a
    column's rows are left out.
    """
    # (column, rank) -> the leading part that holds it, and the rank inside that part
    open_ranks = {(c, r): (0, r) for c, wanted in ranks.items() for r in wanted if r >= 1}
    done = 0
    for bits in PASS_BITS:
        if not open_ranks:
            return {}
        wanted: dict[int, set[int]] = {}
        for (c, _), (head, _) in open_ranks.items():
            wanted.setdefault(c, set()).add(head)
        counted = _part_counts(blocks, wanted, done, bits, integer)
        below: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for c, parts in counted.items():
            for part in sorted(parts):
                below.setdefault((c, part >> bits), []).append((part, parts[part]))
        narrowed = {}
        for (c, rank), (head, inside) in open_ranks.items():
            for part, n in below.get((c, head), ()):
                if inside <= n:
                    narrowed[(c, rank)] = (part, inside)
                    break
                inside -= n
        open_ranks, done = narrowed, done + bits
    return {key: from_ordered_bits(bits, integer) for key, (bits, _) in open_ranks.items()}


def order_statistics(
    values: DataFrame, ranks: Mapping[int, Sequence[int]]
) -> dict[tuple[int, int], float]:
    """:func:`block_order_statistics` of values ``(c, x)`` or counts ``(c, x, w)``."""
    integer = dict(values.dtypes)["x"] == "bigint"
    blocks = value_blocks(values).persist()
    try:
        return block_order_statistics(blocks, ranks, integer)
    finally:
        blocks.unpersist()


def block_moments(blocks: DataFrame) -> dict[int, dict[str, float]]:
    """Rows, min, max, mean and sample variance of every column of packed values.

    Two passes: deviations are taken from the mean, which keeps tight columns far from zero
    accurate.
    """
    first = {
        r["c"]: r.asDict() for r in blocks.mapInArrow(_task_sums({}), SUMS).groupBy("c").agg(
            F.sum("rows").alias("rows"), F.sum("total").alias("total"),
            F.min("low").alias("min"), F.max("high").alias("max"),
        ).collect()
    }
    stats = {
        c: {
            "rows": int(r["rows"]), "min": r["min"], "max": r["max"],
            "mean": min(max(r["total"] / r["rows"], r["min"]), r["max"]),
        }
        for c, r in first.items()
    }
    if not stats:
        return {}
    means = {c: s["mean"] for c, s in stats.items()}
    second = blocks.mapInArrow(_task_sums(means), SUMS).groupBy("c").agg(F.sum("total").alias("ss"))
    for row in second.collect():
        rows = stats[row["c"]]["rows"]
        stats[row["c"]]["var"] = row["ss"] / (rows - 1) if rows > 1 else 0.0
    return stats


SUMS = "c int, rows double, total double, low double, high double"


def _task_sums(means):
    """Per task and column: rows, sum (of squared deviations, given means), min and max."""

    def work(batches):
        import numpy as np
        import pyarrow as pa

        found = {}
        for batch in batches:
            for c, x, w in zip(*(batch.column(i).to_pylist() for i in range(3))):
                x = np.frombuffer(x, "<f8")
                w = np.frombuffer(w, "<f8") if w else np.ones(len(x))
                y = (x - means[c]) ** 2 if means else x
                new = (w.sum(), float(w @ y), x.min(), x.max())
                old = found.get(c, (0.0, 0.0, np.inf, -np.inf))
                found[c] = (
                    old[0] + new[0], old[1] + new[1], min(old[2], new[2]), max(old[3], new[3])
                )
        for c, row in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int32()), *(pa.array([float(v)], pa.float64()) for v in row)],
                names=["c", "rows", "total", "low", "high"],
            )

    return work


def quantile_ranks(rows: int, q: float) -> tuple[int, int, float]:
    """The two ranks around the ``q`` quantile and the share of the upper one."""
    position = q * (rows - 1)
    low = int(position)
    return low + 1, min(low + 2, rows), position - low


def interpolated(values: Mapping[tuple[int, int], float], c: int, rows: int, q: float) -> float:
    low, high, share = quantile_ranks(rows, q)
    bottom, top = values[(c, low)], values[(c, high)]
    return bottom + (top - bottom) * share

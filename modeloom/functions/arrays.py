"""Scalar and array column helpers that stay inside generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(value: float) -> Column:
    return F.lit(float(value))


def clip(value: Column, bound: float) -> Column:
    """``value`` held to plus or minus ``bound``; ``least`` alone would skip a NULL."""
    return F.when(value.isNotNull(), F.greatest(number(-bound), F.least(number(bound), value)))


def finite(value: Column) -> Column:
    """True for a number; NULL or false for NULL, NaN and the infinities."""
    return F.abs(value) < number(float("inf"))


def constants(values: Sequence[float]) -> Column:
    return F.array(*[number(v) for v in values])


def item(values: Column, index: int | Column) -> Column:
    """Zero-based element; NULL for a NULL array or index.

    ``get`` and not ``values[index]``: with ANSI mode on, the planner takes the latter for
    never NULL when the elements are not.
    """
    return F.get(values, F.lit(index) if isinstance(index, int) else index)


def pick(values: Sequence[float], index: Column) -> Column:
    """``values[index]`` from a constant array."""
    return item(constants(values), index)


def one_hot(index: Column, width: int) -> Column:
    """1.0 at the zero-based ``index``, 0.0 elsewhere."""
    return F.concat(
        F.array_repeat(number(0), index.cast("int")),
        F.array(number(1)),
        F.array_repeat(number(0), F.lit(width - 1) - index.cast("int")),
    )


def argmax(values: Column) -> Column:
    """Zero-based position of the largest element, the first one on ties; NULL without any."""
    top = F.array_max(values)
    return F.when(top.isNotNull(), F.array_position(values, top) - F.lit(1)).cast("int")


def reorder(values: Column, order: Sequence[int]) -> Column:
    """Slot ``i`` takes element ``order[i]``."""
    return F.array(*[item(values, int(i)) for i in order])


def inverse_order(order: Sequence[int]) -> list[int]:
    slots = [0] * len(order)
    for slot, element in enumerate(order):
        slots[element] = slot
    return slots


def null_slots(width: int) -> Column:
    return F.array_repeat(F.lit(None).cast("double"), width)

"""Mixture posteriors as staged projections.

Each step reads the named columns of the step before it.  Catalyst keeps the steps
as separate projections inside one generated-code stage, so every exponential is
computed once per row; one nested expression would repeat them K times over.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeloom.functions.arrays import finite, number


def sealed(df: DataFrame, keep: Sequence[str], split: bool = False, **columns: Column) -> DataFrame:
    """Select ``keep`` and the results of staged steps, closed to predicate push-down.

    A filter on a staged result, pushed down, would unfold all steps into one expression
    of exponential size.  Results leave through a one-row generator, which such filters
    do not pass; filters on the kept columns still reach the scan.

    ``split`` also ends the generated-code stage here: a higher-order function has no
    generated form.  Two columns' steps in one method pass the 8,000 bytecodes up to
    which the JVM compiles it, and then run interpreted, many times slower.
    """
    row = F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))
    if split:
        row = F.filter(row, lambda _: F.lit(True))
    return df.select(*keep, F.inline(row))


def stage_value(df: DataFrame, value: Column, tag: str) -> DataFrame:
    """``{tag}ok`` and a never-NULL ``{tag}x`` (0 where the value is unusable)."""
    value = value.cast("double")
    return df.withColumns({f"{tag}ok": F.coalesce(finite(value), F.lit(False))}).withColumn(
        f"{tag}x", F.when(F.col(f"{tag}ok"), F.coalesce(value, number(0))).otherwise(number(0))
    )


def stage_log_terms(df: DataFrame, model, tag: str) -> DataFrame:
    """``{tag}z{k}`` = log weight plus log density of every mode, and their maximum."""
    x = F.col(f"{tag}x")
    terms = {}
    for k in range(model.size):
        away = x - number(model.mean[k])
        terms[f"{tag}z{k}"] = number(model.log_c[k]) - number(model.half_prec[k]) * away * away
    return df.withColumns(terms).withColumn(
        f"{tag}top", F.greatest(*map(F.col, terms)) if model.size > 1 else F.col(f"{tag}z0")
    )


def stage_posteriors(df: DataFrame, model, tag: str) -> DataFrame:
    """``{tag}r{k}``, the posterior of every mode; shifted by the maximum first."""
    df = stage_log_terms(df, model, tag)
    top = F.col(f"{tag}top")
    df = df.withColumns(
        {f"{tag}e{k}": F.exp(F.col(f"{tag}z{k}") - top) for k in range(model.size)}
    )
    total = reduce(add, [F.col(f"{tag}e{k}") for k in range(model.size)])
    df = df.withColumn(f"{tag}total", total)
    return df.withColumns(
        {f"{tag}r{k}": F.col(f"{tag}e{k}") / F.col(f"{tag}total") for k in range(model.size)}
    )


def stage_best_mode(df: DataFrame, modes: list[int], tag: str) -> DataFrame:
    """``{tag}j``: position within ``modes`` of the most probable one, first on ties."""
    best = F.greatest(*[F.col(f"{tag}z{k}") for k in modes]) if len(modes) > 1 else F.col(f"{tag}z{modes[0]}")
    df = df.withColumn(f"{tag}best", best)
    chosen = F.lit(len(modes) - 1)
    for position in range(len(modes) - 2, -1, -1):
        chosen = F.when(
            F.col(f"{tag}z{modes[position]}") == F.col(f"{tag}best"), F.lit(position)
        ).otherwise(chosen)
    return df.withColumn(f"{tag}j", chosen)


def stage_drawn_mode(
    df: DataFrame, modes: list[int], uniform: Column, floor: float, tag: str
) -> DataFrame:
    """``{tag}j``: position within ``modes``, drawn with p proportional to r + floor."""
    running = None
    for position, k in enumerate(modes):
        share = F.col(f"{tag}r{k}") + number(floor)
        running = share if running is None else F.col(f"{tag}c{position - 1}") + share
        df = df.withColumn(f"{tag}c{position}", running)
    last = len(modes) - 1
    df = df.withColumn(f"{tag}t", uniform * F.col(f"{tag}c{last}"))
    passed = [
        (F.col(f"{tag}c{position}") <= F.col(f"{tag}t")).cast("int") for position in range(last)
    ]
    return df.withColumn(f"{tag}j", reduce(add, passed) if passed else F.lit(0))

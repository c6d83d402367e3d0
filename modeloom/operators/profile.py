"""Column profiles: range, moments and quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeloom.functions.arrays import finite
from modeloom.operators.order_stats import (
    block_moments,
    block_order_statistics,
    column_values,
    interpolated,
    quantile_ranks,
    value_blocks,
)

# The percentiles of a generator profile and of a description.
PROFILE_PERCENTILES = (25, 50, 75, 90, 95, 99)
DESCRIBE_PERCENTILES = (25, 50, 75)
# Relative rank error of a sketch is at most one over this.
SKETCH_ACCURACY = 10_000


def profile_values(
    blocks: DataFrame, n_series: int, percentiles: Sequence[float]
) -> list[dict[str, float] | None]:
    """Profile of every column of packed, persisted values; None for an empty one."""
    stats = block_moments(blocks)
    ranks = {
        c: [r for p in percentiles for r in quantile_ranks(s["rows"], p / 100)[:2]]
        for c, s in stats.items()
    }
    found = block_order_statistics(blocks, ranks)
    profiles = []
    for c in range(n_series):
        if c not in stats:
            profiles.append(None)
            continue
        s = stats[c]
        profile = {k: s[k] for k in ("rows", "min", "max", "mean")}
        profile["std"] = s["var"] ** 0.5 if s["rows"] > 1 else None
        for p in percentiles:
            profile[f"p{p:g}"] = interpolated(found, c, s["rows"], p / 100)
        profiles.append(profile)
    return profiles


def column_profile(
    df: DataFrame,
    columns: Sequence[str],
    *,
    percentiles: Sequence[float] = PROFILE_PERCENTILES,
    exact: bool = True,
    names: Sequence[str] | None = None,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """(col, rows, min, max, mean, std, p25, ...): sample std, linear interpolation.

    Exact quantiles take a few counting passes over the persisted columns.  ``exact=False``
    reads the table once and merges quantile sketches of the given accuracy instead.
    """
    names = list(names or columns)
    if not exact:
        return _sketched(df, list(columns), names, percentiles, accuracy)
    blocks = value_blocks(column_values(df, columns)).persist()
    profiles = profile_values(blocks, len(columns), percentiles)
    blocks.unpersist()
    fields = ["min", "max", "mean", "std"] + [f"p{p:g}" for p in percentiles]
    rows = [
        (name, int(p["rows"]), *[None if p[f] is None else float(p[f]) for f in fields])
        if p
        else (name, 0, *[None] * len(fields))
        for name, p in zip(names, profiles, strict=True)
    ]
    schema = "col string, rows long, " + ", ".join(f"{f} double" for f in fields)
    return df.sparkSession.createDataFrame(rows, schema)


def _sketched(df, columns, names, percentiles, accuracy):
    def of(value: Column, name: str):
        x = F.when(finite(value), value)
        cuts = F.percentile_approx(x, [p / 100 for p in percentiles], accuracy)
        return F.struct(
            F.lit(name).alias("col"), F.count(x).alias("rows"), F.min(x).alias("min"),
            F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            *[cuts[i].alias(f"p{p:g}") for i, p in enumerate(percentiles)],
        )

    values = [F.col(c).cast("double") if isinstance(c, str) else c for c in columns]
    one = df.agg(F.array(*[of(v, n) for v, n in zip(values, names, strict=True)]).alias("all"))
    return one.select(F.inline("all"))


def value_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """(min, max) of every column from one pass."""
    usable = {c: F.when(finite(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    row = df.agg(
        *[F.min(v).alias(f"lo_{c}") for c, v in usable.items()],
        *[F.max(v).alias(f"hi_{c}") for c, v in usable.items()],
    ).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in columns}

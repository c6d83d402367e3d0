"""Required columns and bad values."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def _counts(df: DataFrame, required: Sequence[str]) -> tuple[list[Column], Column]:
    """The sums a report needs, and its lines in terms of them."""
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    sums, lines = [F.count(F.lit(1)).alias("rows")], []
    nothing = F.lit(None).cast("long")
    for i, name in enumerate(required):
        if name not in types:
            lines.append((name, False, nothing, nothing, nothing, nothing))
            continue
        column = F.col(name)
        tests = {"nulls": column.isNull()}
        if types[name] in ("float", "double"):
            tests["nans"] = F.isnan(column)
        if types[name] in ("string", "char", "varchar"):
            tests["empties"] = column == F.lit("")
        sums += [F.count_if(test).alias(f"{kind}{i}") for kind, test in tests.items()]
        counted = {kind: F.col(f"{kind}{i}") for kind in tests}
        zero = F.lit(0).cast("long")
        lines.append(
            (name, True, F.col("rows"), *[counted.get(k, zero) for k in ("nulls", "nans", "empties")])
        )
    structs = [
        F.struct(
            F.lit(name).alias("col"), F.lit(present).alias("present"), rows.alias("rows"),
            nulls.alias("nulls"), nans.alias("nans"), empties.alias("empties"),
        )
        for name, present, rows, nulls, nans, empties in lines
    ]
    return sums, F.inline(F.array(*structs))


def quality_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """(col, present, rows, nulls, nans, empties) for every required column, in one pass.

    Tests fit the type: NaN is looked for in floating columns only, the empty string in
    string columns only.
    """
    sums, lines = _counts(df, required)
    return df.agg(*sums).select(lines)


def watched(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``df``, and its :func:`quality_report` for after the first job that reads it to the end:
    the counts are taken on the way, without a scan of their own."""
    sums, lines = _counts(df, required)
    seen = Observation()

    def report() -> DataFrame:
        schema = ", ".join(f"{name} long" for name in seen.get)
        return df.sparkSession.createDataFrame([tuple(seen.get.values())], schema).select(lines)

    return df.observe(seen, *sums), report


def validate(df: DataFrame, required: Sequence[str], *, strict: bool = False) -> bool:
    """False if a required column is missing; bad values pass unless ``strict``, which raises."""
    if missing_columns(df, required):
        if strict:
            raise ValueError(f"missing required columns: {missing_columns(df, required)}")
        return False
    if strict:
        bad = [
            f"{r['col']}: {r['nulls']} null, {r['nans']} NaN, {r['empties']} empty"
            for r in quality_report(df, required).collect()
            if r["nulls"] + r["nans"] + r["empties"] > 0
        ]
        if bad:
            raise ValueError("bad values in " + "; ".join(bad))
    return True

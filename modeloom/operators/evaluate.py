"""Did the encoding keep what it should?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.functions.arrays import finite, item, number
from modeloom.operators.order_stats import (
    block_moments,
    block_order_statistics,
    column_values,
    value_blocks,
)
from modeloom.operators.profile import DESCRIBE_PERCENTILES, column_profile

# Tail size per mille, and the relative error that counts as exact.
TAIL_PER_MILLE = 1
EXACT = 1e-9


def encoding_stats(df: DataFrame, encoded: str = "encoded") -> DataFrame:
    """Describe the first slot and the largest mode slot over the whole table."""
    parts = df.select(
        item(F.col(encoded), 0).alias("value"),
        F.array_max(F.slice(F.col(encoded), F.lit(2), F.size(encoded) - F.lit(1))).alias(
            "confidence"
        ),
    )
    return column_profile(
        parts, ["value", "confidence"], percentiles=DESCRIBE_PERCENTILES
    )


def roundtrip_report(
    df: DataFrame, original: str, decoded: str = "decoded", clipped: str | None = "overflow"
) -> DataFrame:
    """Error of decode(encode(x)) overall, by decile of x and in both 0.1% tails.

    (part, rows, clipped, exact, max_error, mean_error).  Deciles and tails are set by
    exact cut values, so every value finds its parts by comparison.
    """
    x = F.col(original).cast("double")
    was_clipped = (
        F.col(clipped).isNotNull() if clipped is not None and clipped in df.columns else F.lit(False)
    )
    error = F.abs(F.col(decoded) - x)
    exact = error <= number(EXACT) * F.greatest(number(1), F.abs(x))
    values = value_blocks(column_values(df, [x])).persist()
    total = block_moments(values).get(0, {"rows": 0})["rows"]
    if total == 0:
        values.unpersist()
        raise ValueError(f"no usable value in {original}")

    def rank(per_mille):
        return max(1, -(-total * per_mille // 1000))

    deciles = [rank(100 * i) for i in range(1, 10)]
    low, high = rank(TAIL_PER_MILLE), total - rank(TAIL_PER_MILLE) + 1
    cuts = block_order_statistics(values, {0: [*deciles, low, high]})
    values.unpersist()
    decile = F.lit(1)
    for r in deciles:
        decile = decile + (x > number(cuts[(0, r)])).cast("int")
    parts = F.array_compact(
        F.array(
            F.lit("all"),
            F.concat(F.lit("decile_"), F.lpad(decile.cast("string"), 2, "0")),
            F.when(x <= number(cuts[(0, low)]), F.lit("bottom_tail")),
            F.when(x >= number(cuts[(0, high)]), F.lit("top_tail")),
        )
    )
    # First by the set of parts a value is in, a few dozen of them, then by part.
    return (
        df.where(finite(x))
        .groupBy(parts.alias("parts"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(was_clipped).alias("clipped"),
            F.count_if(exact).alias("exact"),
            F.max(error).alias("max_error"),
            F.sum(error).alias("sum_error"),
        )
        .withColumn("part", F.explode("parts"))
        .groupBy("part")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("clipped").alias("clipped"),
            F.sum("exact").alias("exact"),
            F.max("max_error").alias("max_error"),
            (F.sum("sum_error") / F.sum("rows")).alias("mean_error"),
        )
    )

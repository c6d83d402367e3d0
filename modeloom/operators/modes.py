"""How a model's modes are used by a table: posteriors, assignments, mass, order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.functions.arrays import clip, number, pick
from modeloom.functions.draws import hash_uniform
from modeloom.functions.posterior import (
    sealed,
    stage_best_mode,
    stage_drawn_mode,
    stage_log_terms,
    stage_posteriors,
    stage_value,
)
from modeloom.operators.mixture import MixtureModel
from modeloom.spec import DRAW_FLOOR, ENCODE_CLIP

TAG = "__mode_"


def normalised(
    df: DataFrame, column: str, model: MixtureModel, bound: float = ENCODE_CLIP
) -> DataFrame:
    """Per row ``u`` = (x - mean) / (4 std) for every mode, and ``clipped`` beside it."""
    x = F.col(column).cast("double")
    all_modes = F.array(
        *[(x - number(model.mean[k])) / number(4 * model.std[k]) for k in range(model.size)]
    )
    kept = F.array(
        *[
            clip((x - number(model.mean[k])) / number(4 * model.std[k]), bound)
            for k in range(model.size)
        ]
    )
    return df.withColumns({"u": all_modes, "clipped": kept})


def posteriors(df: DataFrame, column: str, model: MixtureModel) -> DataFrame:
    """``posterior``: the probability of every mode given the value."""
    staged = stage_posteriors(stage_value(df, F.col(column), TAG), model, TAG)
    block = F.array(*[F.col(f"{TAG}r{k}") for k in range(model.size)])
    return sealed(staged, df.columns, posterior=F.when(F.col(f"{TAG}ok"), block))


def assigned(df: DataFrame, column: str, model: MixtureModel) -> DataFrame:
    """``mode``: the most probable of all modes."""
    staged = stage_log_terms(stage_value(df, F.col(column), TAG), model, TAG)
    staged = stage_best_mode(staged, list(range(model.size)), TAG)
    return sealed(staged, df.columns, mode=F.when(F.col(f"{TAG}ok"), F.col(f"{TAG}j")))


def drawn(
    df: DataFrame, column: str, model: MixtureModel, key: Sequence[str], seed: int = 42
) -> DataFrame:
    """``mode``: an active mode drawn by posterior, and the ``uniform`` that drew it."""
    active = model.active
    staged = df.withColumn(f"{TAG}h", hash_uniform(key, seed))
    staged = stage_posteriors(stage_value(staged, F.col(column), TAG), model, TAG)
    staged = stage_drawn_mode(staged, active, F.col(f"{TAG}h"), DRAW_FLOOR, TAG)
    mode = pick(active, F.col(f"{TAG}j")).cast("int")
    return sealed(
        staged,
        df.columns,
        mode=F.when(F.col(f"{TAG}ok"), mode),
        uniform=F.col(f"{TAG}h"),
    )


def modes_used(df: DataFrame, column: str, model: MixtureModel) -> DataFrame:
    """Rows won by every mode that wins any: ``(k, hits)``."""
    return (
        assigned(df.select(column), column, model)
        .where(F.col("mode").isNotNull())
        .groupBy(F.col("mode").alias("k"))
        .agg(F.count(F.lit(1)).alias("hits"))
    )


def mode_mass(df: DataFrame, column: str, model: MixtureModel) -> DataFrame:
    """Summed posterior of every mode: ``(k, mass)``, one row of sums per task shuffled."""
    staged = stage_posteriors(stage_value(df.select(column), F.col(column), TAG), model, TAG)
    sums = staged.where(F.col(f"{TAG}ok")).agg(
        *[F.sum(f"{TAG}r{k}").alias(f"m{k}") for k in range(model.size)]
    )
    return sums.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).alias("k"), F.col(f"m{k}").alias("mass"))
                    for k in range(model.size)
                ]
            )
        )
    )

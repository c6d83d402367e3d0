"""Decoders: the inverse projections.

Mode vectors may be one-hots or, as a generative model emits them, any scores; the
largest slot wins, the earlier mode on ties.  Where an ``overflow`` value is given it
replaces the clipped one, which makes the ``hard`` encoding exact at the extremes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeloom.functions.arrays import argmax, clip, inverse_order, item, number, pick, reorder
from modeloom.operators.dictionary import Dictionary, labels_of
from modeloom.operators.encode import MixedModel
from modeloom.operators.mixture import MixtureModel
from modeloom.spec import DECODE_CLIP

TAG = "__dec_"


def _scaled(encoded: Column, start: int, overflow: Column | None) -> Column:
    u = clip(item(encoded, start), DECODE_CLIP)
    return u if overflow is None else F.coalesce(overflow, u)


def continuous_value(
    df: DataFrame,
    encoded: Column,
    model: MixtureModel,
    tag: str,
    *,
    start: int = 0,
    overflow: Column | None = None,
) -> tuple[DataFrame, Column]:
    """Staged table and the value of a ``hard`` block that begins at slot ``start``."""
    active = model.active
    slots = [model.order.index(k) for k in active]
    scores = reorder(F.slice(encoded, start + 2, len(active)), slots)
    df = df.withColumn(f"{tag}scores", scores).withColumns(
        {f"{tag}j": argmax(F.col(f"{tag}scores")), f"{tag}u": _scaled(encoded, start, overflow)}
    )
    j = F.col(f"{tag}j")
    spread = pick([4 * model.std[k] for k in active], j)
    return df, F.col(f"{tag}u") * spread + pick([model.mean[k] for k in active], j)


def mixed_value(
    df: DataFrame,
    encoded: Column,
    fitted: MixedModel,
    tag: str,
    *,
    start: int = 0,
    overflow: Column | None = None,
) -> tuple[DataFrame, Column]:
    """As :func:`continuous_value`; a winning special slot gives the special value itself."""
    active, n_modal = fitted.model.active, len(fitted.modal)
    scores = reorder(
        F.slice(encoded, start + 2, len(fitted.order)), inverse_order(fitted.order)
    )
    df = df.withColumn(f"{tag}scores", scores).withColumns(
        {f"{tag}j": argmax(F.col(f"{tag}scores")), f"{tag}u": _scaled(encoded, start, overflow)}
    )
    j = F.col(f"{tag}j")
    # Special slots read as spread 0 around the special value.
    spread = pick([0.0] * n_modal + [4 * fitted.model.std[k] for k in active], j)
    centre = pick(list(fitted.modal) + [fitted.model.mean[k] for k in active], j)
    return df, F.when(j < F.lit(n_modal), centre).otherwise(F.col(f"{tag}u") * spread + centre)


def _overflow(df: DataFrame, overflow: str | None) -> Column | None:
    if overflow is None or overflow not in df.columns:
        return None
    return F.col(overflow)


def decode_continuous(
    df: DataFrame,
    model: MixtureModel,
    *,
    encoded: str = "encoded",
    overflow: str | None = "overflow",
    out: str = "decoded",
) -> DataFrame:
    """Append the value of a ``hard`` encoding."""
    staged, value = continuous_value(
        df, F.col(encoded), model, TAG, overflow=_overflow(df, overflow)
    )
    return staged.select(*df.columns, value.alias(out))


def decode_mixed(
    df: DataFrame,
    fitted: MixedModel,
    *,
    encoded: str = "encoded",
    overflow: str | None = "overflow",
    out: str = "decoded",
) -> DataFrame:
    """Append the value of a mixed encoding."""
    staged, value = mixed_value(df, F.col(encoded), fitted, TAG, overflow=_overflow(df, overflow))
    return staged.select(*df.columns, value.alias(out))


def decode_soft(
    df: DataFrame, model: MixtureModel, *, encoded: str = "encoded", out: str = "decoded"
) -> DataFrame:
    """Append the value a ``soft_masked`` encoding stands for.

    The value was normalised by the first heavy mode and is scaled back by the most
    probable one, so it comes back only where the two agree; kept for compatibility.
    """
    modes = model.heavy
    staged = df.withColumn(f"{TAG}j", argmax(F.slice(F.col(encoded), 2, len(modes))))
    j = F.col(f"{TAG}j")
    value = item(F.col(encoded), 0) * number(4) * pick([model.std[k] for k in modes], j) + pick(
        [model.mean[k] for k in modes], j
    )
    return staged.select(*df.columns, value.alias(out))


def decode_categorical(
    df: DataFrame,
    column: str,
    dictionary: Dictionary,
    *,
    encoded: str = "encoded",
    out: str = "decoded",
) -> DataFrame:
    """Append the label of the largest slot."""
    return labels_of(df, argmax(F.col(encoded)), dictionary, column, out)

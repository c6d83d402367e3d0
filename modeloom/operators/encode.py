"""Encoders: one stateless projection per table, no shuffle, stream-safe.

Four mode-vector variants are kept:

=============  ==============================  ==================  =====
variant        mode vector                     normalised by       clip
=============  ==============================  ==================  =====
hard           one-hot of the chosen mode      the chosen mode     0.99
soft_full      all K posteriors                mode 0              no
soft_masked    posteriors of heavy modes       first heavy mode    0.99
soft_ordered   active posteriors by mass       mode 0              no
=============  ==============================  ==================  =====

``hard`` is the default and the invertible one: where the clip bites, the unclipped
value goes to an ``overflow`` column, NULL elsewhere, so extremes decode exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeloom.functions.arrays import (
    clip,
    inverse_order,
    null_slots,
    number,
    one_hot,
    pick,
)
from modeloom.functions.draws import hash_uniform
from modeloom.functions.posterior import (
    sealed,
    stage_best_mode,
    stage_drawn_mode,
    stage_log_terms,
    stage_posteriors,
    stage_value,
)
from modeloom.operators.dictionary import Dictionary, index_labels
from modeloom.operators.mixture import MixtureModel
from modeloom.spec import DRAW_FLOOR, ENCODE_CLIP, MISSING_MARKER

VARIANTS = ("hard", "soft_full", "soft_masked", "soft_ordered")
TAG = "__enc_"


@dataclass(frozen=True)
class MixedModel:
    """A fitted mixed column.

    ``values`` holds the normalised value of every modal value, ``order`` the slots of
    ``modal ++ active modes`` by falling mass at fit time.  ``model`` is the mixture of the
    ordinary rows; ``overall``, that of all rows, is known right after a fit only.
    """

    modal: tuple[float, ...]
    values: tuple[float, ...]
    model: MixtureModel
    order: tuple[int, ...]
    overall: MixtureModel | None = None

    @property
    def width(self) -> int:
        return 1 + len(self.modal) + len(self.model.active)


def modal_values(
    overall: MixtureModel, modal: Sequence[float], missing: float = MISSING_MARKER
) -> tuple[float, ...]:
    """Normalised value of each special value under its nearest overall mode.

    The missing marker gets 0 wherever it stands in the list.
    """
    out = []
    for value in modal:
        if value == missing:
            out.append(0.0)
            continue
        nearest = min(range(overall.size), key=lambda k: abs(value - overall.mean[k]))
        u = (value - overall.mean[nearest]) / (4 * overall.std[nearest])
        out.append(max(-ENCODE_CLIP, min(ENCODE_CLIP, u)))
    return tuple(out)


def mixed_model(
    overall: MixtureModel,
    rest: MixtureModel,
    modal: Sequence[float],
    modal_rows: Sequence[int],
    missing: float = MISSING_MARKER,
) -> MixedModel:
    """Join the two mixtures of a mixed column; ``modal_rows`` are its special-value counts."""
    mass = [float(n) for n in modal_rows] + [rest.mass[k] for k in rest.active]
    order = tuple(sorted(range(len(mass)), key=lambda slot: (-mass[slot], slot)))
    modal = tuple(float(v) for v in modal)
    return MixedModel(modal, modal_values(overall, modal, missing), rest, order, overall)


def stage_choice(
    df: DataFrame,
    model: MixtureModel,
    tag: str,
    *,
    mode_choice: str,
    key: Sequence[str],
    seed: int,
) -> DataFrame:
    """``{tag}j`` (position among the active modes) and ``{tag}u`` (value under it)."""
    active = model.active
    if mode_choice == "argmax":
        df = stage_best_mode(stage_log_terms(df, model, tag), active, tag)
    elif mode_choice == "draw":
        if not key:
            raise ValueError("drawing modes needs the key columns of the row")
        df = stage_posteriors(df, model, tag)
        df = stage_drawn_mode(df, active, hash_uniform(key, seed), DRAW_FLOOR, tag)
    else:
        raise ValueError(f"mode_choice must be 'draw' or 'argmax', not {mode_choice!r}")
    j = F.col(f"{tag}j")
    mean = pick([model.mean[k] for k in active], j)
    spread = pick([4 * model.std[k] for k in active], j)
    return df.withColumn(f"{tag}u", (F.col(f"{tag}x") - mean) / spread)


def continuous_width(model: MixtureModel, variant: str) -> int:
    return 1 + {
        "hard": len(model.active),
        "soft_full": model.size,
        "soft_masked": len(model.heavy),
        "soft_ordered": len(model.active),
    }[variant]


def continuous_block(
    df: DataFrame,
    value: Column,
    model: MixtureModel,
    tag: str,
    *,
    variant: str = "hard",
    mode_choice: str = "draw",
    key: Sequence[str] = (),
    seed: int = 42,
    split: bool = False,
) -> tuple[DataFrame, Column, Column, Column]:
    """Staged table, the block array, its overflow, and whether the value was usable."""
    if variant not in VARIANTS:
        raise ValueError(f"variant must be one of {VARIANTS}, not {variant!r}")
    keep, df = df.columns, stage_value(df, value, tag)
    ok = F.col(f"{tag}ok")
    if variant == "hard":
        df = stage_choice(df, model, tag, mode_choice=mode_choice, key=key, seed=seed)
        slots = [model.order.index(k) for k in model.active]
        return (*_hard_block(df, keep, tag, F.col(f"{tag}u"), F.col(f"{tag}j"), slots, split), ok)
    df = stage_posteriors(df, model, tag)
    modes = {
        "soft_full": list(range(model.size)),
        "soft_masked": model.heavy,
        "soft_ordered": model.order,
    }[variant]
    base = modes[0] if variant == "soft_masked" else 0
    u = (F.col(f"{tag}x") - number(model.mean[base])) / number(4 * model.std[base])
    if variant == "soft_masked":
        u = clip(u, ENCODE_CLIP)
    block = F.array(u, *[F.col(f"{tag}r{k}") for k in modes])
    df = sealed(df, keep, split, **{f"{tag}ok": ok, f"{tag}block": block})
    return df, F.col(f"{tag}block"), F.lit(None).cast("double"), ok


def _hard_block(df, keep, tag, u, place, slots, split):
    """Seal the chosen value and place; build the block and its overflow from those."""
    ok = F.col(f"{tag}ok")
    df = sealed(df, keep, split, **{f"{tag}ok": ok, f"{tag}u": u, f"{tag}place": place})
    u = F.col(f"{tag}u")
    slot = pick(slots, F.col(f"{tag}place")).cast("int")
    block = F.concat(F.array(clip(u, ENCODE_CLIP)), one_hot(slot, len(slots)))
    return df, block, F.when(ok & (F.abs(u) > number(ENCODE_CLIP)), u)


def mixed_block(
    df: DataFrame,
    value: Column,
    fitted: MixedModel,
    tag: str,
    *,
    mode_choice: str = "draw",
    key: Sequence[str] = (),
    seed: int = 42,
    split: bool = False,
) -> tuple[DataFrame, Column, Column, Column]:
    """Special values take their own slot, all others the slot of their mode."""
    keep, df = df.columns, stage_value(df, value, tag)
    df = stage_choice(df, fitted.model, tag, mode_choice=mode_choice, key=key, seed=seed)
    x, u, j = (F.col(f"{tag}{part}") for part in ("x", "u", "j"))
    n_modal = len(fitted.modal)
    place = j + F.lit(n_modal)
    for position in range(n_modal - 1, -1, -1):
        here = x == number(fitted.modal[position])
        place = F.when(here, F.lit(position)).otherwise(place)
        u = F.when(here, number(fitted.values[position])).otherwise(u)
    slots = inverse_order(fitted.order)
    return (*_hard_block(df, keep, tag, u, place, slots, split), F.col(f"{tag}ok"))


def encode_continuous(
    df: DataFrame,
    column: str,
    model: MixtureModel,
    *,
    variant: str = "hard",
    mode_choice: str = "draw",
    key: Sequence[str] = (),
    seed: int = 42,
    out: str = "encoded",
) -> DataFrame:
    """Append ``out`` (array<double>); ``hard`` also appends ``overflow``."""
    staged, block, overflow, ok = continuous_block(
        df, F.col(column), model, TAG,
        variant=variant, mode_choice=mode_choice, key=key, seed=seed,
    )
    extra = [overflow.alias("overflow")] if variant == "hard" else []
    return staged.select(*df.columns, F.when(ok, block).alias(out), *extra)


def encode_mixed(
    df: DataFrame,
    column: str,
    fitted: MixedModel,
    *,
    mode_choice: str = "draw",
    key: Sequence[str] = (),
    seed: int = 42,
    out: str = "encoded",
) -> DataFrame:
    """Append ``out`` and ``overflow`` for a mixed column."""
    staged, block, overflow, ok = mixed_block(
        df, F.col(column), fitted, TAG, mode_choice=mode_choice, key=key, seed=seed
    )
    return staged.select(
        *df.columns, F.when(ok, block).alias(out), overflow.alias("overflow")
    )


def categorical_block(
    df: DataFrame, column: str, dictionary: Dictionary, tag: str, unknown: str = "error",
    labels: str = "dense",
) -> tuple[DataFrame, Column, Column, int]:
    df = index_labels(df, column, dictionary, unknown=unknown, out=f"{tag}i")
    width = dictionary.sizes[column] + (1 if unknown == "keep" else 0)
    index = F.col(f"{tag}i")
    if labels == "index":
        return df, F.array(index.cast("double")), index.isNotNull(), 1
    return df, one_hot(index, width), index.isNotNull(), width


def encode_categorical(
    df: DataFrame,
    column: str,
    dictionary: Dictionary,
    *,
    unknown: str = "error",
    out: str = "encoded",
) -> DataFrame:
    """Append the one-hot of the label's frequency rank; NULL stays NULL."""
    staged, block, ok, _ = categorical_block(df, column, dictionary, TAG, unknown)
    return staged.select(*df.columns, F.when(ok, block).alias(out))


def fill_null(block: Column, ok: Column, width: int) -> Column:
    """A block of NULL slots where the value is missing, to keep table offsets fixed."""
    return F.when(ok, block).otherwise(null_slots(width))

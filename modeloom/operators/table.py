"""Whole tables: fit every column together, encode and decode in one projection."""

from __future__ import annotations

import json
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modeloom.functions.arrays import argmax
from modeloom.operators.cells import CELLS, gathered, merged
from modeloom.operators.decode import continuous_value, mixed_value
from modeloom.operators.dictionary import Dictionary, category_dictionary, labels_of, measured
from modeloom.operators.encode import (
    MixedModel,
    categorical_block,
    continuous_block,
    continuous_width,
    fill_null,
    mixed_block,
    mixed_model,
)
from modeloom.operators.mixture import (
    MixtureModel,
    bucket_counts_models,
    fit_cells,
    fit_counts,
    model_table,
    models_from_table,
)
from modeloom.operators.order_stats import column_values, value_counts
from modeloom.spec import EPS, Categorical, Continuous, Mixed

LOG = logging.getLogger(__name__)

# What a stored model remembers of its fit.
FIT_FACTS = ("iterations", "converged", "start_settled", "gap", "order_by", "bounds")

LAYOUT_SCHEMA = (
    "col string, kind string, block int, start int, width int, activation string,"
    " min double, max double"
)


@dataclass(frozen=True)
class TableEncoder:
    """The fitted columns of a table, in output order.

    ``fitted`` maps a column to its MixtureModel, MixedModel or None (categorical).
    """

    kinds: Mapping[str, str]
    fitted: Mapping[str, MixtureModel | MixedModel | None]
    dictionary: Dictionary | None
    key: tuple[str, ...]
    seed: int = 42
    mode_choice: str = "draw"
    unknown: str = "error"
    ranges: Mapping[str, tuple] = field(default_factory=dict)
    labels: str = "dense"

    @property
    def numeric(self) -> list[str]:
        return [c for c, kind in self.kinds.items() if kind != "categorical"]

    def width(self, column: str) -> int:
        kind = self.kinds[column]
        if kind == "categorical":
            return 1 if self.labels == "index" else self.categories(column)
        if kind == "mixed":
            return self.fitted[column].width
        return continuous_width(self.fitted[column], "hard")

    def categories(self, column: str) -> int:
        """Slots of a categorical column as a dense block."""
        return self.dictionary.sizes[column] + (1 if self.unknown == "keep" else 0)

    @property
    def starts(self) -> dict[str, int]:
        out, at = {}, 0
        for column in self.kinds:
            out[column] = at
            at += self.width(column)
        return out

    @property
    def output_dim(self) -> int:
        return sum(self.width(c) for c in self.kinds)

    def layout(self, spark: SparkSession) -> DataFrame:
        """One row per output block: where it starts, how wide it is, its activation."""
        rows, block = [], 0
        for column, kind in self.kinds.items():
            start, width = self.starts[column], self.width(column)
            low, high = self.ranges.get(column, (None, None))
            if kind == "categorical":
                parts = [(start, width, "index" if self.labels == "index" else "softmax")]
            else:
                parts = [(start, 1, "tanh"), (start + 1, width - 1, "softmax")]
            for at, wide, activation in parts:
                rows.append((column, kind, block, at, wide, activation, low, high))
                block += 1
        return spark.createDataFrame(rows, LAYOUT_SCHEMA)

    def encode(self, df: DataFrame, *, out: str = "encoded") -> DataFrame:
        """Append ``out`` (all blocks in column order) and ``overflow`` (one field per
        numeric column).  A missing value leaves NULL slots in its block."""
        kept, blocks, overflows = df.columns, [], []
        for i, (column, kind) in enumerate(self.kinds.items()):
            tag = f"__enc{i}_"
            choice = {
                "mode_choice": self.mode_choice, "key": self.key, "seed": self.seed + i,
                "split": len(self.numeric) > 1,
            }
            if kind == "categorical":
                df, block, ok, _ = categorical_block(
                    df, column, self.dictionary, tag, self.unknown, self.labels
                )
            elif kind == "mixed":
                df, block, over, ok = mixed_block(df, F.col(column), self.fitted[column], tag, **choice)
                overflows.append(over.alias(column))
            else:
                df, block, over, ok = continuous_block(
                    df, F.col(column), self.fitted[column], tag, **choice
                )
                overflows.append(over.alias(column))
            blocks.append(fill_null(block, ok, self.width(column)))
        extra = [F.struct(*overflows).alias("overflow")] if overflows else []
        return df.select(*kept, F.concat(*blocks).alias(out), *extra)

    def decode(
        self, df: DataFrame, *, encoded: str = "encoded", overflow: str = "overflow",
        prefix: str = "decoded_",
    ) -> DataFrame:
        """Append one ``prefix + column`` per column, walking the blocks by offset."""
        kept, values = df.columns, []
        exact = overflow in df.columns
        for i, (column, kind) in enumerate(self.kinds.items()):
            start, name, tag = self.starts[column], prefix + column, f"__dec{i}_"
            over = F.col(overflow)[column] if exact and kind != "categorical" else None
            if kind == "categorical":
                # A slot past the dictionary, the one for unknown labels, has no label.
                block = F.slice(F.col(encoded), start + 1, self.width(column))
                best = F.get(block, 0) if self.labels == "index" else argmax(block)
                df = labels_of(df, best, self.dictionary, column, name)
                values.append(F.col(name))
                continue
            decode = mixed_value if kind == "mixed" else continuous_value
            df, value = decode(
                df, F.col(encoded), self.fitted[column], tag, start=start, overflow=over
            )
            values.append(value.alias(name))
        return df.select(*kept, *values)

    def save(self, path: str, spark: SparkSession) -> None:
        """Write the model tables below ``path``."""
        models, mixed = {}, {}
        for column, fitted in self.fitted.items():
            if isinstance(fitted, MixedModel):
                models[column] = fitted.model
                mixed[column] = {
                    "modal": fitted.modal, "values": fitted.values, "order": fitted.order,
                }
            elif fitted is not None:
                models[column] = fitted
        eps = {c: m.eps for c, m in models.items()}
        about = {
            "kinds": dict(self.kinds), "mixed": mixed, "key": self.key, "seed": self.seed,
            "mode_choice": self.mode_choice, "unknown": self.unknown, "eps": eps,
            "labels": self.labels,
            "ranges": {c: list(r) for c, r in self.ranges.items()},
            "types": dict(self.dictionary.types) if self.dictionary else {},
            "fits": {
                c: {f: getattr(m, f) for f in FIT_FACTS} for c, m in models.items()
            },
        }
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{path}/about")
        if models:
            model_table(spark, models).coalesce(1).write.mode("overwrite").parquet(
                f"{path}/mixture_params"
            )
        if self.dictionary:
            self.dictionary.table.write.mode("overwrite").parquet(f"{path}/category_dict")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> TableEncoder:
        about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
        kinds, models, dictionary = about["kinds"], {}, None
        if any(kind != "categorical" for kind in kinds.values()):
            for column, model in models_from_table(
                spark.read.parquet(f"{path}/mixture_params")
            ).items():
                models[column] = MixtureModel(
                    **{
                        **model.__dict__, "eps": about["eps"][column],
                        **about["fits"][column],
                        "bounds": tuple(about["fits"][column]["bounds"]),
                    }
                )
        fitted = {}
        for column, kind in kinds.items():
            model = models.get(column)
            if kind == "mixed":
                parts = {k: tuple(v) for k, v in about["mixed"][column].items()}
                model = MixedModel(model=model, **parts)
            fitted[column] = model
        labels = [c for c, kind in kinds.items() if kind == "categorical"]
        if labels:
            table = spark.read.parquet(f"{path}/category_dict")
            dictionary = measured(table, labels, about["types"])
        return cls(
            kinds, fitted, dictionary, tuple(about["key"]), about["seed"],
            about["mode_choice"], about["unknown"],
            {c: tuple(r) for c, r in about["ranges"].items()}, about["labels"],
        )


def _ordered(fitted: MixtureModel | MixedModel, by: str) -> MixtureModel | MixedModel:
    """The same model with the slots of a continuous column ordered by mass or hits."""
    return replace(fitted, order_by=by) if isinstance(fitted, MixtureModel) else fitted


def fit_numeric(
    df: DataFrame,
    columns: Sequence[str],
    mixed: Mapping[str, Mixed],
    *,
    method: str = "variational",
    on: str = "cells",
    limit: int = CELLS,
    combine: bool = False,
    **options,
) -> tuple[dict[str, MixtureModel | MixedModel], dict[str, tuple]]:
    """Fit all numeric columns together; returns models and (min, max).

    A mixed column is two series: all its rows, and the rows that are not special values.
    ``on``, ``limit`` and ``combine`` are as in :func:`fit_mixtures`; on cells, the series, the
    ranges and the rows of special values all come from one scan.
    """
    if method not in ("variational", "buckets"):
        raise ValueError(f"method must be 'variational' or 'buckets', not {method!r}")
    series = _series_on_cells if method == "variational" and on == "cells" else _series_on_rows
    models, ranges, rows = series(
        df, list(columns), mixed, method=method, limit=limit, combine=combine, **options
    )
    fitted = dict(zip(columns, models[: len(columns)], strict=True))
    for i, (column, spec) in enumerate(mixed.items()):
        fitted[column] = mixed_model(
            fitted[column], models[len(columns) + i], spec.modal,
            [rows.get((column, v), 0) for v in spec.modal], spec.missing,
        )
    return fitted, ranges


def _series_on_cells(df, columns, mixed, *, method, limit, combine, **options):
    """Models of all series, ranges of the columns and rows of special values, in one scan."""
    first = len(columns)
    kept = {}
    for i, (column, spec) in enumerate(mixed.items()):
        kept[first + i] = (columns.index(column), spec.modal, False)
        kept[first + len(mixed) + i] = (columns.index(column), spec.modal, True)
    limit = max([limit, *[len(s.modal) for s in mixed.values()]])
    cells = merged(gathered(df, columns, limit=limit, kept=kept), limit=limit)
    fitted = first + len(mixed)
    models = fit_cells(cells.where(F.col("c") < fitted), fitted, **options)
    wide = cells.where(F.col("c") < first).groupBy("c")
    ranges = {
        columns[r["c"]]: (r["lo"], r["hi"])
        for r in wide.agg(F.min("low").alias("lo"), F.max("high").alias("hi")).collect()
    }
    # at most one cell per declared value
    special = cells.where(F.col("c") >= fitted).select("c", "mean", "n").collect()
    names = list(mixed)
    rows = {(names[r["c"] - fitted], r["mean"]): int(r["n"]) for r in special}
    return models, ranges, rows


def _series_on_rows(df, columns, mixed, *, method, limit, combine, **options):
    """The same from packed rows, which every pass reads."""
    values = (value_counts if combine else column_values)(df, columns)
    both = values
    for i, (column, spec) in enumerate(mixed.items()):
        rest = values.where(
            (F.col("c") == F.lit(columns.index(column))) & ~F.col("x").isin(*spec.modal)
        )
        both = both.unionByName(rest.withColumn("c", F.lit(len(columns) + i)))
    fit = {"variational": fit_counts, "buckets": bucket_counts_models}[method]
    models = fit(both, len(columns) + len(mixed), **options)
    wide = values.groupBy("c").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    ranges = {columns[r["c"]]: (r["lo"], r["hi"]) for r in wide.collect()}
    if not mixed:
        return models, ranges, {}
    special = reduce(
        lambda a, b: a | b,
        [(F.col("c") == columns.index(m)) & F.col("x").isin(*s.modal) for m, s in mixed.items()],
    )
    weight = F.sum("w") if combine else F.count(F.lit(1))
    # at most one line per declared value
    lines = values.where(special).groupBy("c", "x").agg(weight.alias("w")).collect()
    return models, ranges, {(columns[r["c"]], r["x"]): r["w"] for r in lines}


def fit_table(
    df: DataFrame,
    spec: Mapping[str, Continuous | Mixed | Categorical],
    *,
    key: Sequence[str] = (),
    seed: int = 42,
    mode_choice: str = "draw",
    unknown: str = "error",
    eps: float = EPS,
    categories: str = "dense",
    **options,
) -> TableEncoder:
    """Fit every column of ``spec``: one scan for the numeric, one for the categorical.

    ``categories="index"`` stores a categorical column as its dictionary index in one slot,
    so that a row's size does not follow the number of labels; ``"dense"`` as one slot per
    label.  ``options`` go to the mixture fit (``method``, ``max_iter``, ``tol``, ...).
    """
    if categories not in ("dense", "index"):
        raise ValueError(f"categories must be 'dense' or 'index', not {categories!r}")
    absent = [c for c in spec if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    kinds = {c: type(s).__name__.lower() for c, s in spec.items()}
    numeric = [c for c, kind in kinds.items() if kind != "categorical"]
    labels = [c for c, kind in kinds.items() if kind == "categorical"]
    fitted: dict = {c: None for c in kinds}
    ranges: dict = {}
    if numeric:
        mixed = {c: spec[c] for c in numeric if kinds[c] == "mixed"}
        models, ranges = fit_numeric(df, numeric, mixed, eps=eps, **options)
        by = "mass" if mode_choice == "draw" else "hits"
        fitted.update({c: _ordered(m, by) for c, m in models.items()})
        for column, model in models.items():
            mixture = model.model if isinstance(model, MixedModel) else model
            if not mixture.converged:
                LOG.warning(
                    "%s: the fit has not converged after %d passes", column, mixture.iterations
                )
    dictionary = category_dictionary(df, labels) if labels else None
    return TableEncoder(
        kinds, fitted, dictionary, tuple(key), seed, mode_choice, unknown, ranges, categories
    )

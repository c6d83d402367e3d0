"""Dirichlet-process Gaussian mixtures fitted by distributed variational EM.

The model is the truncated stick-breaking mixture (Blei & Jordan 2006; Attias 2000).
By default the table is scanned once, into a bounded summary of every column
(:mod:`modeloom.operators.cells`), and each column's passes run over its cells in one task.
The other way is a pass of Spark over all rows: every task reduces its rows to a few sums
per mode, Spark adds those up, and the driver updates K-sized parameters; all columns
share each pass over the packed, persisted columns, and a lost block is read again from
the source.  Between them, distinct values are counted by one scan, and every pass goes over
all of them, in one task up to :data:`ONE_TASK` of a column.  Passes are extrapolated unless
plain ones are asked for, so that a fit comes to rest in tens of passes where plain updates
take hundreds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modeloom.functions.special import digamma, log_gamma
from modeloom.operators.cells import CELLS, value_cells
from modeloom.operators.order_stats import (
    block_moments,
    block_order_statistics,
    column_values,
    value_blocks,
    value_counts,
)
from modeloom.operators.sampling import hash_sample
from modeloom.spec import EPS, MAX_ITER, N_COMPONENTS, WEIGHT_PRIOR

# The priors on mean precision, degrees of freedom and spread.
MEAN_PRECISION_PRIOR = 1.0
DOF_PRIOR = 1.0
COVARIANCE_FLOOR = 1e-6

DECILES = tuple(range(100, 1000, 100))
# Rounds after which the k-means start is taken as it is.
KMEANS_ROUNDS = 300
# Distinct values of a column that one task fits; a pass over them takes about as long as a job.
ONE_TASK = 1 << 20
# Values worked on at a time, so that their terms stay in a core's cache.
BLOCK = 1 << 13
# The longest extrapolation at first, and the factor by which the limit grows.
STEP_LIMIT = 4.0
STEP_GROWTH = 4.0

# What a pass adds up for every mode; the log normaliser is one number, kept in the first.
SUMS = ("n", "s1", "s2", "hits", "log_norm")

PARAM_SCHEMA = (
    "col string, k int, weight double, mean double, std double, log_c double,"
    " half_prec double, mass double, hits long, active boolean, rank int"
)


@dataclass(frozen=True)
class MixtureModel:
    """K-sized parameters of one fitted column.

    Mode k has log density term ``log_c - half_prec * (x - mean)^2`` including its
    log weight.  ``mass`` is its summed posterior and ``hits`` the rows it wins.  Slots are
    ordered by mass where modes are drawn, and by hits where the likeliest is taken.  ``gap``
    bounds, per row, how far the bound over all rows may lie above the last of ``bounds``.
    """

    weight: tuple[float, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    log_c: tuple[float, ...]
    half_prec: tuple[float, ...]
    mass: tuple[float, ...]
    hits: tuple[int, ...]
    eps: float = EPS
    iterations: int = 0
    converged: bool = True
    start_settled: bool = True
    gap: float = 0.0
    order_by: str = "mass"
    bounds: tuple[float, ...] = field(default=(), repr=False)

    @property
    def size(self) -> int:
        return len(self.mean)

    @property
    def active(self) -> list[int]:
        """Modes with a weight above eps that win at least one row."""
        return [k for k in range(self.size) if self.weight[k] > self.eps and self.hits[k] > 0]

    @property
    def heavy(self) -> list[int]:
        """Modes with a weight above eps, used or not."""
        return [k for k in range(self.size) if self.weight[k] > self.eps]

    @property
    def order(self) -> list[int]:
        """Active modes by falling ``order_by`` (mass, or hits), the lower mode first on ties."""
        size = self.mass if self.order_by == "mass" else self.hits
        return sorted(self.active, key=lambda k: (-size[k], k))

    def rows(self, name: str) -> list[tuple]:
        active, order = set(self.active), self.order
        return [
            (
                name, k, self.weight[k], self.mean[k], self.std[k], self.log_c[k],
                self.half_prec[k], self.mass[k], self.hits[k], k in active,
                order.index(k) if k in active else None,
            )
            for k in range(self.size)
        ]


def model_table(spark: SparkSession, models: Mapping[str, MixtureModel]) -> DataFrame:
    """``mixture_params``: one row per column and mode."""
    rows = [row for name, model in models.items() for row in model.rows(name)]
    return spark.createDataFrame(rows, PARAM_SCHEMA)


def models_from_table(params: DataFrame, eps: float = EPS) -> dict[str, MixtureModel]:
    """Read back ``mixture_params``; it holds K rows per column."""
    by_column: dict[str, list] = {}
    for row in params.orderBy("col", "k").collect():
        by_column.setdefault(row["col"], []).append(row)
    parts = ("weight", "mean", "std", "log_c", "half_prec", "mass", "hits")
    return {
        name: MixtureModel(**{p: tuple(r[p] for r in rows) for p in parts}, eps=eps)
        for name, rows in by_column.items()
    }


def mode_sums(
    blocks: DataFrame, kernels: Mapping[int, dict]
) -> dict[int, dict[str, np.ndarray]]:
    """One pass over the packed values: per mode the count, centred first and second
    sums and the rows it wins, plus the summed log normaliser.

    A kernel either assigns by cut points (``cuts``) or softly (``c``, ``h``, ``m``);
    sums are taken around ``m``, which keeps tight modes far from zero accurate.
    """
    kernels = {int(c): k for c, k in kernels.items()}

    def reduce_partition(batches):
        import numpy as np
        import pyarrow as pa

        sums = {}
        for batch in batches:
            for c, x, w in zip(*(batch.column(i).to_pylist() for i in range(3))):
                kernel = kernels[c]
                x = np.frombuffer(x, "<f8")
                w = np.frombuffer(w, "<f8") if w else np.ones(len(x))
                z = (x - kernel["shift"]) / kernel["scale"]
                centre = kernel["m"]
                away = z[:, None] - centre
                if "cuts" in kernel:
                    winner = np.searchsorted(kernel["cuts"], x, side="left")
                    share = np.zeros(away.shape)
                    share[np.arange(len(z)), winner] = 1.0
                    log_norm = 0.0
                else:
                    terms = kernel["c"] - kernel["h"] * away**2
                    top = terms.max(axis=1)
                    share = np.exp(terms - top[:, None])
                    norm = share.sum(axis=1)
                    share /= norm[:, None]
                    winner = terms.argmax(axis=1)
                    log_norm = float(w @ (top + np.log(norm)))
                share *= w[:, None]
                size = len(centre)
                total = sums.setdefault(c, np.zeros((5, size)))
                total[0] += share.sum(axis=0)
                total[1] += (share * away).sum(axis=0)
                total[2] += (share * away**2).sum(axis=0)
                total[3] += np.bincount(winner, weights=w, minlength=size)
                total[4, 0] += log_norm
        for c, total in sums.items():
            size = total.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * size, pa.int32()), pa.array(range(size), pa.int32())]
                + [pa.array(part) for part in total],
                names=["c", "k", "n", "s1", "s2", "hits", "log_norm"],
            )

    parts = SUMS
    partial = blocks.where(F.col("c").isin(*kernels)).mapInArrow(
        reduce_partition,
        "c int, k int, n double, s1 double, s2 double, hits double, log_norm double",
    )
    partial = partial.groupBy("c", "k").agg(*[F.sum(p).alias(p) for p in parts])
    out = {}
    for c, kernel in kernels.items():
        out[c] = {p: np.zeros(len(kernel["m"])) for p in parts}
    for row in partial.collect():
        for p in parts:
            out[row["c"]][p][row["k"]] += row[p]
    return out


def counted_sums(x: np.ndarray, w: np.ndarray, kernel: Mapping) -> np.ndarray:
    """The sums of :func:`mode_sums` over counted values: rows n, s1, s2, hits and log_norm.

    Modes are rows and values columns, a block at a time.  The rows a mode wins are counted
    only where the kernel asks for ``hits``, which no update needs.
    """
    shift, scale, centre = kernel["shift"], kernel["scale"], kernel["m"]
    size = len(centre)
    total = np.zeros((5, size))
    if "cuts" in kernel:
        winner = np.searchsorted(kernel["cuts"], x, side="left")
        away = (x - shift) / scale - centre[winner]
        for i, part in enumerate((w, w * away, w * away**2, w)):
            total[i] = np.bincount(winner, part, size)
        return total
    centre, const, fall = centre[:, None], kernel["c"][:, None], -kernel["h"][:, None]
    step = -(-len(x) // -(-len(x) // BLOCK))
    held = np.empty((2, size, step))
    for at in range(0, len(x), step):
        z, weight = (x[at : at + step] - shift) / scale, w[at : at + step]
        away, share = held[0, :, : len(z)], held[1, :, : len(z)]
        np.subtract(z, centre, out=away)
        np.multiply(away, away, out=share)
        share *= fall
        share += const
        top = share.max(axis=0)
        if kernel.get("hits"):
            total[3] += np.bincount(share.argmax(axis=0), weight, size)
        share -= top
        np.exp(share, out=share)
        norm = share.sum(axis=0)
        total[4, 0] += weight @ (top + np.log(norm))
        share *= weight / norm
        total[0] += share.sum(axis=1)
        share *= away
        total[1] += share.sum(axis=1)
        share *= away
        total[2] += share.sum(axis=1)
    return total


def sufficient_statistics(df: DataFrame, column: str, model: MixtureModel) -> DataFrame:
    """(k, n, sum_x, sum_xx) of the posterior-weighted values: what one pass of a fit adds up."""
    kernel = {
        "shift": 0.0, "scale": 1.0, "m": np.array(model.mean),
        "c": np.array(model.log_c), "h": np.array(model.half_prec),
    }
    sums = mode_sums(value_blocks(column_values(df, [column])), {0: kernel})[0]
    n, s1, s2 = sums["n"], sums["s1"], sums["s2"]
    m = kernel["m"]
    rows = zip(
        range(model.size),
        n.tolist(),
        (s1 + n * m).tolist(),
        (s2 + 2 * m * s1 + n * m**2).tolist(),
        strict=True,
    )
    return df.sparkSession.createDataFrame(
        list(rows), "k int, n double, sum_x double, sum_xx double"
    )


@dataclass
class _Posterior:
    """Variational parameters of one column, on the standardised scale."""

    a: np.ndarray
    b: np.ndarray
    beta: np.ndarray
    m: np.ndarray
    nu: np.ndarray
    var: np.ndarray

    @classmethod
    def update(cls, sums, centre, prior_var, floor, alpha):
        n = sums["n"]
        safe = np.maximum(n, np.finfo(float).tiny)
        shift = sums["s1"] / safe
        average = np.where(n > 0, centre + shift, 0.0)
        spread = np.maximum(sums["s2"] / safe - shift**2, 0.0) + floor
        later = np.concatenate([np.cumsum(n[::-1])[-2::-1], [0.0]]) if len(n) > 1 else np.zeros(1)
        beta = MEAN_PRECISION_PRIOR + n
        nu = DOF_PRIOR + n
        pull = n * MEAN_PRECISION_PRIOR / beta * average**2
        return cls(
            a=1.0 + n,
            b=alpha + later,
            beta=beta,
            m=n * average / beta,
            nu=nu,
            var=(prior_var + n * spread + pull) / nu,
        )

    def expected_log_weights(self):
        total = digamma(self.a + self.b)
        tail = digamma(self.b) - total
        return digamma(self.a) - total + np.concatenate([[0.0], np.cumsum(tail)[:-1]])

    def log_constants(self):
        return (
            self.expected_log_weights()
            + 0.5 * (digamma(self.nu / 2) + math.log(2) - np.log(self.nu) - np.log(self.var))
            - 0.5 * math.log(2 * math.pi)
            - 0.5 / self.beta
        )

    def weights(self):
        stick = self.a / (self.a + self.b)
        left = np.concatenate([[1.0], np.cumprod(self.b / (self.a + self.b))[:-1]])
        weight = stick * left
        return weight / weight.sum()

    def kernel(self, shift, scale):
        return {
            "shift": shift, "scale": scale, "m": self.m,
            "c": self.log_constants(), "h": 0.5 / self.var,
        }

    def bound(self, sums, kernel):
        """Lower bound up to a constant, from the sums this update came from."""
        entropy = sums["log_norm"].sum() - float(
            (kernel["c"] * sums["n"] - kernel["h"] * sums["s2"]).sum()
        )
        half_log_det = -0.5 * np.log(self.var) - 0.5 * np.log(self.nu)
        wishart = -(self.nu * half_log_det + self.nu * 0.5 * math.log(2) + log_gamma(self.nu / 2))
        sticks = log_gamma(self.a) + log_gamma(self.b) - log_gamma(self.a + self.b)
        return entropy - wishart.sum() + sticks.sum() - 0.5 * np.log(self.beta).sum()


def _cut_ranks(rows: int, cuts: Sequence[int]) -> list[int]:
    return [max(1, -(-rows * per_mille // 1000)) for per_mille in cuts]


class _Blocks:
    """All rows, packed and kept: every pass reads them."""

    def __init__(self, counts: DataFrame):
        self.blocks = value_blocks(counts).persist(StorageLevel.MEMORY_AND_DISK)
        self.stats = block_moments(self.blocks)

    def sums(self, kernels: Mapping[int, dict]) -> dict[int, dict[str, np.ndarray]]:
        return mode_sums(self.blocks, kernels)

    def cuts(self, per_mille: Sequence[int]) -> dict[int, np.ndarray]:
        ranks = {c: _cut_ranks(s["rows"], per_mille) for c, s in self.stats.items()}
        found = block_order_statistics(self.blocks, ranks)
        return {c: np.array([found[(c, r)] for r in wanted]) for c, wanted in ranks.items()}

    def close(self) -> None:
        self.blocks.unpersist()


class _SpreadValues(_Blocks):
    """Counted values dealt to as many tasks as run at once: a pass is one job of one stage.

    Passes are short and many, so they run on an RDD, which spares each a query's planning.
    """

    def __init__(self, counts: DataFrame, size: int):
        at_once = counts.sparkSession.sparkContext.defaultParallelism
        dealt = counts.repartition(max(at_once, -(-size // ONE_TASK)), "c", "x")
        # in order, so that a pass adds up the same numbers in every run
        super().__init__(dealt.sortWithinPartitions("c", "x"))
        self.rows = None

    def sums(self, kernels: Mapping[int, dict]) -> dict[int, dict[str, np.ndarray]]:
        kernels = {int(c): k for c, k in kernels.items()}
        if self.rows is None:
            self.rows = self.blocks.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
            self.rows.count()
            self.blocks.unpersist()

        def work(blocks):
            found = {}
            for c, x, w in blocks:
                if c in kernels:
                    x, w = np.frombuffer(x, "<f8"), np.frombuffer(w, "<f8")
                    found[c] = found.get(c, 0.0) + counted_sums(x, w, kernels[c])
            return list(found.items())

        out = {c: np.zeros((len(SUMS), len(k["m"]))) for c, k in kernels.items()}
        for c, total in self.rows.mapPartitions(work).collect():  # a few numbers per task and mode
            out[c] += total
        return {c: dict(zip(SUMS, total, strict=True)) for c, total in out.items()}

    def close(self) -> None:
        super().close()
        if self.rows is not None:
            self.rows.unpersist()


def _cut_kernels(data, per_mille: Sequence[int]) -> dict[int, dict]:
    """Hard assignment by order statistics at the given per-mille ranks."""
    kernels = {}
    for c, cuts in data.cuts(per_mille).items():
        mean, scale = data.stats[c]["mean"], math.sqrt(data.stats[c]["var"]) or 1.0
        edges = (cuts - mean) / scale
        kernels[c] = {
            "shift": mean, "scale": scale, "cuts": cuts,
            "m": np.concatenate([edges, edges[-1:]]) if len(cuts) else np.zeros(1),
        }
    return _centred(kernels, data.sums(kernels))


def _centred(kernels, sums):
    """Move every centre to the mean of its rows, so that spreads do not cancel."""
    for c, kernel in kernels.items():
        n = sums[c]["n"]
        kernel["m"] = kernel["m"] + sums[c]["s1"] / np.maximum(n, 1)
    return kernels


def _lloyd(data, kernels, rounds, tol=1e-4):
    """Move the cut points to the 1-D k-means solution next to them; and whether they
    came to rest within ``rounds``."""
    for _ in range(rounds):
        moved = 0.0
        sums = data.sums(kernels)
        for c, kernel in _centred(kernels, sums).items():
            n = sums[c]["n"]
            held = np.sort(kernel["m"][n > 0])
            middle = (held[1:] + held[:-1]) / 2 * kernel["scale"] + kernel["shift"]
            # Unused modes keep an edge above every value, so they stay last and empty.
            spare = len(n) - len(held)
            cuts = np.concatenate([middle, np.full(spare, np.inf)])
            fresh = np.concatenate([held, np.full(spare, held[-1])])
            moved = max(moved, float(((fresh - kernel.get("last", np.inf)) ** 2).sum()))
            kernel.update(cuts=cuts, m=fresh, last=fresh)
        if moved <= tol:
            return kernels, True
    return kernels, False


class _Ascent:
    """The passes of one column: plain updates, and squared extrapolation between them.

    A cycle is two plain updates and one from the point they lead to when their change is
    carried on (Varadhan & Roland 2008, second step length).  The coordinates are the square
    roots of the shares, the means and the log variances, so every point is a proper
    posterior.  The third update stays only where the bound does not fall; else the cycle is
    two plain updates.  Steps are bounded, and the limit grows as long as it is reached.
    """

    def __init__(self, rows, kernel, sums, *, alpha, tol, accelerate):
        self.rows, self.alpha, self.tol, self.accelerate = rows, alpha, tol, accelerate
        self.shift, self.scale, var = kernel["shift"], kernel["scale"], kernel["var"]
        self.floor = COVARIANCE_FLOOR / self.scale**2
        self.prior = max(var / self.scale**2, self.floor)
        self.state = self._update(sums, kernel)
        self.trial: _Posterior | None = None
        self.path: list[np.ndarray] = []
        self.bounds: list[float] = []
        self.passes = self.refused = 0
        self.longest, self.at_limit = STEP_LIMIT, False
        self.converged = False

    def _update(self, sums, kernel) -> _Posterior:
        return _Posterior.update(sums, kernel["m"], self.prior, self.floor, self.alpha)

    def kernel(self) -> dict:
        return (self.trial or self.state).kernel(self.shift, self.scale)

    def take(self, sums, kernel) -> None:
        """One pass under :meth:`kernel` was made."""
        self.passes += 1
        fresh = self._update(sums, kernel)
        bound = fresh.bound(sums, kernel) / self.rows
        if self.trial is not None:
            self.trial = None
            if bound >= self.bounds[-1]:
                self.bounds.append(bound)
                self.state = fresh
            else:
                self.refused += 1
                if self.at_limit:
                    self.longest = max(STEP_LIMIT, self.longest / STEP_GROWTH**2)
            self.path = [self._point(self.state)]
            return
        self.converged = bool(self.bounds) and abs(bound - self.bounds[-1]) < self.tol
        self.bounds.append(bound)
        self.state = fresh
        self.path.append(self._point(fresh))
        if self.accelerate and len(self.path) == 3:
            self.trial = self._carried_on()

    def _point(self, state: _Posterior) -> np.ndarray:
        share = (state.a - 1.0) / self.rows
        return np.concatenate([np.sqrt(share), state.m, np.log(state.var)])

    def _carried_on(self) -> _Posterior:
        first, second, third = self.path
        step = second - first
        turn = third - second - step
        size = float(turn @ turn)
        length = abs(float(step @ turn)) / size if size > 0 else 1.0
        length = max(1.0, min(length, self.longest))
        self.at_limit = length == self.longest
        if self.at_limit:
            self.longest *= STEP_GROWTH
        share, m, log_var = np.split(first + 2 * length * step + length**2 * turn, 3)
        n = np.maximum(share, 0.0) ** 2
        n = n * (self.rows / n.sum()) if n.sum() > 0 else self.state.a - 1.0
        later = np.concatenate([np.cumsum(n[::-1])[-2::-1], [0.0]]) if len(n) > 1 else np.zeros(1)
        var = np.exp(np.clip(log_var, math.log(self.floor) - 1, 50.0))
        return _Posterior(a=1 + n, b=self.alpha + later, beta=1 + n, m=m, nu=1 + n, var=var)


def _fit(
    data,
    *,
    n_components: int = N_COMPONENTS,
    eps: float = EPS,
    weight_prior: float = WEIGHT_PRIOR,
    max_iter: int = MAX_ITER,
    tol: float = 1e-6,
    init: str = "quantile",
    kmeans_rounds: int = KMEANS_ROUNDS,
    accelerate: bool = True,
) -> dict[int, MixtureModel]:
    """Fit every column of ``data`` (rows or cells); columns share each pass.

    Stops a column when its bound moves by less than ``tol`` per row in a plain update.  A
    k-means start that has not come to rest after ``kmeans_rounds`` leaves ``start_settled``
    False, a fit that has not stopped after ``max_iter`` passes ``converged``.
    """
    if init not in ("quantile", "kmeans"):
        raise ValueError(f"init must be 'quantile' or 'kmeans', not {init!r}")
    per_mille = [round(1000 * i / n_components) for i in range(1, n_components)]
    start, settled = _cut_kernels(data, per_mille), True
    if init == "kmeans":
        start, settled = _lloyd(data, start, kmeans_rounds)
    fits = {
        c: _Ascent(
            data.stats[c]["rows"], start[c] | {"var": data.stats[c]["var"]}, sums,
            alpha=weight_prior, tol=tol, accelerate=accelerate,
        )
        for c, sums in data.sums(start).items()
    }
    for _ in range(max_iter):
        kernels = {c: fit.kernel() for c, fit in fits.items() if not fit.converged}
        if not kernels:
            break
        for c, sums in data.sums(kernels).items():
            fits[c].take(sums, kernels[c])

    # A last pass under the final parameters gives mass and use of every mode.
    kernels = {
        c: fit.state.kernel(fit.shift, fit.scale) | {"hits": True} for c, fit in fits.items()
    }
    final = data.sums(kernels)
    models = {}
    for c, fit in fits.items():
        kernel, scale = kernels[c], fit.scale
        models[c] = MixtureModel(
            weight=tuple(fit.state.weights().tolist()),
            mean=tuple((kernel["m"] * scale + kernel["shift"]).tolist()),
            std=tuple((np.sqrt(fit.state.var) * scale).tolist()),
            log_c=tuple((kernel["c"] - math.log(scale)).tolist()),
            half_prec=tuple((kernel["h"] / scale**2).tolist()),
            mass=tuple(final[c]["n"].tolist()),
            hits=tuple(int(round(v)) for v in final[c]["hits"]),
            eps=eps,
            iterations=fit.passes,
            converged=fit.converged,
            start_settled=settled,
            bounds=tuple(fit.bounds),
            gap=float(final[c]["gap"]) / data.stats[c]["rows"] if "gap" in final[c] else 0.0,
        )
    return models


def _missing(found, n_series: int) -> None:
    missing = [c for c in range(n_series) if c not in found]
    if missing:
        raise ValueError(f"no usable value in column number {missing}")


def fit_counts(counts: DataFrame, n_series: int, **options) -> list[MixtureModel]:
    """Fit every column of values ``(c, x)`` or counts ``(c, x, w)``; each pass reads all rows.

    ``options`` are those of :func:`fit_mixtures` that concern the fit itself.
    """
    data = _Blocks(counts)
    try:
        _missing(data.stats, n_series)
        models = _fit(data, **options)
    finally:
        data.close()
    return [models[c] for c in range(n_series)]


class _Cells:
    """One column's cells (see :mod:`modeloom.operators.cells`) in the arrays of one task.

    All rows of a cell share one posterior, taken at the cell's mean and spread (Kurihara,
    Welling & Vlassis 2006): the bound stays a lower bound of the bound over all rows, and
    their difference is at most ``gap``.
    """

    def __init__(self, n, mean, m2, low, high):
        order = np.argsort(high, kind="stable")
        self.n, self.mean, self.m2 = n[order], mean[order], m2[order]
        self.low, self.high = low[order], high[order]
        rows = float(self.n.sum())
        centre = float(np.clip(self.n @ self.mean / rows, self.low.min(), self.high.max()))
        ss = float(self.m2.sum() + self.n @ (self.mean - centre) ** 2)
        self.rows = int(round(rows))
        self.stats = {
            0: {"rows": self.rows, "mean": centre, "var": ss / (rows - 1) if rows > 1 else 0.0}
        }

    def cuts(self, per_mille: Sequence[int]) -> dict[int, np.ndarray]:
        at = np.searchsorted(np.cumsum(self.n), _cut_ranks(self.rows, per_mille))
        return {0: self.high[np.minimum(at, len(self.high) - 1)]}

    def sums(self, kernels: Mapping[int, dict]) -> dict[int, dict[str, np.ndarray]]:
        out = {}
        for c, kernel in kernels.items():
            z = (self.mean - kernel["shift"]) / kernel["scale"]
            inside = self.m2 / kernel["scale"] ** 2
            away = z[:, None] - kernel["m"]
            weight = self.n
            found = {"gap": 0.0}
            if "cuts" in kernel:
                winner = np.searchsorted(kernel["cuts"], self.high, side="left")
                share = np.zeros(away.shape)
                share[np.arange(len(z)), winner] = 1.0
                log_norm = 0.0
            else:
                squares = away**2 + (inside / weight)[:, None]
                terms = kernel["c"] - kernel["h"] * squares
                top = terms.max(axis=1)
                share = np.exp(terms - top[:, None])
                norm = share.sum(axis=1)
                share /= norm[:, None]
                winner = terms.argmax(axis=1)
                # to the last digit: summaries are compared by their bounds
                log_norm = math.fsum((weight * (top + np.log(norm))).tolist())
                # how far a row's terms may lie from its cell's: exp(g) - 1 - g <= g^2 exp(|g|) / 2
                reach = (
                    np.maximum(self.high - self.mean, self.mean - self.low) / kernel["scale"]
                )[:, None]
                wide = np.flatnonzero(reach[:, 0] > 0)
                g = kernel["h"] * reach[wide] * (2 * np.abs(away[wide]) + reach[wide])
                with np.errstate(over="ignore"):
                    most = np.minimum(share[wide] * g**2 * np.exp(np.minimum(g, 700.0)) / 2, 1e300)
                found["gap"] = float(weight[wide] @ most.sum(axis=1)) if len(wide) else 0.0
            size = len(kernel["m"])
            found |= {
                "n": weight @ share,
                "s1": (weight[:, None] * share * away).sum(axis=0),
                "s2": (weight[:, None] * share * away**2 + inside[:, None] * share).sum(axis=0),
                "hits": np.bincount(winner, weights=weight, minlength=size),
                "log_norm": np.array([log_norm]),
            }
            out[c] = found
        return out


class _Values:
    """One column's counted values in the arrays of one task."""

    def __init__(self, x, w):
        order = np.argsort(x, kind="stable")
        self.x, self.w = x[order], w[order].astype(float)
        rows = float(self.w.sum())
        centre = float(np.clip(self.w @ self.x / rows, self.x[0], self.x[-1]))
        ss = float(self.w @ (self.x - centre) ** 2)
        self.rows = int(round(rows))
        self.stats = {
            0: {"rows": self.rows, "mean": centre, "var": ss / (rows - 1) if rows > 1 else 0.0}
        }

    def cuts(self, per_mille: Sequence[int]) -> dict[int, np.ndarray]:
        at = np.searchsorted(np.cumsum(self.w), _cut_ranks(self.rows, per_mille))
        return {0: self.x[np.minimum(at, len(self.x) - 1)]}

    def sums(self, kernels: Mapping[int, dict]) -> dict[int, dict[str, np.ndarray]]:
        return {
            c: dict(zip(SUMS, counted_sums(self.x, self.w, kernel), strict=True))
            for c, kernel in kernels.items()
        }


MODEL_ARRAYS = ("weight", "mean", "std", "log_c", "half_prec", "mass", "bounds")


def fit_cells(cells: DataFrame, n_series: int, **options) -> list[MixtureModel]:
    """Fit every column of a summary (see :mod:`modeloom.operators.cells`), one task a column.

    A column's cells are bounded in number, so all passes run over arrays in its task; where
    its distinct values are no more than that, the result is that of a fit over all rows.
    """
    rows = cells.select("c", "n", "mean", "m2", "low", "high")
    found = _fit_in_tasks(rows, _Cells, **options)
    _missing(found, n_series)
    return [found[c] for c in range(n_series)]


def _fit_in_tasks(rows: DataFrame, kind: type, **options) -> dict[int, MixtureModel]:
    """Fit every column ``c``, one task a column, on a ``kind`` made of the other ``rows``."""
    names = [n for n in rows.columns if n != "c"]

    def work(table):
        import pyarrow as pa

        model = _fit(kind(*(table.column(n).to_numpy() for n in names)), **options)[0]
        row = {"c": pa.array([table.column("c")[0].as_py()], pa.int32())}
        for name in MODEL_ARRAYS:
            row[name] = pa.array([list(getattr(model, name))], pa.list_(pa.float64()))
        row["hits"] = pa.array([list(model.hits)], pa.list_(pa.int64()))
        for name in ("iterations", "converged", "start_settled", "gap"):
            row[name] = pa.array([getattr(model, name)])
        return pa.table(row)

    schema = ", ".join(["c int", *[f"{n} array<double>" for n in MODEL_ARRAYS], "hits array<long>"])
    schema += ", iterations long, converged boolean, start_settled boolean, gap double"
    models = {}
    # a few numbers per column and mode
    for row in rows.groupBy("c").applyInArrow(work, schema).collect():
        arrays = {n: tuple(row[n]) for n in (*MODEL_ARRAYS, "hits")}
        facts = {n: row[n] for n in ("iterations", "converged", "start_settled", "gap")}
        models[row["c"]] = MixtureModel(**arrays, **facts, eps=options.get("eps", EPS))
    return models


def fit_mixtures(
    df: DataFrame,
    columns: Sequence[str],
    *,
    sample_fraction: float | None = None,
    key: Sequence[str] = (),
    seed: int = 42,
    on: str = "cells",
    limit: int | None = None,
    combine: bool = False,
    **options,
) -> dict[str, MixtureModel]:
    """Fit one mixture per numeric column, on all rows unless a fraction is asked for.

    ``on="cells"`` scans the table once, into at most ``limit`` (32,768) cells a column, and fits
    those; ``gap`` of a model bounds what the bound per row loses by it, and is 0 where a column
    has no more distinct values.  ``on="rows"`` reads all rows in every pass; ``combine`` counts
    equal values first, by one shuffle.  ``on="values"`` is never short of a value: they are
    counted by one scan, and every pass goes over all of them, in one task for a column of at
    most ``limit`` (:data:`ONE_TASK`) and in all tasks for others.  With ``key`` the sample is
    drawn by hash and is the same on every run.  ``options``: ``n_components``, ``eps``, ``weight_prior``, ``max_iter``, ``tol``,
    ``init`` (``"quantile"`` or ``"kmeans"``), ``kmeans_rounds``, ``accelerate``.
    """
    if on not in ("cells", "values", "rows"):
        raise ValueError(f"on must be 'cells', 'values' or 'rows', not {on!r}")
    if sample_fraction is not None and sample_fraction < 1:
        df = hash_sample(df, sample_fraction, key, seed) if key else df.sample(False, sample_fraction, seed)
    if on == "cells":
        cells = value_cells(df, columns, limit=CELLS if limit is None else limit)
        models = fit_cells(cells, len(columns), **options)
    elif on == "values":
        models = _fit_values(df, columns, ONE_TASK if limit is None else limit, **options)
    else:
        values = (value_counts if combine else column_values)(df, columns)
        models = fit_counts(values, len(columns), **options)
    return dict(zip(columns, models, strict=True))


def _fit_values(df: DataFrame, columns: Sequence[str], limit: int, **options) -> list[MixtureModel]:
    """Columns of at most ``limit`` distinct values in one task each, others in all tasks."""
    counts = value_counts(df, columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {r["c"]: r["n"] for r in counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
        _missing(sizes, len(columns))
        wide = [c for c, n in sizes.items() if n > limit]
        found = {}
        if len(wide) < len(columns):
            narrow = counts if not wide else counts.where(~F.col("c").isin(*wide))
            found |= _fit_in_tasks(narrow, _Values, **options)
        if wide:
            data = _SpreadValues(counts.where(F.col("c").isin(*wide)), sum(sizes[c] for c in wide))
            counts.unpersist()
            try:
                found |= _fit(data, **options)
            finally:
                data.close()
    finally:
        counts.unpersist()
    return [found[c] for c in range(len(columns))]


def bucket_counts_models(
    counts: DataFrame,
    n_series: int,
    *,
    cuts: Sequence[int] = DECILES,
    std_floor: float = 1e-3,
    eps: float = EPS,
) -> list[MixtureModel]:
    """Plain Gaussian mixtures with one mode per quantile bucket, no iteration.

    ``cuts`` are per-mille ranks; a value equal to a cut belongs to the bucket below.
    """
    data = _Blocks(counts)
    stats = data.stats
    if len(stats) < n_series:
        data.close()
        _missing(stats, n_series)
    hard = _cut_kernels(data, cuts)
    shapes, soft = {}, {}
    for c, sums in data.sums(hard).items():
        n, kernel = sums["n"], hard[c]
        safe = np.maximum(n, 1)
        centre = kernel["m"] + sums["s1"] / safe
        var = np.maximum(sums["s2"] / safe - (sums["s1"] / safe) ** 2, 0.0)
        scale = kernel["scale"]
        std = np.maximum(np.sqrt(var) * scale, std_floor)
        weight = n / stats[c]["rows"]
        with np.errstate(divide="ignore"):
            log_c = np.log(weight) - 0.5 * math.log(2 * math.pi) - np.log(std)
        shapes[c] = (weight, centre * scale + kernel["shift"], std, log_c)
        soft[c] = {
            "shift": kernel["shift"], "scale": scale, "m": centre,
            "c": log_c + math.log(scale), "h": 0.5 / (std / scale) ** 2,
        }
    final = data.sums(soft)
    data.close()
    models = []
    for c in range(n_series):
        weight, mean, std, log_c = shapes[c]
        models.append(
            MixtureModel(
                weight=tuple(weight.tolist()),
                mean=tuple(mean.tolist()),
                std=tuple(std.tolist()),
                log_c=tuple(log_c.tolist()),
                half_prec=tuple((0.5 / std**2).tolist()),
                mass=tuple(final[c]["n"].tolist()),
                hits=tuple(int(round(v)) for v in final[c]["hits"]),
                eps=eps,
            )
        )
    return models


def bucket_models(df: DataFrame, columns: Sequence[str | Column], **options) -> list[MixtureModel]:
    """:func:`bucket_counts_models` straight from a table."""
    return bucket_counts_models(column_values(df, columns), len(columns), **options)

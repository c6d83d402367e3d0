"""Fits on every value: few jobs where one task holds a column, one a pass elsewhere."""

import numpy as np
import pytest

import modeloom as ml
from modeloom.operators.mixture import counted_sums

PLAIN = dict(on="values", accelerate=False, n_components=4, tol=0)


def jobs_of(spark, name, call):
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        found = call()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return found, sorted(context.statusTracker().getJobIdsForGroup(name))


def same(found, whole):
    assert found.gap == 0 and found.iterations == whole.iterations
    for part in ("weight", "mean", "std", "log_c", "half_prec", "mass"):
        assert getattr(found, part) == pytest.approx(getattr(whole, part), rel=1e-9)
    assert found.hits == whole.hits


def test_passes_over_values_beyond_the_cells_are_no_jobs(spark):
    rows = spark.range(50_000).selectExpr("pow(id % 40000, 1.5) as x")
    found, jobs = jobs_of(
        spark, "fit 40000 values", lambda: ml.fit_mixtures(rows, ["x"], max_iter=20, **PLAIN)["x"]
    )
    assert len(jobs) < 10  # two a pass and more before
    same(found, ml.fit_mixtures(rows, ["x"], max_iter=20, **PLAIN | {"on": "rows"})["x"])


def test_a_pass_over_spread_values_is_one_job(spark):
    rows = spark.range(30_000).selectExpr("pow(id % 25000, 1.5) as x", "cast(id % 211 - 100 as double) as y")

    def fit(passes):
        return ml.fit_mixtures(rows, ["x", "y"], max_iter=passes, limit=100, **PLAIN)

    found, few = jobs_of(spark, "fit spread values", lambda: fit(3))
    _, more = jobs_of(spark, "fit them again", lambda: fit(8))
    assert len(more) - len(few) == 5  # 7 before
    whole = ml.fit_mixtures(rows, ["x", "y"], max_iter=3, **PLAIN | {"on": "rows"})
    for name in ("x", "y"):
        same(found[name], whole[name])


def test_columns_of_either_kind_without_usable_rows_or_with_one_value(spark):
    rows = spark.createDataFrame(
        [(float(i % 50), 3.0, None if i % 3 else -0.0) for i in range(300)] + [(float("nan"), None, 0.0)],
        "x double, y double, z double",
    )
    found = ml.fit_mixtures(rows, ["x", "y", "z"], max_iter=9, limit=10, **PLAIN)
    whole = ml.fit_mixtures(rows, ["x", "y", "z"], max_iter=9, **PLAIN | {"on": "rows"})
    for name in ("x", "y", "z"):
        same(found[name], whole[name])
    with pytest.raises(ValueError, match=r"no usable value in column number \[1\]"):
        ml.fit_mixtures(rows.selectExpr("x", "cast(null as double) as n"), ["x", "n"], **PLAIN)


def test_sums_of_a_pass_are_taken_over_all_blocks():
    rng = np.random.default_rng(3)
    x, w = np.sort(rng.normal(1e6, 2, 20_001)), rng.integers(1, 9, 20_001).astype(float)
    kernel = {
        "shift": 1e6, "scale": 2.0, "m": np.array([-1.0, 0.0, 2.5]),
        "c": np.array([-1.0, -0.5, -40.0]), "h": np.array([0.5, 2.0, 1e5]),
    }
    away = ((x - 1e6) / 2.0)[:, None] - kernel["m"]
    terms = kernel["c"] - kernel["h"] * away**2
    top = terms.max(axis=1)
    norm = np.exp(terms - top[:, None]).sum(axis=1)
    share = np.exp(terms - top[:, None]) / norm[:, None] * w[:, None]
    found = counted_sums(x, w, kernel | {"hits": True})
    for i in range(3):
        assert found[i] == pytest.approx((share * away**i).sum(axis=0), rel=1e-10)
    assert found[3].tolist() == np.bincount(terms.argmax(axis=1), w, 3).tolist()
    assert found[4].sum() == pytest.approx(w @ (top + np.log(norm)), rel=1e-12)

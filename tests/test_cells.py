"""One-scan summaries, the fits on them, extrapolated passes and remembered chunks."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import modeloom as ml
from modeloom.operators import cells as C
from modeloom.operators.mixture import _Cells
from modeloom.plans import refit
from tests.test_fit import frame, gaussians, numpy_fit


def collected(df):
    return sorted(tuple(r) for r in df.select(*C.NAMES).collect())


def test_single_values_are_kept_exactly(spark):
    values = [1.5, 1.5, -2.0, 0.0, -0.0, 1e300, None, math.nan, math.inf, 5e-324]
    found = C.value_cells(frame(spark, values), ["x"])
    got = {r["mean"]: (r["n"], r["m2"], r["low"], r["high"]) for r in found.collect()}
    assert got == {x: (n, 0.0, x, x) for x, n in ((1.5, 2), (-2.0, 1), (0.0, 2), (1e300, 1), (5e-324, 1))}


def test_cells_do_not_depend_on_the_partitioning(spark):
    rng = np.random.default_rng(0)
    df = frame(spark, np.r_[rng.lognormal(0, 2, 3000), -rng.lognormal(0, 1, 500), np.full(700, 3.0)])
    want = collected(C.value_cells(df.coalesce(1), ["x"], limit=100))
    assert 10 < len(want) <= 100
    for parts in (3, 40):
        got = collected(C.value_cells(df.repartition(parts), ["x"], limit=100))
        assert [r[:4] for r in got] == [r[:4] for r in want]
        assert np.allclose(np.array(got, float), np.array(want, float), rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("limit", [1, 2, 7, 64, 10**6])
def test_widths_are_the_most_that_fit(limit):
    x = np.random.default_rng(limit).normal(0, 10, 500)
    whole = C.CellSet.of_values(x)
    cut = whole.bounded(limit)
    assert len(cut) <= max(limit, 1) or cut.bits == 0
    if cut.bits < 64:
        assert len(C.CellSet.joined([whole], cut.bits + 1)) > limit
    assert cut.n.sum() == 500 and np.isclose(cut.n @ cut.mean, x.sum())
    ss = cut.m2.sum() + cut.n @ (cut.mean - x.mean()) ** 2
    assert np.isclose(ss, ((x - x.mean()) ** 2).sum())


def test_moments_far_from_zero(spark):
    x = 1.7e9 + np.random.default_rng(1).normal(0, 1e-3, 2000)
    row = C.cell_moments(C.value_cells(frame(spark, x), ["x"], limit=50)).first()
    assert row["rows"] == 2000 and row["min"] == x.min() and row["max"] == x.max()
    assert row["mean"] == pytest.approx(x.mean(), rel=1e-14)
    assert row["var"] == pytest.approx(x.var(ddof=1), rel=1e-3)  # means of cells are rounded to 2e-7


def test_the_table_is_scanned_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = frame(spark, gaussians(n=2000)).withColumn("y", F.col("x") * 2)
    watched = df.mapInArrow(count, df.schema)
    spec = {"x": ml.Continuous(), "y": ml.Mixed((0.0,))}
    ml.fit_table(watched, spec, key=["id"], limit=200)
    assert seen.value == 2000


def test_fit_on_cells_equals_fit_on_rows(spark, events):
    options = {"max_iter": 12, "tol": 0}
    rows = ml.fit_mixtures(events, ["value"], on="rows", **options)["value"]
    same = ml.fit_mixtures(events, ["value"], **options)["value"]
    assert same.gap == 0 and same.hits == rows.hits
    for name in ("weight", "mean", "std", "log_c", "mass", "bounds"):
        assert getattr(same, name) == pytest.approx(getattr(rows, name), rel=1e-7)


def test_fewer_cells_stay_close_and_the_gap_holds(spark):
    x = gaussians(n=6000)
    df = frame(spark, x)
    options = {"n_components": 3, "tol": 1e-10}
    rows = ml.fit_mixtures(df, ["x"], on="rows", **options)["x"]
    near = ml.fit_mixtures(df, ["x"], limit=512, **options)["x"]
    assert near.mean == pytest.approx(rows.mean, abs=1e-3 * x.std())
    assert near.std == pytest.approx(rows.std, abs=1e-3 * x.std())
    assert near.weight == pytest.approx(rows.weight, abs=1e-3)
    # the bound over all rows under the same parameters, against the one over cells
    kernel = {
        "shift": 0.0, "scale": 1.0, "m": np.array(near.mean), "c": np.array(near.log_c),
        "h": np.array(near.half_prec),
    }
    whole = C.CellSet.of_values(x)
    found = [
        _Cells(s.n, s.mean, s.m2, s.low, s.high).sums({0: kernel})[0]
        for s in (whole.bounded(512), whole.bounded(4096), whole)
    ]
    coarse, fine, rows = ((f["log_norm"][0] / len(x), f["gap"] / len(x)) for f in found)
    assert 0 <= rows[0] - coarse[0] <= coarse[1] == pytest.approx(near.gap)
    assert 0 <= rows[0] - fine[0] <= fine[1] < coarse[1] / 50
    assert rows[1] == 0


def test_extrapolated_passes_reach_the_same_fit_sooner(spark):
    x = np.random.default_rng(2).gamma(2.0, 3.0, 1500).round(1)
    df = frame(spark, x)
    fast = ml.fit_mixtures(df, ["x"], n_components=4)["x"]
    slow = ml.fit_mixtures(df, ["x"], n_components=4, accelerate=False, max_iter=5000)["x"]
    assert fast.converged and slow.converged and fast.iterations < slow.iterations / 2
    assert fast.bounds[-1] >= slow.bounds[-1] - 1e-5
    for model in (fast, slow):
        assert all(b >= a for a, b in zip(model.bounds, model.bounds[1:]))


def test_the_point_of_rest_equals_numpy(spark):
    x = np.round(gaussians(n=600), 2)
    model = ml.fit_mixtures(frame(spark, x), ["x"], n_components=3, tol=1e-14)["x"]
    mean, std = numpy_fit(x, 3, 400)
    assert model.mean == pytest.approx(mean.tolist(), rel=1e-6)
    assert model.std == pytest.approx(std.tolist(), rel=1e-6)


def test_default_fit_of_events_converges(spark):
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    model = ml.fit_mixtures(events, ["value"])["value"]
    assert model.converged and model.iterations <= 100


def test_an_unfinished_fit_is_reported(spark, caplog):
    df = frame(spark, gaussians(n=500))
    ml.fit_table(df, {"x": ml.Continuous()}, key=["id"], max_iter=2)
    assert "x: the fit has not converged after 2 passes" in caplog.text


def test_one_chunk_is_redone(spark, tmp_path):
    path = str(tmp_path / "memo")
    x = gaussians(n=3000)
    df = frame(spark, x)
    chunk = F.floor(F.col("id") / 500)
    refit.store_cells(df, ["x"], path, chunk=chunk)
    options = {"n_components": 3, "limit": 300}
    base = ml.fit_mixtures(df, ["x"], **options)["x"]
    assert refit.fit_stored(spark, path, ["x"], **options)["x"].mean == pytest.approx(base.mean, rel=1e-6)

    changed = np.where(np.arange(3000) // 500 == 2, x * 2 + 5, x)
    only = frame(spark, changed).where(chunk == 2)
    refit.store_cells(only, ["x"], path, chunk=chunk, chunks=[2])
    again = refit.fit_stored(spark, path, ["x"], **options)["x"]
    whole = ml.fit_mixtures(frame(spark, changed), ["x"], **options)["x"]
    assert again.mean == pytest.approx(whole.mean, rel=1e-6)
    assert again.mass == pytest.approx(whole.mass, rel=1e-5)

    # a chunk that has lost its rows, and a name without rows
    refit.store_cells(df.limit(0), ["x"], path, chunk=chunk, chunks=[2, 77])
    left = refit.fit_stored(spark, path, ["x"], **options)["x"]
    rest = ml.fit_mixtures(df.where(chunk != 2), ["x"], **options)["x"]
    assert sum(left.mass) == pytest.approx(2500)
    assert left.mean == pytest.approx(rest.mean, rel=1e-6)


def test_cells_of_null_chunks_and_nothing(spark, tmp_path):
    df = frame(spark, [1.0, 2.0, 3.0]).withColumn("at", F.lit(None).cast("long"))
    refit.store_cells(df, ["x"], str(tmp_path / "m"), chunk=F.col("at"))
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    assert [r["chunk"] for r in rows] == [-1, -1, -1]
    with pytest.raises(ValueError, match="no usable value"):
        ml.fit_mixtures(frame(spark, [None]), ["x"])

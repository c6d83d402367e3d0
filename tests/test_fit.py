"""The distributed fit against plain numpy, known mixtures and its own invariants."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import modeloom as ml
from modeloom.functions.special import digamma, log_gamma
from modeloom.operators.mixture import model_table, models_from_table


def gaussians(seed=7, n=3000):
    """Weights 0.5 / 0.3 / 0.2 around -50, 0 and 80."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(m, s, int(n * w)) for w, m, s in ((0.5, -50, 2), (0.3, 0, 5), (0.2, 80, 3))]
    return np.concatenate(parts)


def frame(spark, values, column="x"):
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"id long, {column} double")


def numpy_fit(x, size, iterations, alpha=0.001):
    """The same variational updates in one array, from the same quantile start."""
    n, mu, sd = len(x), x.mean(), x.std(ddof=1)
    z = (x - mu) / sd
    order = np.sort(x)
    cuts = [order[max(1, -(-n * round(1000 * i / size) // 1000)) - 1] for i in range(1, size)]
    r = np.eye(size)[np.searchsorted(cuts, x, side="left")]
    for step in range(iterations + 1):
        count = r.sum(0)
        mean = np.where(count > 0, (r * z[:, None]).sum(0) / np.maximum(count, 1e-300), 0)
        spread = (r * (z[:, None] - mean) ** 2).sum(0) / np.maximum(count, 1e-300) + 1e-6 / sd**2
        a, b = 1 + count, alpha + np.array([count[k + 1 :].sum() for k in range(size)])
        beta = nu = 1 + count
        m = count * mean / beta
        var = (1 + count * spread + count / beta * mean**2) / nu
        both = digamma(a + b)
        log_pi = digamma(a) - both + np.concatenate([[0], np.cumsum(digamma(b) - both)[:-1]])
        c = log_pi + 0.5 * (digamma(nu / 2) + np.log(2) - np.log(nu) - np.log(var))
        c = c - 0.5 * np.log(2 * np.pi) - 0.5 / beta
        if step < iterations:
            terms = c - (z[:, None] - m) ** 2 / (2 * var)
            r = np.exp(terms - terms.max(1, keepdims=True))
            r /= r.sum(1, keepdims=True)
    return m * sd + mu, np.sqrt(var) * sd


def test_digamma_and_log_gamma():
    assert digamma(1.0) == pytest.approx(-0.5772156649015329, abs=1e-12)
    assert digamma(0.001) == pytest.approx(-1000.5755719318103, rel=1e-12)
    assert digamma(250.5) == pytest.approx(math.log(250.5) - 1 / 501 - 1 / (12 * 250.5**2), abs=1e-10)
    assert log_gamma([0.5]) == pytest.approx([math.log(math.sqrt(math.pi))])


def test_fit_equals_numpy(spark):
    x = np.round(gaussians(n=600), 2)
    model = ml.fit_mixtures(frame(spark, x), ["x"], n_components=5, max_iter=4, tol=0, accelerate=False)["x"]
    mean, std = numpy_fit(x, 5, 4)
    assert model.mean == pytest.approx(mean.tolist(), rel=1e-9)
    assert model.std == pytest.approx(std.tolist(), rel=1e-9)


@pytest.mark.parametrize("init", ["quantile", "kmeans"])
def test_known_mixture_is_recovered(spark, init):
    model = ml.fit_mixtures(
        frame(spark, gaussians()), ["x"], n_components=3, max_iter=60, tol=1e-9, init=init
    )["x"]
    found = sorted(zip(model.mean, model.std, model.weight))
    for (mean, std, weight), (m, s, w) in zip(found, ((-50, 2, 0.5), (0, 5, 0.3), (80, 3, 0.2))):
        assert mean == pytest.approx(m, abs=0.6)
        # The priors pull with the weight of one row: the spread of all rows, around their mean.
        prior = (gaussians().var(ddof=1) + (m - gaussians().mean()) ** 2) / (3000 * w)
        assert std == pytest.approx(math.sqrt(s**2 + prior), rel=0.1)
        assert weight == pytest.approx(w, abs=0.01)


def test_bound_never_falls_and_weights_sum_to_one(spark, events):
    model = ml.fit_mixtures(events, ["value"], max_iter=15, tol=0)["value"]
    assert all(b >= a - 1e-9 for a, b in zip(model.bounds, model.bounds[1:]))
    assert sum(model.weight) == pytest.approx(1)
    assert sum(model.mass) == pytest.approx(events.count())
    assert sum(model.hits) == events.count()


def test_partitioning_and_row_order_do_not_matter(spark, events):
    base = ml.fit_mixtures(events, ["value"], max_iter=5, tol=0)["value"]
    for other in (
        events.repartition(1),
        events.repartition(50),
        events.orderBy(F.desc("event_id")).repartition(3),
    ):
        again = ml.fit_mixtures(other, ["value"], max_iter=5, tol=0)["value"]
        assert again.mean == pytest.approx(base.mean, rel=1e-6)
        assert again.std == pytest.approx(base.std, rel=1e-6)


def test_columns_fitted_together_equal_columns_fitted_alone(spark, events):
    df = events.withColumn("twice", F.col("value") * 2 + 1)
    both = ml.fit_mixtures(df, ["value", "twice"], max_iter=4, tol=0)
    alone = ml.fit_mixtures(df, ["twice"], max_iter=4, tol=0)["twice"]
    assert both["twice"].mean == pytest.approx(alone.mean, rel=1e-9)
    assert len(both["value"].mean) == 10


def test_one_value_filling_a_third_of_the_rows(spark):
    x = np.concatenate([np.full(1000, 5.0), gaussians(n=2000)])
    model = ml.fit_mixtures(frame(spark, x), ["x"], n_components=5, max_iter=40, tol=1e-9)["x"]
    assert sum(model.mass) == pytest.approx(3000)
    assert any(abs(m - 5) < 1.5 for m in model.mean)


@pytest.mark.parametrize("values", [[3.0] * 20, [3.0], [1.0, 2.0, None, float("nan")]])
def test_few_distinct_values(spark, values):
    df = frame(spark, values)
    model = ml.fit_mixtures(df, ["x"], max_iter=3)["x"]
    assert all(math.isfinite(v) for v in model.mean + model.std + model.log_c)
    assert model.active
    encoded = ml.encode_continuous(df, "x", model, key=["id"])
    for row in ml.decode_continuous(encoded, model).collect():
        if row["x"] is None or math.isnan(row["x"]):
            assert row["decoded"] is None and row["encoded"] is None
        else:
            assert row["decoded"] == pytest.approx(row["x"], rel=1e-9)


@pytest.mark.parametrize("values", [[], [None, None]])
def test_nothing_to_fit_is_a_clear_error(spark, values):
    with pytest.raises(ValueError, match="no usable value"):
        ml.fit_mixtures(frame(spark, values), ["x"])


def test_model_table_round_trip(spark, events, tmp_path):
    models = ml.fit_mixtures(events, ["value"], max_iter=2)
    model_table(spark, models).write.parquet(str(tmp_path / "params"))
    back = models_from_table(spark.read.parquet(str(tmp_path / "params")))["value"]
    assert (back.mean, back.log_c, back.order) == (
        models["value"].mean, models["value"].log_c, models["value"].order,
    )


def test_sample_fraction_is_repeatable(spark, events):
    fits = [
        ml.fit_mixtures(df, ["value"], sample_fraction=0.5, key=["event_id"], max_iter=2)["value"]
        for df in (events, events.repartition(7))
    ]
    assert fits[0].mean == pytest.approx(fits[1].mean, rel=1e-9)
    assert sum(fits[0].hits) < events.count()

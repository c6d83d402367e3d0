"""Encoders against a row loop, and the round trip."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import modeloom as ml
from checks.fixtures import EXTREME_SQL, MIXED_SQL, MODAL, MODAL_REVERSED, TAIL_CUTS
from modeloom.operators import modes
from modeloom.operators.encode import modal_values
from modeloom.operators.table import fit_numeric, fit_table


@pytest.fixture(scope="module")
def model(events):
    return ml.bucket_models(events, ["value"], cuts=TAIL_CUTS)[0]


def posterior(model, x):
    terms = np.array(model.log_c) - np.array(model.half_prec) * (x - np.array(model.mean)) ** 2
    share = np.exp(terms - terms.max())
    return share / share.sum()


def uniform(key, seed=42):
    text = f"draw|{seed}|{len(str(key))}:{key}"
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2**32


def test_hard_draw_equals_row_loop(events, model):
    active, order = model.active, model.order
    for row in ml.encode_continuous(events, "value", model, key=["event_id"]).collect():
        p = posterior(model, row["value"])[active] + 1e-6
        j = active[int(np.searchsorted(np.cumsum(p), uniform(row["event_id"]) * p.sum(), side="right"))]
        u = (row["value"] - model.mean[j]) / (4 * model.std[j])
        assert row["encoded"][0] == pytest.approx(max(-0.99, min(0.99, u)), rel=1e-12)
        assert row["encoded"][1:] == [float(k == j) for k in order]
        assert (row["overflow"] is not None) == (abs(u) > 0.99)


def test_soft_variants_equal_row_loop(events, model):
    assert 0 not in model.active and model.order != model.active
    for variant, kept, base, bound in (
        ("soft_full", range(10), 0, None),
        ("soft_masked", model.heavy, model.heavy[0], 0.99),
        ("soft_ordered", model.order, 0, None),
    ):
        for row in ml.encode_continuous(events, "value", model, variant=variant).collect():
            r = posterior(model, row["value"])
            u = (row["value"] - model.mean[base]) / (4 * model.std[base])
            u = u if bound is None else max(-bound, min(bound, u))
            assert row["encoded"] == pytest.approx([u, *[r[k] for k in kept]], rel=1e-9, abs=1e-12)


def test_posteriors_sum_to_one(events, model):
    sums = modes.posteriors(events, "value", model).select(
        F.aggregate("posterior", F.lit(0.0), lambda a, b: a + b).alias("s")
    )
    low, high = sums.agg(F.min("s"), F.max("s")).first()
    assert (low, high) == (pytest.approx(1, abs=1e-12), pytest.approx(1, abs=1e-12))


@pytest.mark.parametrize("choice", ["draw", "argmax"])
def test_extremes_come_back(events, choice):
    df = events.withColumn("x", F.expr(EXTREME_SQL))
    model = ml.bucket_models(events, ["value"], cuts=TAIL_CUTS)[0]
    encoded = ml.encode_continuous(df, "x", model, mode_choice=choice, key=["event_id"])
    assert encoded.where("overflow is not null").count() > 0
    worst = ml.decode_continuous(encoded, model).agg(
        F.max(F.abs(F.col("decoded") - F.col("x")) / F.greatest(F.lit(1.0), F.abs("x")))
    )
    assert worst.first()[0] < 1e-9
    report = {r["part"]: r for r in ml.roundtrip_report(ml.decode_continuous(encoded, model), "x").collect()}
    assert report["all"]["exact"] == report["all"]["rows"] == events.count()


def test_filters_on_encoded_columns_stay_small_and_key_filters_reach_the_scan(events, model):
    encoded = ml.encode_continuous(events, "value", model, key=["event_id"])
    plan = encoded.where("overflow > 1 AND event_id > 10")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,10)]" in plan
    assert len(plan) < 40_000
    assert "Exchange" not in plan


def test_draw_does_not_depend_on_partitioning(events, model):
    one = ml.encode_continuous(events.repartition(1), "value", model, key=["event_id"])
    many = ml.encode_continuous(events.repartition(13), "value", model, key=["event_id"])
    assert one.exceptAll(many).count() == 0


@pytest.mark.parametrize("modal", [MODAL, MODAL_REVERSED])
def test_mixed_round_trip_and_slots(events, modal):
    df = events.withColumn("m", F.expr(MIXED_SQL))
    fitted = fit_numeric(df, ["m"], {"m": ml.Mixed(modal)}, method="buckets", cuts=TAIL_CUTS)[0]["m"]
    encoded = ml.encode_mixed(df, "m", fitted, key=["event_id"])
    missing = fitted.order.index(modal.index(-9999999.0))
    for row in ml.decode_mixed(encoded, fitted).collect():
        assert row["decoded"] == pytest.approx(row["m"], rel=1e-9)
        assert sum(row["encoded"][1:]) == 1 and len(row["encoded"]) == fitted.width
        if row["m"] == -9999999.0:
            assert row["encoded"][0] == 0 and row["encoded"][1 + missing] == 1


def test_modal_values_use_the_nearest_mode(model):
    value = modal_values(model, [40.0, -9999999.0])
    k = min(range(10), key=lambda i: abs(40 - model.mean[i]))
    assert value == (pytest.approx((40 - model.mean[k]) / (4 * model.std[k])), 0.0)


def test_table_round_trip_layout_and_reload(spark, events, tmp_path):
    df = events.withColumn("m", F.expr(MIXED_SQL)).withColumn(
        "value", F.when(F.col("event_id") % 50 == 3, None).otherwise(F.col("value"))
    )
    spec = {"event_type": ml.Categorical(), "value": ml.Continuous(), "m": ml.Mixed(MODAL)}
    encoder = fit_table(df, spec, key=["event_id"], max_iter=3)
    layout = encoder.layout(spark).orderBy("block").collect()
    assert [r["start"] for r in layout] == list(np.cumsum([0] + [r["width"] for r in layout])[:-1])
    encoded = encoder.encode(df)
    assert encoded.where(F.size("encoded") != encoder.output_dim).count() == 0
    wrong = encoder.decode(encoded).where(
        ~F.col("event_type").eqNullSafe(F.col("decoded_event_type"))
        | (F.col("value").isNull() != F.col("decoded_value").isNull())
        | (F.abs(F.col("value") - F.col("decoded_value")) > 1e-6)
        | (F.abs(F.col("m") - F.col("decoded_m")) > 1e-6)
    )
    assert wrong.count() == 0
    encoder.save(str(tmp_path / "model"), spark)
    again = ml.TableEncoder.load(str(tmp_path / "model"), spark)
    keep = ["event_id", "encoded"]
    assert again.encode(df).select(*keep).exceptAll(encoded.select(*keep)).count() == 0


def test_missing_slots_decode_to_null(spark, model):
    width = len(model.active)
    rows = [(1, [None] + [1.0] + [0.0] * (width - 1)), (2, [0.5] + [None] * width), (3, None)]
    df = spark.createDataFrame(rows, "id int, encoded array<double>")
    assert [r["decoded"] for r in ml.decode_continuous(df, model).collect()] == [None] * 3


def test_bad_arguments(events, model):
    with pytest.raises(ValueError, match="variant"):
        ml.encode_continuous(events, "value", model, variant="other")
    with pytest.raises(ValueError, match="key"):
        ml.encode_continuous(events, "value", model)
    with pytest.raises(ValueError, match="repeat"):
        ml.Mixed((1.0, 1.0))

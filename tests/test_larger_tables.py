"""Queries on tables larger than the shared ones; every test builds its own rows."""

import os

import pytest

import modeloom as ml
from checks import queries
from modeloom.sources import tables


def store(df, folder, name="events"):
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def event_rows(spark, ids, value="cast(id % 97 as double)"):
    return spark.createDataFrame([(i,) for i in ids], "id long").selectExpr(
        "id as event_id", "id % 7 as user_id", "'a' as event_type", f"{value} as value"
    )


def test_chunks_of_events_past_the_range_of_scaled_ids(spark, tmp_path):
    ids = [2999, 3000, 3999, 4000, 6000, 6999, 7000, 2_000_000, 6_000_000, 1 << 62, None]
    found = queries.chunk_filter_query(spark, store(event_rows(spark, ids), tmp_path))
    assert dict(found.dtypes)["first_id"] == "bigint"
    step = 9_007_199_254_741
    assert sorted(tuple(r)[:4] for r in found.collect()) == [
        (-2, 2, -2000 * step, -1001 * step),
        (1, 2, 1000 * step, 1999 * step),
    ]


def test_values_beyond_the_cells_are_fitted_one_by_one(spark):
    rows = spark.range(3000).selectExpr(
        "pow(id % 997, 1.5) as wide", "cast(id % 5 as double) as coarse"
    )
    options = dict(accelerate=False, max_iter=20, n_components=3)
    columns = ["wide", "coarse"]
    whole = ml.fit_mixtures(rows, columns, on="rows", **options)
    found = ml.fit_mixtures(rows, columns, on="values", limit=100, **options)
    for name in columns:
        assert found[name].gap == 0
        assert found[name].mean == pytest.approx(whole[name].mean, rel=1e-9)
        assert found[name].mass == pytest.approx(whole[name].mass, rel=1e-9)
        assert found[name].iterations == whole[name].iterations


def test_fit_params_rests_and_keeps_its_digits(spark, tmp_path):
    ids = list(range(300))
    folder = store(event_rows(spark, ids, "pow(id % 89, 1.5)"), tmp_path)
    events = spark.read.parquet(f"{folder}/events.parquet")
    model = ml.fit_mixtures(
        events, ["value"], on="rows", combine=True, accelerate=False, max_iter=3000
    )["value"]
    assert model.converged and model.iterations > 100
    found = queries.fit_params(spark, folder).orderBy("k").collect()
    assert [r["mean"] for r in found] == pytest.approx([round(m, 5) for m in model.mean], abs=2e-5)
    assert [r["weight"] for r in found] == pytest.approx([round(w, 6) for w in model.weight], abs=2e-6)
    assert any(r["mean"] != round(r["mean"], 2) for r in found)


def test_many_small_batches_share_folders(spark, tmp_path):
    profile = {"min": 0, "p25": 1, "p50": 2, "p75": 3, "p90": 4, "p95": 5, "p99": 6, "max": 7}
    path, rows = str(tmp_path / "synth"), 12_345
    made = ml.generate_dataset(spark, path, rows, profile, batch_rows=10, partitions=3)
    assert made == {"expected": rows, "written": rows}
    stored = tables.read_partitioned(spark, path, "batch*")
    assert stored.where("batch != id div 10").count() == 0
    assert stored.select("batch").distinct().count() == 1235
    same = ml.synthesize(spark, rows, profile, partitions=1)
    assert stored.select("id", "amount").exceptAll(same).count() == 0
    assert stored.count() == rows
    folders = [f for f in os.listdir(path) if f.startswith("batch")]
    assert len(folders) == 1  # 1235 before


def test_synth_range_beyond_a_folder_a_batch(spark, tmp_path):
    rows = event_rows(spark, list(range(220_000)))
    found = queries.synth_range(spark, store(rows, tmp_path))
    assert found.where("rows = 1000 and first_id = batch * 1000 and last_id = first_id + 999").count() == 1100
    assert found.count() == 1100

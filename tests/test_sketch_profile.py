"""Profiles from stored sketches against exact ones."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from modeloom.operators import sketch_profile as S


def test_profile_of_a_growing_table(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = rng.lognormal(3, 1, 20_000)
    rows = [(i, float(v), float(-i)) for i, v in enumerate(x)] + [(5, None, math.nan), (6, math.inf, None)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    chunk, path = F.floor(F.col("id") / 5000), str(tmp_path / "s")
    S.store_sketches(df.where("id < 15000"), ["x", "y"], path, chunk=chunk)
    assert S.sketched_profile(spark, path).where("col = 'x'").first()["rows"] == 15_000
    # a new chunk and one done again: only those are read
    S.store_sketches(df.where("id >= 10000"), ["x", "y"], path, chunk=chunk)
    got = {r["col"]: r for r in S.sketched_profile(spark, path).collect()}
    for name, values in (("x", x), ("y", -np.arange(20_000.0))):
        row = got[name]
        assert (row["rows"], row["min"], row["max"]) == (20_000, values.min(), values.max())
        assert row["mean"] == pytest.approx(values.mean())
        assert row["std"] == pytest.approx(values.std(ddof=1))
        for q, value in zip(S.QUANTILES, row["quantiles"], strict=True):
            assert abs((values <= value).mean() - q) <= S.RANK_ERROR
    part = S.sketched_profile(spark, path, chunks=[1]).where("col = 'x'").first()
    assert part["rows"] == 5000 and part["max"] == x[5000:10000].max()


def test_empty_chunks_and_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, 1.0), (1, None)], "at long, x double")
    path = str(tmp_path / "s")
    S.store_sketches(df, ["x"], path, chunk=F.col("at"))
    row = S.sketched_profile(spark, path).collect()
    assert [(r["rows"], r["std"], r["quantiles"]) for r in row] == [(1, 0.0, [1.0] * 6)]

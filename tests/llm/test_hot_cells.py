"""Large cells of the lattice, dealt to several tasks, against all pairs."""

import numpy as np
import pytest

from modeloom.llm import embedding
from tests.llm.test_pairs import brute_links


def hot(rng, n=260):
    """Near copies of one vector, equal vectors, and some that link with nothing."""
    centre = rng.standard_normal(64)
    rows = [(centre + 0.3 * rng.standard_normal(64)).tolist() for _ in range(n)]
    rows += [centre.tolist()] * 40 + [[-0.0] * 63 + [1.0]] * 2 + [[0.0] * 63 + [1.0]]
    rows += rng.standard_normal((20, 64)).tolist()
    return [(i, v, i % 40 == 0 and 1 or 0) for i, v in enumerate(rows)]


@pytest.mark.parametrize("chunk", [32, 4096])
def test_large_cells_equal_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(embedding, "CHUNK", chunk)
    rows = hot(np.random.default_rng(3))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embedding.near_vectors(df.repartition(5)).collect()}
    count, root = brute_links(rows)
    found = sum(r["n_links"] for r in got.values()) / sum(count.values())
    assert found >= 0.99 and all(got[i]["n_links"] <= count[i] for i in count)
    assert {i: r["component_id"] for i, r in got.items()} == root


def test_dealt_cells_count_the_same_links(spark, monkeypatch):
    rows = hot(np.random.default_rng(4))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    whole = sorted(embedding.near_vectors(df).collect())
    monkeypatch.setattr(embedding, "CHUNK", 16)
    assert sorted(embedding.near_vectors(df).collect()) == whole


def test_equal_vectors_are_one_node():
    """A cell of 20,000 equal vectors once listed 2e8 pairs; now it holds one node."""
    n = 3000
    vectors = np.tile(np.eye(64)[:1], (n, 1)) + np.eye(64)[1] * np.arange(n)[:, None] * 1e-6
    vectors = embedding.unit(vectors)
    cells = embedding.Lattice(64).cells(vectors, np.zeros(n, np.int64))
    cell = cells[0, 0, 0]
    inside = (cells[:, 0, :] == cell).any(axis=1)
    count, root = embedding.link_cell(
        cells[inside][:, 0, 0] == cell, np.zeros(inside.sum(), np.int8),
        np.ones(inside.sum(), np.int64), vectors[inside], cells[inside], 0, cell, 0.93,
    )
    assert len(count) == inside.sum() and count.max() == inside.sum() - 1 and root.max() == 0


def test_rows_that_repeat_an_id(spark):
    one, other = np.eye(64)[0].tolist(), np.eye(64)[1].tolist()
    rows = [(5, one, 0), (5, other, 0), (7, one, 0), (3, other, 0), (9, one, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in embedding.near_vectors(df).collect())
    assert got == [
        (3, 1, 3, True), (5, 3, 3, False), (5, 3, 3, False), (7, 2, 3, False), (9, 2, 3, False)
    ]

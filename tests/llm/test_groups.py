"""Groups of nodes that share a signature: sketches of large sets, and groups dealt to tasks."""

import numpy as np
import pyarrow as pa
import pytest

from modeloom.llm import closure, ngram_join
from tests.llm.small import corpus, frame
from tests.llm.test_pairs import brute_components


def sketch_table(sets, bits=512):
    offsets = np.r_[0, np.cumsum([len(x) for x in sets])]
    return pa.table(
        {
            "node": pa.array(range(len(sets)), pa.int64()),
            "n": pa.array(np.diff(offsets), pa.int64()),
            "side": pa.array([0] * len(sets), pa.int32()),
            "sketch": closure.sketches(np.concatenate(sets), offsets, bits),
        }
    )


@pytest.mark.parametrize("size", [1000, 1300, 2000, 5000])
def test_sketches_tell_large_sets_apart(size):
    rng = np.random.default_rng(size)
    sets = [rng.integers(0, 2**63, size + 20 * k, dtype=np.uint64) for k in range(20)]
    table = sketch_table(sets)
    assert closure._active(table).num_rows == 0


def test_no_similar_sets_are_told_apart():
    """Also where the sketches of both have different widths."""
    rng = np.random.default_rng(6)
    for size in (400, 480, 500, 900, 1000, 1020, 2000, 4000):
        base = rng.integers(0, 2**63, size * 5 // 4, dtype=np.uint64)
        table = sketch_table([base[:size], base[: size * 5 // 4], base[size // 20 : size]])
        assert closure._active(table).num_rows == 3


def family(n):
    """Near copies in a chain, others that are almost similar, and short ones."""
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(n):
        mine = list(words)
        for k in range(i % 7):
            mine[(17 * k + i) % 120] = f"x{i}-{k}"
        rows.append((i, " ".join(mine), "en", "s", 1, 1, "x"))
    return rows


@pytest.mark.parametrize("chunk", [4, 1024])
def test_dealt_groups_equal_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(closure, "CHUNK", chunk)
    rows = family(60) + [(1000 + r[0], *r[1:]) for r in corpus()]
    got = ngram_join.ngram_components(frame(spark, rows)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute_components(rows)

"""N-gram join, line dedup and lattice dedup against all pairs."""

import re

import numpy as np
import pytest

from modeloom.llm import components, embedding, line_dedup, ngram_join, queries
from tests.conftest import SF_DIR
from tests.llm.small import corpus, frame, lowered, words


class Union:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text):
    w = words(lowered(text))
    if 0 < len(w) < 5:
        return {tuple(w)}
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    union, ids = Union(sets), list(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                union.join(a, b)
    return {d: (len(sets[d]), union.find(d)) for d in sets}


def test_ngram_components_equal_all_pairs(spark):
    got = ngram_join.ngram_components(frame(spark)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute_components(corpus())
    assert ngram_join.ngram_components(frame(spark).limit(0)).count() == 0


def test_ngram_query_equals_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op2_ngram_join(spark, SF_DIR).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute_components(docs)


def test_every_similar_pair_shares_a_signature():
    rng = np.random.default_rng(5)
    for size in (4, 5, 6, 9, 17, 40, 150, 700):
        for _ in range(60):
            base = rng.integers(1, 2**63, size * 2, dtype=np.uint64)
            extra = rng.integers(0, size // 4 + 1)
            gone = rng.integers(0, max(1, size // 9) + 1)
            x, y = np.sort(base[:size]), np.sort(base[gone : size + extra])
            common = len(np.intersect1d(x, y))
            if 100 * common < 80 * (len(x) + len(y) - common) or len(x) == len(y) == common:
                continue
            values, offsets = np.r_[x, y], np.array([0, len(x), len(x) + len(y)])
            sign, owner = ngram_join.signatures(values, offsets)
            assert set(sign[owner == 0]) & set(sign[owner == 1])


def test_components_of_chains_hubs_and_nothing(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components.components(df.limit(0)).count() == 0


# Runs of blanks inside a line count as one.
SPACES = re.compile("[\x09-\x0d ]+")


def brute_lines(rows):
    """The text of every row without repeats of lines of any length."""
    lines = {}
    for r in rows:
        for n, line in enumerate(lowered(r[1]).split("\n")):
            plain = SPACES.sub(" ", line).strip(" ")
            if plain:
                lines.setdefault(plain, []).append((r[0], n))
    names = sorted(lines)
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} or {x} for x in names]
    union = Union(range(len(names)))
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if 100 * len(x & y) >= 80 * len(x | y):
                union.join(i, j)
    first = {}
    for i, name in enumerate(names):
        root = union.find(i)
        first[root] = min([first.get(root, (1 << 60, 0)), *lines[name]])
    gone = {p for i, x in enumerate(names) for p in lines[x] if p != first[union.find(i)]}
    return {
        r[0]: None if r[1] is None else "\n".join(
            x for n, x in enumerate(r[1].split("\n")) if (r[0], n) not in gone
        )
        for r in rows
    }


def test_lines_equal_all_pairs(spark):
    df = frame(spark)
    lean = line_dedup.dedup_lines(df)
    assert lean.columns == [*df.columns, "_lines", "_gone"]
    rows = lean.collect()
    assert {r["doc_id"]: r["text"] for r in rows} == brute_lines(corpus())
    assert sum(r["_gone"] for r in rows) > 0
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_query_equals_all_pairs(spark):
    import hashlib

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = brute_lines(docs)
    got = queries.op4_line_dedup(spark, SF_DIR).collect()
    assert len(got) == len(docs)
    same = [
        r["kept_sha256"] == hashlib.sha256((want[r["doc_id"]] or "").encode()).hexdigest()
        for r in got
    ]
    # banding finds a pair at the threshold with probability 0.996
    assert sum(same) >= 0.98 * len(same)


def clusters():
    rng = np.random.default_rng(11)
    rows, number = [], 0
    for label in (0, 1):
        for _ in range(40):
            centre = rng.standard_normal(64)
            for _ in range(rng.integers(1, 5)):
                noise = rng.standard_normal(64) * rng.uniform(0, 0.37)
                rows.append((number, (centre + noise).astype("f4").astype(float).tolist(), label))
                number += 1
    rows.append((number, rows[0][1], 0))
    rows.append((number + 1, rows[0][1], 1))
    rows.append((number + 2, rows[0][1], None))
    odd = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [float("inf")] * 64]
    odd += [[1.0, 2.0], [1e300] * 64, [1e-300] * 64, rows[5][1][:10]]
    return rows + [(1000 + i, v, 0) for i, v in enumerate(odd)]


def brute_links(rows):
    def sound(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    union, count = Union([r[0] for r in rows]), {r[0]: 0 for r in rows}
    for i, (a, x, p) in enumerate(rows):
        for b, y, q in rows[:i]:
            if p is None or p != q or not sound(x) or not sound(y) or len(x) != len(y):
                continue
            u, v = embedding.unit(np.array([x]))[0], embedding.unit(np.array([y]))[0]
            if u @ v >= 0.93 - 1e-12:
                count[a], count[b] = count[a] + 1, count[b] + 1
                union.join(a, b)
    return count, {r[0]: union.find(r[0]) for r in rows}


def test_lattice_finds_the_links(spark):
    rows = clusters()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embedding.near_vectors(df).collect()}
    count, root = brute_links(rows)
    assert len(got) == len(rows)
    assert all(got[i]["n_links"] <= count[i] for i in count)
    found = sum(r["n_links"] for r in got.values()) / sum(count.values())
    assert found >= 0.97
    if found == 1:
        assert {i: r["component_id"] for i, r in got.items()} == root
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    assert embedding.near_vectors(df.limit(0)).count() == 0


def test_decoded_points_are_lattice_points_and_nearest():
    rng = np.random.default_rng(1)
    points = rng.uniform(-3, 3, (300, 8))
    found = embedding.decode(points, 3)
    halves = found % 2
    assert ((halves == halves[:, :, :1]).all(axis=2)).all()
    assert (found.sum(axis=2) % 4 == 0).all()
    distance = ((found / 2 - points[:, None]) ** 2).sum(axis=2)
    assert (np.diff(distance, axis=1) >= -1e-9).all()
    assert distance[:, 0].max() <= 1 + 1e-9


@pytest.mark.parametrize("size", [1, 4, 5, 100, 12345])
def test_bands_reach_their_neighbours(size):
    ends = ngram_join.band_ends(size)
    own = np.searchsorted(ends, size)
    assert ends[own] >= size and np.searchsorted(ends, size * 5 // 4) <= own + 1

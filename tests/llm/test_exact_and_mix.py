"""Exact dedup and entropy-balanced mixing."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from modeloom.llm import exact_dedup, mixing
from tests.llm.small import corpus, frame, lowered, words


@given(st.binary(max_size=9000), st.binary(max_size=9000))
def test_fingerprints_compose(x, y):
    assert exact_dedup.combine(exact_dedup.fingerprint(x), exact_dedup.fingerprint(y)) == (
        exact_dedup.fingerprint(x + y)
    )


def expected_groups(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[lowered(row[1])].append(row[0])
    return {
        r[0]: (
            max(groups[lowered(r[1])]), len(groups[lowered(r[1])]),
            r[0] == max(groups[lowered(r[1])]),
            hashlib.sha256(lowered(r[1]).encode()).hexdigest(),
        )
        for r in rows
    }


def test_groups_equal_brute_force(spark):
    got = exact_dedup.exact_groups(frame(spark)).collect()
    assert len(got) == len(corpus())
    assert {r[0]: tuple(r)[1:] for r in got} == expected_groups(corpus())


def test_collisions_are_told_apart(spark, monkeypatch):
    real = exact_dedup.fingerprint
    monkeypatch.setattr(exact_dedup, "BASES", (0, 0))
    monkeypatch.setattr(exact_dedup, "_POWERS", [exact_dedup.powers(f, exact_dedup.BLOCK) for f in (0, 1)])
    rows = [(i, t, None, None, 0, 0, "") for i, t in enumerate(["abcx", "qqqx", "ABCX", "zzzx", "x"])]
    marks = {tuple(real(lowered(r[1]).encode())) for r in rows}
    got = exact_dedup.exact_groups(frame(spark, rows)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == expected_groups(rows)
    assert marks is not None


def test_dedup_keeps_columns_and_empty_tables(spark):
    kept = exact_dedup.dedup(frame(spark))
    assert kept.columns == frame(spark).columns
    want = {d for d, v in expected_groups(corpus()).items() if v[2]}
    assert {r["doc_id"] for r in kept.collect()} == want
    assert exact_dedup.exact_groups(frame(spark).limit(0)).count() == 0


def test_pieces_combine(spark):
    data = b"some bytes that are cut into pieces" * 9
    cuts = [0, 7, 7, 100, len(data)]
    rows = [
        (1, i, *exact_dedup.fingerprint(data[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ]
    df = spark.createDataFrame(rows, "doc_id long, piece long, h1 long, h2 long, n_bytes long")
    got = exact_dedup.combine_pieces(df).first()
    assert tuple(got)[1:] == exact_dedup.fingerprint(data)


def targets(sizes):
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else rest * weight[s] / share for s in names}
        over = {s for s in names if s not in full and target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mix_meets_its_targets(spark):
    rows = corpus()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want = targets(sizes)
    got = mixing.mix(frame(spark)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    taken = defaultdict(int)
    for r in got:
        taken[r["source"]] += r["taken"]
        assert r["size"] == len(words(rows[r["doc_id"] // 3][1]))
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
    for source, words_taken in taken.items():
        assert words_taken == pytest.approx(want[source], abs=1)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(frame(spark)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_mix_caps_a_small_source(spark):
    rows = [(i, "w " * 10, None, "a" if i else "b", 0, 0, "") for i in range(20)]
    got = mixing.mix(frame(spark, rows)).collect()
    assert {r["source"]: r["target"] for r in got} == pytest.approx({"a": 200 - 30, "b": 30})
    assert mixing.mix(frame(spark, rows).limit(0)).count() == 0
    empty = [(1, None, None, None, 0, 0, ""), (2, "", None, "s", 0, 0, "")]
    assert {r["taken"] for r in mixing.mix(frame(spark, empty)).collect()} == {0}


def test_copies_follow_the_mix(spark):
    rows = corpus() + [corpus()[0]]
    df = frame(spark, rows)
    taken = sum(r["taken"] for r in mixing.mix(df).collect())
    copies = mixing.take_copies(df)
    assert copies.columns == df.columns
    assert sum(len(words(r["text"])) for r in copies.collect()) == taken

"""Components and signature groups by few jobs: many links, many tasks in one batch."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from modeloom.llm import closure, components
from tests.llm.test_pairs import Union


def linked(n, seed):
    """A long path out of order, a star and loose pairs."""
    rng = np.random.default_rng(seed)
    path, nodes = rng.permutation(n), np.arange(n)
    a = np.r_[path[:-1], np.full(n, n), 3 * n + 2 * nodes]
    b = np.r_[path[1:], n + 1 + nodes, 3 * n + 2 * nodes + 1]
    order = rng.permutation(len(a))
    return [(int(x) - 50, int(y) - 50) for x, y in zip(a[order], b[order], strict=True)]


@pytest.mark.parametrize("most", [64, 1 << 20])
def test_components_whatever_a_task_holds(spark, monkeypatch, most):
    monkeypatch.setattr(components, "TASK_LINKS", most)
    links = linked(100, 3)
    union = Union({x for link in links for x in link})
    for a, b in links:
        union.join(a, b)
    rows = spark.createDataFrame([*links, (5, 5), (None, 7)], "a long, b long").repartition(8)
    got = components.components(rows).collect()
    assert sorted(map(tuple, got)) == sorted((x, union.find(x)) for x in union.parent)


def test_few_links_are_joined_by_few_jobs(spark):
    rows = spark.createDataFrame(linked(200, 4), "a long, b long").repartition(8)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("links", "links")
    try:
        components.components(rows)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("links")) <= 6


def tasks(count, size, seed):
    """Members of groups of many sizes, sorted by task; near copies within a group."""
    rng = np.random.default_rng(seed)
    out = {c: [] for c in (*closure.TASK, "node", "n", "side", "component")}
    sets = []
    for g in range(count):
        base = rng.integers(0, 2**63, 90, dtype=np.uint64)
        for k in range(2 + (g * 7) % size):
            fresh = rng.integers(0, 2**63, k % 30, dtype=np.uint64)
            sets.append(np.r_[base[: 90 - len(fresh)], fresh])
            for c, x in zip(out, (g, 0, g % 2, len(sets), 90, g % 2 * (1 + k % 2), k // 3), strict=True):
                out[c].append(x)
    offsets = np.r_[0, np.cumsum([len(x) for x in sets])]
    table = pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})
    return table.append_column("sketch", closure.sketches(np.concatenate(sets), offsets, 256))


def test_tasks_of_a_batch_are_kept_apart():
    """Together, small and large tasks propose what each does by itself."""
    table = tasks(60, 90, 8)
    task = np.cumsum(closure._begins(table))
    component = table.column("component").to_numpy() + 1000 * task
    apart = set()
    for start in np.flatnonzero(closure._begins(table)):
        part = table.slice(start, (task == task[start]).sum())
        for i, j in closure._near_blocks(part, part.column("component").to_numpy()):
            apart |= {tuple(sorted(x)) for x in zip((i + start).tolist(), (j + start).tolist(), strict=True)}
    got = [
        tuple(sorted(x))
        for i, j in closure._near(table, task, component)
        for x in zip(i.tolist(), j.tolist(), strict=True)
    ]
    assert len(got) == len(set(got)) > 500 and set(got) == apart
    cut = [t for t in closure.whole_tasks(iter(table.to_batches(max_chunksize=7)), rows=40)]
    assert len(cut) > 5 and pa.concat_tables(cut).equals(table)
    assert all(closure._begins(t).sum() == len(np.unique(t.column("g").to_numpy())) for t in cut)


def test_asked_pairs_are_not_proposed_again():
    table = tasks(12, 20, 9)
    first = pa.Table.from_batches([closure._proposed(table, 1)])
    asked = pa.table(
        {
            **{c: first.column(c) for c in closure.TASK},
            "node": first.column("a"),
            "n": pa.array([0] * len(first), pa.int64()),
            "side": pa.array([-1] * len(first), pa.int64()),
            "component": first.column("b"),
            "sketch": pa.array([None] * len(first), pa.binary()),
        }
    )
    both = pa.concat_tables([table, asked]).sort_by([(c, "ascending") for c in closure.TASK])
    rest = pa.Table.from_batches([closure._proposed(both.combine_chunks(), 1 << 20)])
    whole = pa.Table.from_batches([closure._proposed(table, 1 << 20)])
    pairs = [set(zip(*(t.column(c).to_pylist() for c in ("g", "a", "b")), strict=True)) for t in (first, rest, whole)]
    assert pairs[0] and pairs[1] and not pairs[0] & pairs[1] and pairs[0] | pairs[1] == pairs[2]


def test_a_task_tells_whether_it_left_pairs_for_later():
    """Only tasks that left pairs are looked into again."""
    table = tasks(12, 20, 9)
    some, whole = (pa.Table.from_batches([closure._proposed(table, m)]) for m in (3, 1 << 20))
    count = [dict(Counter(t.column("g").to_pylist())) for t in (some, whole)]
    more = dict(zip(some.column("g").to_pylist(), some.column("more").to_pylist(), strict=True))
    assert more == {g: n < count[1][g] for g, n in count[0].items()}
    assert set(more.values()) == {True, False} and not any(whole.column("more").to_pylist())


def test_groups_without_pairs_left_are_not_read_again(spark, monkeypatch):
    """Of 40 groups without a link, one leaves pairs for a second round; it is read alone."""
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 2**63, 50, dtype=np.uint64) for _ in range(40 * 2 + 30)]
    members = [(k // 2 if k < 80 else 40, k) for k in range(len(sets))]
    offsets = np.r_[0, np.cumsum([len(x) for x in sets])]
    blank = closure.sketches(np.concatenate(sets) * np.uint64(0), offsets, 256).to_pylist()
    known = spark.createDataFrame([(k, 50, blank[k]) for k in range(len(sets))], "node long, n long, sketch binary")
    found = spark.createDataFrame([(1, g, k) for g, k in members], "kind byte, a long, b long")
    bodies = spark.createDataFrame([(k, np.sort(x).tobytes()) for k, x in enumerate(sets)], "node long, body binary")
    read = []

    def noted(df, name):
        if name == "members":
            read.append(df.select("g").distinct().count())
        return df.localCheckpoint()

    monkeypatch.setattr(closure, "stage", noted)
    parts = closure.closed_components(found, known, lambda nodes: bodies.join(nodes, "node", "left_semi"), closure.similar_sets)
    assert parts.count() == 0 and read[0] == 41 and read[1:] and max(read[1:]) < 41

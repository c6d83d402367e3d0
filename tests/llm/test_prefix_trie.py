"""The prefix trie and time-forward processing against brute force."""

import hashlib
import random
import zlib

import pytest

from modeloom.llm import forward, prefix_trie, queries
from tests.conftest import SF_DIR

SCHEMA = (
    "conv_id long, turn long, role string, text string, owner long, digest string, kind string,"
    " depth string, above int"
)
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]


def content(role, text):
    return (role or "", text or "")


def digest(turn):
    role, text = turn
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute_trie(rows):
    """All nodes by plain dictionaries of prefixes."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn, content(role, text)))
    for conv, found in turns.items():
        found.sort(key=lambda t: (t[0] is not None, t[0] or 0, digest(t[1])))
        turns[conv] = [t for _, t in found]
    rebuilt = {}
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        rebuilt[conv] = tuple(turns.get(base, [])[:h] + own[h:])
    members = {}
    for conv, whole in rebuilt.items():
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[c] for c in children.get(node, [])]
        size = len(node[-1][1]) if node else 0
        leaves = sum(x for x, _ in below) or 1
        saved = (len(members[node]) - 1) * size + sum(y for _, y in below)
        totals[node] = (leaves, saved)
        ends = sorted(c for c in members[node] if rebuilt[c] == node)
        out.append(
            (
                min(members[node]), len(node), min(members[node[:-1]]) if node else None,
                len(members[node]), len(children.get(node, [])), leaves, saved,
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=lambda r: r[:2])


def table(spark, rows):
    extra = (7, "x", "y", "z", 1)
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA).repartition(5)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: r[:2])


def awkward():
    rng = random.Random(3)
    rows = []
    for conv in [*range(0, 12), *range(100, 140), 215, 350, -5, -100, -250, 10**12 + 7]:
        shared = rng.choice(["hello", "héllo 😀", "start"])
        for turn in range(rng.randint(1, 9)):
            text = shared if turn == 0 else rng.choice(["a", "bb", "ccc", "", None])
            rows.append((conv, turn, rng.choice(["user", "user", None]), text))
    rows += [(300 + i, t, "user", "copy") for i in range(30) for t in range(7)]
    # ties, repeated rows, no turn number, no conversation
    rows += [(120, 3, "user", "tie"), (120, 3, "user", "another"), (121, None, "a", "first")]
    rows += [(121, None, "a", "first"), (None, 1, "user", "lost"), (122, None, None, None)]
    return rows


def test_trie_equals_brute_force(spark):
    rows = awkward()
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == brute_trie(rows)


def test_one_long_conversation_spans_tasks_and_batches(spark):
    rows = [(c, t, "user", f"turn {t % 50}") for c in (200, 201, 207) for t in range(700)]
    rows += [(5, t, "user", "x") for t in range(3)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = found(prefix_trie.prefix_trie(table(spark, rows)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_trie(rows)


def test_conversations_without_turns_stay_members_of_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(401, 460)]
    got = found(prefix_trie.prefix_trie(table(spark, rows)))
    assert got == brute_trie(rows)
    assert got[0][1] == 0 and got[0][3] == 59


def test_no_conversations_no_nodes(spark):
    empty = table(spark, awkward()).limit(0)
    assert prefix_trie.prefix_trie(empty).collect() == []
    assert prefix_trie.prefix_trie(table(spark, [(None, 1, "a", "b")])).collect() == []


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op11_prefix_trie(spark, SF_DIR)) == brute_trie(rows)


def brute_totals(nodes):
    totals = {k: [v[1], v[2]] for k, v in nodes.items()}
    for (owner, depth) in sorted(nodes, key=lambda k: -k[1]):
        above = nodes[(owner, depth)][0]
        if above is not None:
            for i in range(2):
                totals[(above, depth - 1)][i] += totals[(owner, depth)][i]
    return {k: tuple(v) for k, v in totals.items() if any(v)}


@pytest.mark.parametrize("shape", ["paths", "star", "chain"])
def test_totals_across_shards_with_spilled_messages(spark, shape):
    rng = random.Random(shape)
    nodes = {(0, 0): (None, 0, 5)}
    if shape == "star":
        nodes |= {(i, 1): (0, 1, i % 3) for i in range(1, 500)}
    elif shape == "chain":
        # one path through every owner: it crosses every shard
        nodes |= {(i, i): (i - 1, int(i == 119), 1) for i in range(1, 120)}
    else:
        for owner in range(1, 150):
            above = rng.choice([k for k in nodes if k[0] < owner])
            for step in range(rng.randint(1, 6)):
                nodes[(owner, above[1] + 1 + step)] = (
                    above[0] if step == 0 else owner, rng.randint(0, 1), rng.randint(0, 9)
                )
    rows = [(o, d, *v) for (o, d), v in nodes.items()]
    df = spark.createDataFrame(rows, "owner long, depth long, above long, leaves long, saved long")
    got = forward.subtree_totals(df, least_nodes=20, limit=8)
    got = {(r["owner"], r["depth"]): (r["leaves"], r["saved"]) for r in got.collect()}
    assert got == brute_totals(nodes)


def test_queue_pops_in_order_whatever_it_spills():
    rng = random.Random(1)
    queue, plain = forward.MessageQueue(limit=5), []
    for _ in range(3000):
        if rng.random() < 0.6 or not plain:
            message = (rng.randint(-9, 9), rng.randint(0, 50), rng.randint(0, 5), 1)
            queue.push(message)
            plain.append(message)
        else:
            plain.sort()
            assert queue.peek() == plain[0]
            assert queue.pop() == plain.pop(0)
    assert queue.runs > 10
    assert [queue.pop() for _ in plain] == sorted(plain)
    assert queue.peek() is None

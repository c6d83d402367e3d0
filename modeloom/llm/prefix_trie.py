"""The trie of conversation prefixes, its subtree totals by time-forward processing.

Every conversation is rebuilt: the first ``h`` turns of the first conversation of its hundred,
then its own turns after its first ``h``.  A node is a distinct sequence of first turns.  It is
known by a fingerprint of the sequence: four polynomials over prime fields of 31 bits, whose
terms are the turns' MD5 digests.  The fingerprints of all prefixes are running sums, so a
conversation of any length is spread over many tasks: rows are range-sorted by conversation
and turn, each task sums its own rows, and one carry per task joins them up.  No conversation
is collected anywhere.

Nodes are counted with partial aggregation; their subtree totals come from
:mod:`modeloom.llm.forward`, where a node's address is its smallest member and its depth.  The
ids of the conversations that end in a node are joined in sorted pieces by many tasks; only the
hash itself, which has to read them in order, runs over the pieces of a node in one task, as a
stream.

Defined results: turns are ordered with NULL first, turns of one conversation and number by the
MD5 of their contents; a NULL role or text is empty.  Rows with a NULL ``conv_id`` belong to no
conversation and are left out.  ``conv_id % 100`` has the sign of ``conv_id``.  Repeated rows are
turns of their own.  An empty table gives an empty table, without a root.  Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modeloom.llm.flow import stage
from modeloom.llm.forward import subtree_totals

HUNDRED = 100
# Turns taken from the first conversation of the hundred: fewer than this.
SHARED = 6

PRIMES = np.array([2147483647, 2147483629, 2147483587, 2147483579], np.uint64)
BASES = np.array([1103515245, 1299709021, 1566083941, 1812433253], np.uint64)
# Kinds of rows of a rebuilt conversation, in its order.
HEAD, OWN, END = 0, 1, 2

PREFIXES = "conv_id long, kind int, depth long, f1 long, f2 long, p1 long, p2 long, size long"
KEY = ["depth", "f1", "f2"]


def powers(exponents: np.ndarray) -> np.ndarray:
    """``BASES ** exponent`` in the four fields, one row per exponent."""
    left = exponents.astype(np.uint64)
    out = np.ones((len(left), 4), np.uint64)
    base = BASES.copy()
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] = out[odd] * base % PRIMES
        base = base * base % PRIMES
        left >>= np.uint64(1)
    return out


def packed(fields: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four numbers of 31 bits as two of 62."""
    wide = fields.astype(np.int64)
    return (wide[:, 0] << 31) | wide[:, 1], (wide[:, 2] << 31) | wide[:, 3]


class Runner:
    """Running depths and fingerprints of sorted rows; a conversation may span batches.

    ``skip`` own turns of the conversation at hand are still to be left out.
    """

    def __init__(self, conv: int | None = None, skip: int = 0, count: int = 0, fields=(0,) * 4):
        self.conv, self.skip, self.count = conv, skip, count
        self.fields = np.array(fields, np.uint64)

    def state(self) -> tuple[int, int, list[int]]:
        return self.skip, self.count, [int(x) for x in self.fields]

    def add(self, conv: np.ndarray, kind: np.ndarray, digest: np.ndarray):
        """Whether a row stays, its depth and fingerprint, and the fingerprint before it."""
        fresh = np.r_[True, conv[1:] != conv[:-1]]
        first = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        skip = np.array([shared_turns(c) for c in conv[first].tolist()], np.int64)
        counted, held = np.zeros(len(first), np.int64), np.zeros((len(first), 4), np.uint64)
        if conv[0] == self.conv:
            skip[0], counted[0], held[0] = self.skip, self.count, self.fields

        def running(values):
            sums = np.cumsum(values, axis=0)
            before = np.concatenate([np.zeros_like(sums[:1]), sums])[first]
            return sums - before[group]

        own = kind == OWN
        passed = running(own.astype(np.int64))
        turn = (kind == HEAD) | (own & (passed > skip[group]))
        depth = running(turn.astype(np.int64)) + counted[group]
        terms = digest % PRIMES * powers(depth) % PRIMES
        terms[~turn] = 0
        after = (running(terms) + held[group]) % PRIMES
        ahead = (after + PRIMES - terms) % PRIMES
        self.conv, self.count, self.fields = int(conv[-1]), int(depth[-1]), after[-1]
        self.skip = max(0, int(skip[-1] - passed[-1]))
        return turn | (kind == END), depth, after, ahead


def shared_turns(conv: int) -> int:
    """How many turns a conversation takes from the first of its hundred."""
    return zlib.crc32(str(conv).encode()) % SHARED


def _digests(column: pa.Array) -> np.ndarray:
    """Four numbers of 32 bits from each digest of 16 bytes."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<u4").reshape(-1, 4).astype(np.uint64)


def _arrays(batch: pa.RecordBatch):
    conv, kind = batch.column("conv_id").to_numpy(), batch.column("kind").to_numpy()
    return conv, kind, _digests(batch.column("digest"))


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per task: its first and last conversation and the state it ends in.

    If it holds one conversation only, which may have begun in another task, there is a state
    for each number of turns that may be left to skip.
    """
    whole, parts, first = Runner(), [Runner(None, r) for r in range(SHARED)], None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        conv, kind, digest = _arrays(batch)
        if first is None:
            first = int(conv[0])
            for runner in parts:
                runner.conv = first
        mine = conv == first
        if mine.any():
            for runner in parts:
                runner.add(conv[mine], kind[mine], digest[mine])
        whole.add(conv, kind, digest)
    if first is not None:
        states = [r.state() for r in parts] if whole.conv == first else [whole.state()]
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([TaskContext.get().partitionId()], pa.int64()),
                "first": pa.array([first], pa.int64()),
                "last": pa.array([whole.conv], pa.int64()),
                "states": pa.array(
                    [[[skip, count, *fields] for skip, count, fields in states]],
                    pa.list_(pa.list_(pa.int64())),
                ),
            }
        )


def carries(tails: list) -> dict[int, tuple]:
    """For each task, the state in which the tasks before it leave its first conversation."""
    starts, carry = {}, (None, 0, 0, (0,) * 4)
    for row in sorted(tails, key=lambda r: r["part"]):
        starts[row["part"]] = carry
        conv, skip, count, fields = carry
        joined = conv == row["first"]
        if row["first"] != row["last"]:
            skip, n, *more = row["states"][0]
            joined = False
        else:
            begun = skip if joined else shared_turns(row["first"])
            skip, n, *more = row["states"][begun]
        if joined:
            shift = powers(np.array([count]))[0]
            more = (np.array(more, np.uint64) * shift + np.array(fields, np.uint64)) % PRIMES
            more, n = more.tolist(), count + n
        carry = (row["last"], skip, n, tuple(more))
    return starts


def prefixes(ranged: DataFrame) -> DataFrame:
    """Depth and fingerprints of every turn of the rebuilt conversations, and their ends.

    ``ranged`` is range-partitioned, sorted and kept, so that both passes see the same rows.
    """
    tails = ranged.mapInArrow(
        _tails, "part long, first long, last long, states array<array<long>>"
    ).collect()
    starts = carries(tails)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runner = Runner(*starts.get(TaskContext.get().partitionId(), ()))
        for batch in batches:
            if batch.num_rows:
                stays, depth, after, ahead = runner.add(*_arrays(batch))
                columns = [depth, *packed(after), *packed(ahead)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("conv_id"), batch.column("kind"),
                        *(pa.array(c.astype(np.int64)) for c in columns), batch.column("size"),
                    ],
                    names=[f.split(" ")[0] for f in PREFIXES.split(", ")],
                ).filter(pa.array(stays))

    return ranged.select("conv_id", "kind", "digest", "size").mapInArrow(work, PREFIXES)


def turn_rows(conversations: DataFrame, names: dict[str, str]) -> DataFrame:
    """(conv_id, turn, digest, size) of every turn that belongs to a conversation."""
    role, text = (F.coalesce(F.col(names[n]).cast("string"), F.lit("")) for n in ("role", "text"))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.select(
        F.col(names["conv_id"]).cast("long").alias("conv_id"),
        F.col(names["turn"]).cast("long").alias("turn"),
        F.unhex(F.md5(content.cast("binary"))).alias("digest"),
        F.length(text).cast("long").alias("size"),
    ).where("conv_id is not null")


def rebuilt_rows(turns: DataFrame) -> DataFrame:
    """Rows of the rebuilt conversations, range-sorted: the shared turns, all own turns (those
    to be left out are still there), and one END row."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["conv_id", "kind", "turn", "digest", "size"]
    own = turns.withColumn("kind", F.lit(OWN)).select(*columns)
    convs = turns.select("conv_id").distinct()
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    wanted = convs.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % HUNDRED).alias("first"), h.alias("h")
    )
    # a limit per group: the engine cuts every task's rows before the shuffle
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    heads = turns.where(F.col("conv_id") % HUNDRED == 0)
    heads = heads.withColumn("pos", F.row_number().over(order)).where(F.col("pos") < SHARED)
    heads = heads.select(F.col("conv_id").alias("first"), "pos", "digest", "size")
    taken = wanted.join(heads, "first").where("pos <= h").select(
        "conv_id", F.lit(HEAD).alias("kind"), F.col("pos").cast("long").alias("turn"), "digest", "size"
    )
    ends = convs.select(
        "conv_id", F.lit(END).alias("kind"), F.lit(None).cast("long").alias("turn"),
        F.lit(b"\0" * 16).alias("digest"), F.lit(0).cast("long").alias("size"),
    )
    order = ["conv_id", "kind", F.asc_nulls_first("turn"), "digest"]
    rows = own.union(taken).union(ends)
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256): SHA-256 of the ids, ascending and joined by commas."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in KEY])
            ids = batch.column("conv_id").to_pylist()
            change = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            first = np.flatnonzero(np.r_[True, change])
            last = np.r_[first[1:], len(ids)]
            joined = [
                ",".join(map(str, ids[a:b]))
                for a, b in zip(first.tolist(), last.tolist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(k[first]) for k in keys),
                    pa.array([ids[i] for i in first], pa.int64()), pa.array(joined),
                ],
                names=[*KEY, "low", "ids"],
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            rows = zip(*(batch.column(c).to_pylist() for c in [*KEY, "ids"]), strict=True)
            for *at, ids in rows:
                if at != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield _hash_rows(done)
        if key is not None:
            yield _hash_rows([(*key, state.hexdigest())])

    order = ["f1", "f2", "depth", "conv_id"]
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ends.select(*KEY, "conv_id").repartitionByRange(parts, *order)
    joined = ranged.sortWithinPartitions(*order).mapInArrow(
        pieces, "depth long, f1 long, f2 long, low long, ids string"
    )
    joined = joined.repartition(parts, *KEY).sortWithinPartitions(*KEY, "low")
    return joined.mapInArrow(digests, "depth long, f1 long, f2 long, ends_sha256 string")


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.string()]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*KEY, "ends_sha256"]
    )


def counted_nodes(prefix: DataFrame) -> DataFrame:
    """One row per node: its key and its parent's, members, smallest member, size of its text."""
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = F.col("kind") == END
    steps = prefix.select(
        "conv_id",
        *(F.when(root, zero).otherwise(F.col(c)).alias(c) for c in [*KEY, "size"]),
        *(F.when(root, none).otherwise(F.col(c)).alias(c) for c in ["p1", "p2"]),
    )
    return steps.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("size").alias("size"),
    )


def linked_nodes(nodes: DataFrame) -> DataFrame:
    """The nodes with ``above``, their parent's smallest member, and ``n_children``."""
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")]
    children = nodes.where("depth > 0").select(*up).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"),
        F.col("owner").alias("above"),
    )
    found = nodes.join(children, KEY, "left").join(parents, ["depth", "p1", "p2"], "left")
    return found.select(
        *KEY, "owner", "above", "n_convs", "size",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
    )


def prefix_trie(
    conversations: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The nodes of the trie of rebuilt conversations."""
    names = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    ranged = rebuilt_rows(turn_rows(conversations, names)).persist(StorageLevel.DISK_ONLY)
    prefix = prefixes(ranged).persist(StorageLevel.DISK_ONLY)
    nodes = stage(counted_nodes(prefix), "nodes")
    ends = stage(end_hashes(prefix.where(F.col("kind") == END)), "ends")
    prefix.unpersist()
    ranged.unpersist()
    nodes = stage(linked_nodes(nodes), "trie")
    own = nodes.select(
        "owner", "depth", "above",
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    totals = subtree_totals(own)
    zero = F.lit(0).cast("long")
    return nodes.join(totals, ["owner", "depth"], "left").join(ends, KEY, "left").select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.col("above").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.coalesce("leaves", zero).alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )

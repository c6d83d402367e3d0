"""Training order: every sequence gets a slot by a keyed permutation, and slots are laid out
in shards of fixed stride.

Texts become token ids, cut into sequences of ``length`` ids (the last of a document is
filled up with ``pad``), and sequences are numbered by document id: texts are dealt to ranges
of ids, and a task counts the sequences of its range, so that a number is known in place once
one sum per range is.  A Feistel network
keyed by ``key`` permutes the smallest even-bit range that holds their number; walking its
cycles until a number falls below the count makes it a permutation of exactly the
sequences.  So a sequence's slot follows from its number alone: nothing is sorted to
shuffle, any task can be repeated, and any key gives another epoch's order.

Slot ``s`` lies in shard ``s // per_shard`` at byte ``s % per_shard * stride``.  Ids are
shuffled once, unpadded, straight to ranges of whole shards; each shard is one row of
fixed-stride bytes, so a reader skips to any slot and resumes there.  Beside the bytes a
shard lists the document, block and number of ids of each of its sequences.

Defined results: NULL text is empty, and an empty text is one sequence with one closing
token.  Rows that repeat an id, or have none, are numbered like all others, in an order
given by their ids and texts' hashes; equal rows follow each other, so their order does not
show.  An empty table gives no sequences and no shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modeloom.llm.flow import stage
from modeloom.llm.text import mix, slices
from modeloom.llm.tokens import TOKENIZER, tokenised

LENGTH = 2048
ROUNDS = 6
PER_SHARD = 256
# Shards of one file: what a reader may hold at once.
PER_FILE = 32
# Bytes a writer gathers before it writes them out.
GROUP_BYTES = 16 << 20
# Shards of one range at most, however few partitions the session names.
PER_RANGE = 256
SEQUENCES = "doc_id long, block long, slot long, shard long, offset long, n_tokens long, ids binary"
SHARDS = (
    "shard long, first_slot long, n long, doc_ids array<long>, blocks array<long>, "
    "sizes array<long>, body binary"
)


def feistel(numbers: np.ndarray, half: int, key: int) -> np.ndarray:
    """A keyed permutation of ``range(2 ** (2 * half))``."""
    mask = np.uint64((1 << half) - 1)
    left, right = numbers >> np.uint64(half), numbers & mask
    for turn in range(ROUNDS):
        left, right = right, left ^ (mix(right, key * 2 * ROUNDS + turn) & mask)
    return (left << np.uint64(half)) | right


def slots(numbers: np.ndarray, count: int, key: int) -> np.ndarray:
    """The slot of each sequence number below ``count``; all slots below it are used."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    at = feistel(numbers.astype(np.uint64), half, key)
    outside = np.flatnonzero(at >= np.uint64(count))
    while len(outside):
        at[outside] = feistel(at[outside], half, key)
        outside = outside[at[outside] >= np.uint64(count)]
    return at.astype(np.int64)


class _Places:
    """Tells each task its range, and each row the sequences before it in that range."""

    def __init__(self, length: int):
        self.length, self.attempt, self.at = length, None, 0

    def __call__(self, ids: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        task = TaskContext.get()
        if task.taskAttemptId() != self.attempt:
            self.attempt, self.at = task.taskAttemptId(), 0
        blocks = -(-np.diff(offsets) // self.length)
        ends = self.at + np.cumsum(blocks)
        self.at = int(ends[-1])
        part = np.full(len(blocks), task.partitionId())
        return [pa.array(part, pa.int32()), pa.array(ends - blocks, pa.int64())]


def _numbered(
    docs: DataFrame, doc_id: str, text: str, length: int, end: int, tokenizer: str
) -> tuple[DataFrame, list[int]]:
    """Tokens with ``part`` and ``before`` (sequences before a row in its range), and how many
    sequences there are before each range, and in all."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).alias("text"),
        # deals equal rows to several ranges
        F.monotonically_increasing_id().alias("place"),
    )
    order = [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))), F.col("place")]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)

    extra = (["part int", "before long"], _Places(length))
    held = stage(tokenised(ranged, "doc_id", "text", end, tokenizer, extra), "tokens")
    blocks = F.ceil(F.col("n_tokens") / length).cast("long")
    # one sum per range
    sums = {
        r["part"]: r["total"]
        for r in held.groupBy("part").agg(F.sum(blocks).alias("total")).collect()
    }
    totals = [sums.get(part, 0) for part in range(max(sums, default=-1) + 1)]
    return held, np.cumsum([0, *totals]).tolist()


def _cut(
    batch: pa.RecordBatch, starts: list[int], length: int, key: int, per_shard: int,
    pad: int | None,
) -> pa.RecordBatch:
    """The sequences of some rows; filled up with 32-bit ids where ``pad`` is given."""
    n = batch.column("n_tokens").to_numpy()
    each = -(-n // length)
    row = np.repeat(np.arange(len(n)), each)
    block = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    first = np.array(starts, np.int64)[batch.column("part").to_numpy()]
    number = (first + batch.column("before").to_numpy())[row] + block
    slot = slots(number, starts[-1], key)
    data: list[bytes] = []
    for value, count in zip(batch.column("ids"), n.tolist(), strict=True):
        raw = value.as_buffer().to_pybytes()
        stride = length * (len(raw) // count)
        data += [raw[low : low + stride] for low in range(0, len(raw), stride)]
    sizes = np.minimum(length, n[row] - block * length)
    if pad is not None:
        data = [_padded(x, k, length, pad) for x, k in zip(data, sizes.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(pa.array(row, pa.int64())),
            pa.array(block, pa.int64()),
            pa.array(slot, pa.int64()),
            pa.array(slot // per_shard, pa.int64()),
            pa.array(slot % per_shard * (4 * length), pa.int64()),
            pa.array(sizes, pa.int64()),
            pa.array(data, pa.binary()),
        ],
        names=["doc_id", "block", "slot", "shard", "offset", "n_tokens", "ids"],
    )


def _padded(raw: bytes, size: int, length: int, pad: int) -> bytes:
    """``length`` 32-bit ids; a sequence that is already so wide stays as it is."""
    if len(raw) == 4 * length:
        return raw
    full = np.full(length, pad, "<u4")
    full[:size] = np.frombuffer(raw, f"<u{len(raw) // size}")
    return full.tobytes()


def _sequences(
    docs: DataFrame, doc_id: str, text: str, length: int, key: int, end: int, pad: int | None,
    per_shard: int, tokenizer: str,
) -> tuple[DataFrame, int]:
    held, starts = _numbered(docs, doc_id, text, length, end, tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids"):
                yield _cut(part, starts, length, key, per_shard, pad)

    return held.mapInArrow(cut, SEQUENCES), starts[-1]


def sequences(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    key: int = 1,
    end: int = 2,
    pad: int = 0,
    per_shard: int = PER_SHARD,
    tokenizer: str = TOKENIZER,
) -> DataFrame:
    """One row per sequence: doc_id, block, slot, shard, offset, n_tokens and ids.

    ``ids`` holds ``length`` unsigned little-endian 32-bit numbers.
    """
    return _sequences(docs, doc_id, text, length, key, end, pad, per_shard, tokenizer)[0]


def shards(
    rows: DataFrame, count: int, length: int = LENGTH, per_shard: int = PER_SHARD, pad: int = 0
) -> DataFrame:
    """One row per shard, in order: shard, first_slot, n, doc_ids, blocks, sizes and body (its
    sequences' ids end to end).

    ``count`` is the number of sequences.  A shard holds a fixed number of them, so its size
    is bounded, and each partition holds a range of shards.
    """
    total = -(-count // per_shard)
    named = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(named, total), -(-total // PER_RANGE))
    each = max(1, -(-total // parts))
    ranged = rows.repartitionById(parts, F.floor(F.col("shard") / each).cast("int"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come in order of slots; those of one shard are held together
        held: list[dict] = []
        for batch in batches:
            for low in range(0, batch.num_rows, per_shard):
                for row in batch.slice(low, per_shard).to_pylist():
                    if held and held[0]["shard"] != row["shard"]:
                        yield _shard(held)
                        held = []
                    row["ids"] = _padded(row["ids"], row["n_tokens"], length, pad)
                    held.append(row)
        if held:
            yield _shard(held)

    columns = ["doc_id", "block", "slot", "shard", "n_tokens", "ids"]
    return ranged.select(*columns).sortWithinPartitions("slot").mapInArrow(join, SHARDS)


def _shard(rows: list[dict]) -> pa.RecordBatch:
    many = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([rows[0]["shard"]], pa.int64()),
            pa.array([rows[0]["slot"]], pa.int64()),
            pa.array([len(rows)], pa.int64()),
            pa.array([[r["doc_id"] for r in rows]], many),
            pa.array([[r["block"] for r in rows]], many),
            pa.array([[r["n_tokens"] for r in rows]], many),
            pa.array([b"".join(r["ids"] for r in rows)], pa.binary()),
        ],
        names=["shard", "first_slot", "n", "doc_ids", "blocks", "sizes", "body"],
    )


def write_order(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    key: int = 1,
    end: int = 2,
    pad: int = 0,
    per_shard: int = PER_SHARD,
    tokenizer: str = TOKENIZER,
) -> int:
    """Write all sequences as shards in training order; returns their number.

    A rerun replaces the whole table.
    """
    rows, count = _sequences(docs, doc_id, text, length, key, end, None, per_shard, tokenizer)
    whole = shards(rows, count, length, per_shard, pad)
    whole.write.mode("overwrite").options(
        compression="zstd", maxRecordsPerFile=PER_FILE, **{"parquet.block.size": GROUP_BYTES}
    ).parquet(path)
    return count


def read_slots(
    spark: SparkSession, path: str, start: int, stop: int, length: int = LENGTH,
    per_shard: int = PER_SHARD,
) -> DataFrame:
    """doc_id, block, slot, shard, offset, n_tokens and ids of the slots from ``start`` up to
    ``stop``; other shards are not read."""
    stride = 4 * length
    rows = spark.read.schema(SHARDS).parquet(path).where(
        (F.col("shard") >= start // per_shard) & (F.col("shard") <= (stop - 1) // per_shard)
    )
    i, slot = F.col("i"), F.col("first_slot") + F.col("i")
    each = F.posexplode("sizes").alias("i", "n_tokens")
    return (
        rows.select("shard", "first_slot", "doc_ids", "blocks", "body", each)
        .where((slot >= start) & (slot < stop))
        .select(
            F.get("doc_ids", i).alias("doc_id"),
            F.get("blocks", i).alias("block"),
            slot.alias("slot"),
            "shard",
            (i * stride).cast("long").alias("offset"),
            "n_tokens",
            F.substring("body", i * stride + 1, F.lit(stride)).alias("ids"),
        )
    )

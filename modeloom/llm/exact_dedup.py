"""Exact dedup by composable polynomial fingerprints.

A text's bytes are read as a polynomial over two prime fields.  Chunks are hashed on
their own and combine by length-shifted arithmetic,
``h(xy) = h(x) * r**len(y) + h(y)``, so chunks of a huge document can be hashed by
different tasks.  Rows whose fingerprints (both fields and the length) agree are then
compared chunk by chunk: a group stands only if every chunk position holds a single
content; the texts of a group that differs are grouped by their bytes instead.

Defined results: NULL counts as the empty text, and all empty texts are equal.  Of equal
texts the row with the largest id stays; rows that share both text and id form one group
whose rows all carry that id.  A NULL id is smaller than every id.  An empty table gives
an empty table.  Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.llm.flow import stage, unused
from modeloom.llm.text import bytes_of, lower, slices, texts_of

PRIMES = (2147483647, 2147483629)
BASES = (1_103_515_245, 1_299_709_021)
# Bytes dotted with one table of powers; below 2**12 such sums stay within 64 bits.
BLOCK = 4096
# Bytes of a text hashed and compared as one chunk.
CHUNK_BYTES = 1 << 16


def powers(field: int, count: int) -> np.ndarray:
    """``base ** (count - 1 - i) mod prime`` for every i."""
    out = [1] * count
    for i in range(1, count):
        out[i] = out[i - 1] * BASES[field] % PRIMES[field]
    return np.array(out[::-1], np.uint64)


_POWERS = [powers(field, BLOCK) for field in range(2)]


def fingerprint(data: bytes | np.ndarray) -> tuple[int, int, int]:
    """Both polynomial hashes of a run of bytes, and its length."""
    raw = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    whole = (0, 0, 0)
    for start in range(0, len(raw), BLOCK):
        part = raw[start : start + BLOCK].astype(np.uint64)
        hashes = [
            int((part * _POWERS[f][BLOCK - len(part) :]).sum() % np.uint64(PRIMES[f]))
            for f in range(2)
        ]
        whole = combine(whole, (*hashes, len(part)))
    return whole


def combine(left: tuple[int, int, int], right: tuple[int, int, int]) -> tuple[int, int, int]:
    """The fingerprint of two runs of bytes, one after the other."""
    shifted = [
        (left[f] * pow(BASES[f], right[2], PRIMES[f]) + right[f]) % PRIMES[f] for f in range(2)
    ]
    return (*shifted, left[2] + right[2])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, both hashes, n_bytes and SHA-256 of each text lower-cased in A-Z."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, ends = bytes_of(lower(texts_of(part.column("text"))))
                found, digests = [], []
                for start, end in zip(ends[:-1], ends[1:], strict=True):
                    piece = raw[start:end]
                    found.append(fingerprint(piece))
                    digests.append(hashlib.sha256(piece).hexdigest())
                columns = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(pa.array(c, pa.int64()) for c in columns),
                        pa.array(digests, pa.string()),
                    ],
                    names=["doc_id", "h1", "h2", "n_bytes", "text_sha256"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        work, "doc_id long, h1 long, h2 long, n_bytes long, text_sha256 string"
    )


def combine_pieces(pieces: DataFrame, key: str = "doc_id", order: str = "piece") -> DataFrame:
    """Fingerprints of documents stored as rows of (key, order, h1, h2, n_bytes).

    Each piece is shifted by the bytes after it and the shifted hashes are added, so the
    pieces of one document combine before the shuffle and in any order.
    """
    from pyspark.sql import Window

    after = Window.partitionBy(key).orderBy(F.col(order).desc())
    shifted = pieces.withColumn(
        "shift", F.sum("n_bytes").over(after) - F.col("n_bytes")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shift = batch.column("shift").to_pylist()
            for f in range(2):
                name = f"h{f + 1}"
                values = [
                    h * pow(BASES[f], s, PRIMES[f]) % PRIMES[f]
                    for h, s in zip(batch.column(name).to_pylist(), shift, strict=True)
                ]
                at = batch.schema.get_field_index(name)
                batch = batch.set_column(at, name, pa.array(values, pa.int64()))
            yield batch

    return (
        shifted.mapInArrow(work, shifted.schema)
        .groupBy(key)
        .agg(
            (F.sum("h1") % PRIMES[0]).alias("h1"),
            (F.sum("h2") % PRIMES[1]).alias("h2"),
            F.sum("n_bytes").alias("n_bytes"),
        )
    )


def _chunks(rows: DataFrame) -> DataFrame:
    """(h1, h2, n_bytes, piece, body): the lower-cased bytes of each text in chunks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = lower(texts_of(part.column("text"))).cast(pa.large_binary())
                row, piece, body = [], [], []
                for at, data in enumerate(texts.to_pylist()):
                    for number, start in enumerate(range(0, len(data), CHUNK_BYTES)):
                        row.append(at)
                        piece.append(number)
                        body.append(data[start : start + CHUNK_BYTES])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c).take(pa.array(row, pa.int64())) for c in KEY),
                        pa.array(piece, pa.int64()),
                        pa.array(body, pa.binary()),
                    ],
                    names=[*KEY, "piece", "body"],
                )

    return rows.mapInArrow(work, "h1 long, h2 long, n_bytes long, piece long, body binary")


KEY = ["h1", "h2", "n_bytes"]


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row of ``docs``."""
    marks = stage(fingerprints(docs, doc_id, text), "fingerprints")
    groups = marks.groupBy(*KEY).agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    groups = stage(groups.where("group_size > 1"), "groups")
    body = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    # only members of groups are read again, and compared chunk by chunk
    members = marks.join(groups.select(*KEY), KEY, "left_semi").where("n_bytes > 0")
    members = members.select("doc_id", *KEY).where("doc_id is not null").distinct()
    chunks = _chunks(body.join(members, "doc_id").select(*KEY, "text"))
    # equal chunks meet in one row per task before they are shuffled
    differing = (
        chunks.groupBy(*KEY, "piece", "body").count()
        .groupBy(*KEY, "piece").agg(F.count("*").alias("contents"))
        .where("contents > 1").select(*KEY).distinct()
    )
    differing = stage(differing, "differing")
    if not differing.isEmpty():
        # a collision: these texts are grouped by their bytes
        marks = marks.join(
            differing.withColumn("split", F.lit(True)), KEY, "left"
        ).withColumn("detail", F.when(F.col("split"), F.col("text_sha256")).otherwise(""))
        groups = (
            marks.groupBy(*KEY, "detail")
            .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            .where("group_size > 1")
        )
        joined = marks.join(groups, [*KEY, "detail"], "left")
    else:
        joined = marks.join(groups, KEY, "left")
    keep = F.coalesce("keep_id", "doc_id")
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that share both text and id are one document here too: all of them stay or go.
    """
    number, digest, other, same = unused(docs.columns, "number", "digest", "other", "same")
    upper, small = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), upper, small)
    keyed = docs.withColumn(number, F.col(doc_id).cast("long")).withColumn(
        digest, F.sha2(plain.cast("binary"), 256)
    )
    keep = exact_groups(docs, doc_id, text).where("kept").select(
        F.col("doc_id").alias(other), F.col("text_sha256").alias(same)
    ).distinct()
    stays = F.col(number).eqNullSafe(F.col(other)) & (F.col(digest) == F.col(same))
    return keyed.join(keep, stays, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))

"""Quality scores from compression.

Two zstandard dictionaries are built, one from well-labelled and one from badly labelled
text.  A whole text is compressed in blocks with each of them; the difference of the two
sizes, divided by the text's bytes, says which kind of text it resembles.  A logistic
curve, fitted on labelled rows that the dictionaries have not seen, turns the difference
into a probability.

Fitting uses a bounded sample: at most ``LABELLED`` labelled rows, in order of a hash of
their ids, and from their texts at most ``BLOCKS`` blocks for each dictionary.  Scoring
covers every row and whole texts, and sees nothing but the text.

Defined results: NULL and empty texts have difference 0 and so the curve's value there.
Labels that are NULL, or that contradict each other for one id, are not learnt from.
Where only one class is labelled the score is that class for every row; without any
label it is 0.5.  An empty table gives an empty table.  Repeated rows are scored alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeloom.llm.flow import lean
from modeloom.llm.text import bytes_of, slices, texts_of
from modeloom.plans.staging import materialise

BLOCK_BYTES = 512
LEVEL = 3
DICTIONARY_BYTES = 1 << 16
# Bounds of the labelled sample.
LABELLED = 24_000
BLOCKS = 8_000
THRESHOLD = 0.3
# Bytes added to a text's length, so that a few bytes do not decide on very short texts.
SMOOTHING = 16.0


@dataclass(frozen=True)
class QualityModel:
    """Both dictionaries and the curve ``1 / (1 + exp(-(slope * difference + offset)))``."""

    good: bytes
    bad: bytes
    slope: float
    offset: float

    def probability(self, difference: float) -> float:
        z = max(-700.0, min(700.0, self.slope * difference + self.offset))
        return 1.0 / (1.0 + math.exp(-z))


class Sizes:
    """Compressed sizes under one dictionary."""

    def __init__(self, dictionary: bytes):
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if data is not None:
            data.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False
        )

    def of(self, block: memoryview) -> int:
        return len(self.compressor.compress(block))


def difference(text: memoryview, good: Sizes, bad: Sizes) -> float:
    """Bytes saved by the good dictionary over the bad one, per byte of text."""
    saved = 0
    for start in range(0, len(text), BLOCK_BYTES):
        block = text[start : start + BLOCK_BYTES]
        saved += bad.of(block) - good.of(block)
    return saved / (len(text) + SMOOTHING)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def differences(docs: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """``docs`` (id columns and ``text``) with ``difference`` in place of the text."""
    names = [c for c in docs.columns if c != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(good), Sizes(bad)
        for batch in batches:
            for part in slices(batch, "text"):
                raw, ends = bytes_of(texts_of(part.column("text")))
                view = memoryview(raw)
                values = [
                    difference(view[s:e], *sizes) for s, e in zip(ends[:-1], ends[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(values, pa.float64())],
                    names=[*names, "difference"],
                )

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names)
    return docs.mapInArrow(lean(work), f"{schema}, difference double")


def _blocks(docs: DataFrame, most: int) -> DataFrame:
    """At most ``most`` blocks of each class and task, those of smallest hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {0: [], 1: []}
        for batch in batches:
            for part in slices(batch, "text"):
                raw, ends = bytes_of(texts_of(part.column("text")))
                ids, labels = part.column("doc_id").to_pylist(), part.column("label").to_pylist()
                for at, (doc, label) in enumerate(zip(ids, labels, strict=True)):
                    for start in range(int(ends[at]), int(ends[at + 1]), BLOCK_BYTES):
                        end = min(start + BLOCK_BYTES, int(ends[at + 1]))
                        rank = xxhash.xxh3_64_intdigest(f"{doc}:{start - ends[at]}") >> 1
                        held[label].append((rank, raw[start:end].tobytes()))
                for label, rows in held.items():
                    if len(rows) > 2 * most:
                        held[label] = sorted(rows)[:most]
        for label, rows in held.items():
            rows = sorted(rows)[:most]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([label] * len(rows), pa.int32()),
                    pa.array([r for r, _ in rows], pa.int64()),
                    pa.array([b for _, b in rows], pa.binary()),
                ],
                names=["label", "rank", "block"],
            )

    return docs.mapInArrow(lean(work), "label int, rank long, block binary")


def _dictionary(blocks: list[bytes]) -> bytes:
    """A trained dictionary, or the blocks themselves where there are too few to train on."""
    total = sum(map(len, blocks))
    if total >= 10 * DICTIONARY_BYTES and len(blocks) >= 64:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks, level=LEVEL).as_bytes()
    return b"".join(blocks)[-DICTIONARY_BYTES:]


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton steps, lightly ridged."""
    scale = float(np.std(x)) or 1.0
    points = np.c_[x / scale, np.ones(len(x))]
    beta, ridge = np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(points @ beta, -30, 30)))
        step = np.linalg.solve(
            points.T @ (points * (p * (1 - p) + 1e-9)[:, None]) + ridge,
            points.T @ (y - p) - ridge @ beta,
        )
        beta = beta + step
        if np.abs(step).max() < 1e-10:
            break
    return float(beta[0] / scale), float(beta[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    learn: Column | None = None,
    labelled: int = LABELLED,
) -> QualityModel:
    """Dictionaries and curve from labelled rows; ``learn`` restricts the labels used."""
    known = labels if learn is None else labels.where(learn)
    known = known.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    ).where("doc_id is not null and label in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("high"))
    rank = F.xxhash64(F.col("doc_id"), F.lit("quality"))
    known = (
        known.where("label = high").select("doc_id", "label", rank.alias("rank"))
        .orderBy("rank", "doc_id").limit(labelled)
    )
    # the sample has a fixed bound, so it may be broadcast
    sample = F.broadcast(materialise(known.withColumn("calibrate", F.col("rank") % 3 == 0)))
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = body.join(sample, "doc_id").select("doc_id", "label", "calibrate", "text")
    blocks = materialise(
        _blocks(rows.where("not calibrate").select("doc_id", "label", "text"), BLOCKS)
    )
    chosen: dict[int, list[bytes]] = {}
    for side in (0, 1):
        best = blocks.where(F.col("label") == side).orderBy("rank", "block").limit(BLOCKS)
        chosen[side] = [bytes(r["block"]) for r in best.select("block").collect()]
    good, bad = _dictionary(chosen[1]), _dictionary(chosen[0])
    held = differences(rows.where("calibrate").select("doc_id", "label", "text"), good, bad)
    pairs = held.select("difference", "label").limit(labelled).collect()
    y = np.array([r["label"] for r in pairs], float)
    if len(y) == 0 or y.min() == y.max():
        seen = {r["label"] for r in known.select("label").distinct().collect()}
        if len(seen) != 1:
            return QualityModel(good, bad, 0.0 if not seen else 20.0, 0.0)
        return QualityModel(good, bad, 0.0, 700.0 if seen == {1} else -700.0)
    slope, offset = _curve(np.array([r["difference"] for r in pairs]), y)
    return QualityModel(good, bad, slope, offset)


def score(
    docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, difference, score and predicted (1: good) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = differences(rows, model.good, model.bad)
    z = F.greatest(
        F.lit(-700.0), F.least(F.lit(700.0), F.col("difference") * model.slope + model.offset)
    )
    found = found.withColumn("score", 1.0 / (1.0 + F.exp(-z)))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows whose score reaches the threshold, with all their columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(model.good), Sizes(model.bad)
        for batch in batches:
            for part in slices(batch, text):
                raw, ends = bytes_of(texts_of(part.column(text)))
                view = memoryview(raw)
                keep = [
                    model.probability(difference(view[s:e], *sizes)) >= threshold
                    for s, e in zip(ends[:-1], ends[1:], strict=True)
                ]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(lean(work), docs.schema)

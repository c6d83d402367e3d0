"""Substring dedup by repeated phrases.

Every run of 13 words is hashed, and a hash that several documents share marks all of
them but the one with the smallest id, its origin.  Marked runs that follow each other in
one document, and share an origin, make up a candidate passage.  Passages are confirmed
word by word: the distinct passages of each shard are compiled into an Aho-Corasick
automaton, and the marked stretches of their origin documents are streamed through it.
Passages meet the documents by hash, so each document reaches only the shards that hold
something of it, and work grows with the text, not with documents times passages.

A passage not found in one piece is confirmed run by run; runs that only share a hash with
their origin stay in the text.

Defined results: words are compared unchanged.  NULL text has no words.  Texts with fewer
than 13 words lose nothing.  Runs are judged on the input.  Rows that repeat an id are
compared with smaller ids only, each on its own.  Rows with NULL id lose nothing and take
nothing from others.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.llm.flow import Packer, bucket_count, bucket_of, by_bucket, stage, unpack
from modeloom.llm.text import (
    coded_words,
    distinct_per_owner,
    hash_words,
    mix,
    owners,
    slices,
    texts_of,
    windows,
)

WIDTH = 13
LOW48 = np.uint64((1 << 48) - 1)
WINDOWS = (["doc", "low", "high"], ("doc",))
MARKS = (["doc", "origin", "low", "high"], ("doc", "origin"))


def _window_rows(docs: DataFrame, width: int, buckets: int) -> DataFrame:
    """Window hashes of each document, packed by bucket: 48 bits besides the bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(*WINDOWS)
        for batch in batches:
            for part in slices(batch, "text"):
                words, codes, offsets = coded_words(texts_of(part.column("text")))
                found, ends = windows(hash_words(words)[codes], offsets, width)
                owner, found = distinct_per_owner(owners(ends), found)
                packer.add(
                    bucket_of(found, buckets),
                    part.column("doc_id").to_numpy()[owner],
                    (found & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                    (found >> np.uint64(32)).astype(np.uint16),
                )
                if packer.full():
                    yield from packer.rows()
        yield from packer.rows()

    return docs.where("doc_id is not null").mapInArrow(work, Packer(*WINDOWS).schema())


def _shared(buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Marks of one bucket, packed by the document's bucket: documents to be cleaned
    (origin below doc) and the origins themselves (origin equals doc)."""

    def work(table: pa.Table) -> pa.Table:
        doc = unpack(table, "doc", "<i8")
        key = unpack(table, "low", "<u4") + (
            unpack(table, "high", "<u2").astype(np.uint64) << np.uint64(32)
        )
        order = np.lexsort((doc, key))
        doc, key = doc[order], key[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
        doc, key = doc[new], key[new]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        many = np.repeat(sizes > 1, sizes)
        doc, key, origin = doc[many], key[many], np.repeat(doc[starts], sizes)[many]
        order = np.lexsort((key, origin, doc))
        doc, key, origin = doc[order], key[order], origin[order]
        packer = Packer(*MARKS)
        packer.add(
            (doc % buckets).astype(np.int32),
            doc,
            origin,
            (key & np.uint64(0xFFFFFFFF)).astype(np.uint32),
            (key >> np.uint64(32)).astype(np.uint16),
        )
        rows = list(packer.rows())
        source = table.column("bucket")[0].as_py()
        empty = pa.table(
            [pa.array([], pa.int32())] + [pa.array([], pa.binary())] * 6, names=MARK_NAMES[:-1]
        )
        joined = pa.Table.from_batches(rows) if rows else empty
        return joined.append_column("source", pa.array([source] * joined.num_rows, pa.int32()))

    return work


MARK_NAMES = ["bucket", "doc_n", "doc", "origin_n", "origin", "low", "high", "source"]
MARK_SCHEMA = (
    "bucket int, doc_n binary, doc binary, origin_n binary, origin binary, low binary,"
    " high binary, source int"
)
# kind 0: result of a document; 1: stretch of an origin; 2: candidate passage
PART_SCHEMA = (
    "kind byte, doc_id long, origin long, start long, n_words long, n_removed long,"
    " kept_sha256 string, body string"
)


def _runs(flag: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of set flags; a set break starts a new run."""
    before = np.r_[False, flag[:-1]]
    start = flag & (~before | breaks)
    begins = np.flatnonzero(start)
    stop = flag & np.r_[start[1:] | ~flag[1:], True]
    return begins, np.flatnonzero(stop) + 1


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the intervals."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:n]) > 0


def _digest(words: np.ndarray) -> str:
    return hashlib.sha256(" ".join(words.tolist()).encode("utf-8", "surrogatepass")).hexdigest()


def _marked(width: int, buckets: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def work(_key: tuple, docs: pa.Table, marks: pa.Table) -> pa.Table:
        flag_doc, flag_origin = unpack(marks, "doc", "<i8"), unpack(marks, "origin", "<i8")
        low = unpack(marks, "low", "<u4") + (
            unpack(marks, "high", "<u2").astype(np.uint64) << np.uint64(32)
        )
        counts = [len(x.as_buffer()) // 4 for x in marks.column("low")]
        source = np.repeat(np.array(marks.column("source").to_pylist(), np.uint64), counts)
        # one number for document, bucket and hash
        flags = mix(low ^ mix(source, 31), 32) ^ mix(flag_doc.view(np.uint64), 33)
        order = np.argsort(flags)
        flags, flag_doc, flag_origin = flags[order], flag_doc[order], flag_origin[order]
        out: dict[str, list] = {name: [] for name in PARTS}

        def put(*row: object) -> None:
            for name, value in zip(PARTS, row, strict=True):
                out[name].append(value)

        for batch in docs.combine_chunks().to_batches():
            for part in slices(batch, "text"):
                ids = part.column("doc_id")
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                doc = ids.fill_null(0).to_numpy()
                words, codes, offsets = coded_words(texts_of(part.column("text")))
                names = np.array([*words, ""], object)[:-1]
                found, ends = windows(hash_words(words)[codes], offsets, width)
                owner = owners(ends)
                key = mix((found & LOW48) ^ mix(bucket_of(found, buckets).astype(np.uint64), 31), 32)
                key = key ^ mix(doc.view(np.uint64), 33)[owner]
                hit = np.zeros(len(key), bool)
                origin = np.zeros(len(key), np.int64)
                if len(flags):
                    at = np.minimum(np.searchsorted(flags, key), len(flags) - 1)
                    hit = (flags[at] == key) & known[owner]
                    origin = flag_origin[at]
                for i in range(len(offsets) - 1):
                    mine = names[codes[offsets[i] : offsets[i + 1]]]
                    span = slice(ends[i], ends[i + 1])
                    o, h = origin[span], hit[span]
                    take, give = h & (o != doc[i]), h & (o == doc[i])
                    if give.any():
                        for s, e in zip(*_runs(give, np.zeros(len(o), bool)), strict=True):
                            stretch = " ".join(mine[s : e + width - 1].tolist())
                            put(1, int(doc[i]), int(doc[i]), int(s), int(e - s), 0, None, stretch)
                    gone = np.zeros(len(mine), bool)
                    if take.any():
                        begins, stops = _runs(take, np.r_[True, o[1:] != o[:-1]])
                        for s, e in zip(begins, stops, strict=True):
                            passage = " ".join(mine[s : e + width - 1].tolist())
                            put(2, int(doc[i]), int(o[s]), int(s), int(e - s), 0, None, passage)
                        gone = _covered(len(mine), begins, stops + width - 1)
                    put(
                        0, int(doc[i]) if known[i] else None, None, 0, len(mine), int(gone.sum()),
                        _digest(mine[~gone]), None,
                    )
        return pa.table({n: pa.array(out[n], k) for n, k in PARTS.items()})

    return work


PARTS = {
    "kind": pa.int8(),
    "doc_id": pa.int64(),
    "origin": pa.int64(),
    "start": pa.int64(),
    "n_words": pa.int64(),
    "n_removed": pa.int64(),
    "kept_sha256": pa.string(),
    "body": pa.string(),
}


class Coder:
    """Words as short strings over small alphabets, so that automata branch little."""

    def __init__(self, bodies: list[str]):
        words = dict.fromkeys(w for b in bodies for w in b.split(" "))
        digits = 1
        while 64**digits < len(words):
            digits += 1
        self.code = {
            w: "".join(
                chr((256 if p == 0 else 32) + (n // 64**p) % 64) for p in range(digits)
            )
            for n, w in enumerate(words)
        }

    def encode(self, body: str) -> str:
        return "".join(map(self.code.__getitem__, body.split(" ")))


def locate(passages: list[str], stretches: list[str]) -> list[set[int]]:
    """For each stretch, the passages that occur in it word for word."""
    coder = Coder([*passages, *stretches])
    automaton = ahocorasick.Automaton()
    held: dict[str, list[int]] = {}
    for number, passage in enumerate(passages):
        held.setdefault(coder.encode(passage), []).append(number)
    for code, numbers in held.items():
        automaton.add_word(code, numbers)
    automaton.make_automaton()
    return [
        {number for _, numbers in automaton.iter(coder.encode(s)) for number in numbers}
        for s in stretches
    ]


def _confirm(width: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """(origin, body, sound): for passages not found whole, which of their runs are sound."""

    def work(_key: tuple, passages: pa.Table, stretches: pa.Table) -> pa.Table:
        origins, bodies = passages.column("origin").to_pylist(), passages.column("body").to_pylist()
        own, texts = stretches.column("origin").to_pylist(), stretches.column("body").to_pylist()
        found = np.zeros(len(bodies), bool)
        if bodies and texts:
            for origin, hits in zip(own, locate(bodies, texts), strict=True):
                for number in hits:
                    found[number] |= origins[number] == origin
        rows = []
        for number in np.flatnonzero(~found).tolist():
            runs: set[tuple[str, ...]] = set()
            for origin, text in zip(own, texts, strict=True):
                if origin == origins[number]:
                    w = text.split(" ")
                    runs |= {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
            w = bodies[number].split(" ")
            sound = [tuple(w[i : i + width]) in runs for i in range(len(w) - width + 1)]
            if not all(sound):
                rows.append((origins[number], bodies[number], sound))
        return pa.table(
            {
                "origin": pa.array([r[0] for r in rows], pa.int64()),
                "body": pa.array([r[1] for r in rows], pa.string()),
                "sound": pa.array([r[2] for r in rows], pa.list_(pa.bool_())),
            }
        )

    return work


def _again(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Results of documents from their sound runs alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, starts in zip(
                batch.column("doc_id").to_pylist(),
                batch.column("text").to_pylist(),
                batch.column("starts").to_pylist(),
                strict=True,
            ):
                words, codes, _ = coded_words(texts_of(pa.array([text], pa.large_string())))
                mine = np.array([*words, ""], object)[:-1][codes]
                at = np.array(starts or [], np.int64)
                gone = _covered(len(mine), at, at + width)
                rows.append((doc, len(mine), int(gone.sum()), _digest(mine[~gone])))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return work


def repeated_phrases(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_words, n_removed, kept_sha256) of every row, and the confirmed passages
    (doc_id, origin, start, n_runs, body)."""
    buckets = bucket_count(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    marks = by_bucket(_window_rows(rows, width, buckets), _shared(buckets), MARK_SCHEMA)
    dealt = rows.withColumn("bucket", F.coalesce(F.pmod("doc_id", F.lit(buckets)), F.lit(0)).cast("int"))
    parts = stage(
        dealt.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInArrow(
            _marked(width, buckets), PART_SCHEMA
        ),
        "parts",
    )
    results = parts.where("kind = 0").select("doc_id", "n_words", "n_removed", "kept_sha256")
    passages = parts.where("kind = 2")
    # a passage that many documents repeat is confirmed once
    shard = F.pmod(F.xxhash64("origin"), F.lit(buckets)).alias("shard")
    once = passages.select("origin", "body").distinct().select(shard, "origin", "body")
    stretches = parts.where("kind = 1").select(shard, "origin", "body")
    unsound = stage(
        once.groupBy("shard").cogroup(stretches.groupBy("shard")).applyInArrow(
            _confirm(width), "origin long, body string, sound array<boolean>"
        ),
        "unsound",
    )
    found = passages.select("doc_id", "origin", "start", F.col("n_words").alias("n_runs"), "body")
    if unsound.isEmpty():
        return results, found
    checked = found.join(unsound, ["origin", "body"], "left")
    affected = checked.where("sound is not null").select("doc_id").distinct()
    runs = F.when(
        F.col("sound").isNull(), F.sequence(F.lit(0), F.col("n_runs").cast("int") - 1)
    ).otherwise(F.filter(F.sequence(F.lit(0), F.size("sound") - 1), lambda i: F.get("sound", i)))
    starts = (
        checked.join(affected, "doc_id", "left_semi")
        .select("doc_id", F.transform(runs, lambda i: i + F.col("start")).alias("s"))
        .groupBy("doc_id").agg(F.flatten(F.collect_list("s")).alias("starts"))
    )
    redone = rows.join(starts, "doc_id").mapInArrow(
        _again(width), "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )
    rest = results.join(affected, "doc_id", "left_anti")
    return rest.union(redone), checked.where("sound is null").drop("sound")

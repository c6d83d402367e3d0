"""Language-model scores by Katz backoff over word pairs.

    p(w | h) = d(c(hw)) * c(hw) / c(h)     if the pair hw was seen
             = alpha(h) * p(w)             otherwise, and p(w) if h was not seen
    p(w)     = d(c(w)) * c(w) / N          if w was seen, else the mass that is left

``d`` are Good-Turing discounts for counts up to ``CUTOFF``, and ``KEPT`` above, so that every
history leaves some mass; ``alpha(h)`` makes the probabilities after h sum to one.
Statistics cover all training texts.

Word counts are aggregated first and kept as a table.  Then every pair travels once, to the
bucket of its word, where pair and word counts meet the documents' own pairs; sums per
document and masses per history travel on, and the buckets of histories settle the
backoff weights and what they add to each document.  Very frequent words, of which there
can be no more than four per bucket, are dealt to several buckets by their history.  The number
of buckets follows the bytes of text; a task works on one after the other and adds up the sums
of documents over all of them.

Defined results: NULL text is empty, and an empty text is one closing token.  Every row's text
is scored by itself; rows are known by a 63-bit hash of id and text, so those that share
an id are told apart, and equal rows count as often as they stand there.  Without
training text every word is unknown, and each token has probability 1.  An empty table
gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modeloom.llm.flow import (
    Packer,
    along_buckets,
    bucket_of,
    buckets_for,
    by_bucket,
    stage,
    unpack,
)
from modeloom.llm.text import hashed_words, lower, mix, owners, slices, texts_of

CUTOFF = 5
# Share of its count that a frequent pair or word keeps.
KEPT = 0.999
ADDED = 0.1
# Stand-ins for the end and the start of a text; no hash of a word is likely to equal them.
END = np.uint64(0xE4D0F7E87E000001)
START = np.uint64(0x57A27000A11CE003)
NO_ID = -(1 << 63)


def learnt_from(held_out: int) -> Column:
    """Whether the crc32 of a row's id, as text, is not divisible by ``held_out``."""
    name = F.coalesce("doc_id", F.lit(NO_ID)).cast("string").cast("binary")
    return F.crc32(name) % held_out != 0


def row_key(held_out: int) -> Column:
    """A hash of id and text, so that rows of one id are told apart; odd in training rows."""
    both = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    return F.shiftleft(both, 1).bitwiseOR(learnt_from(held_out).cast("long"))


def training(keys: np.ndarray) -> np.ndarray:
    """Whether each key stands for a training row."""
    return (keys & 1).astype(bool)


def discounts(counts_of_counts: dict[int, int]) -> list[float]:
    """Good-Turing discounts of the counts 1 to CUTOFF; beyond, ``KEPT``.

    Where the counts of counts are too uneven for Good-Turing, half a count is taken off.
    """
    n = [counts_of_counts.get(r, 0) for r in range(CUTOFF + 2)]
    if all(n[1:]):
        excess = (CUTOFF + 1) * n[CUTOFF + 1] / n[1]
        found = [
            ((r + 1) * n[r + 1] / (r * n[r]) - excess) / (1 - excess) if excess != 1 else 0.0
            for r in range(1, CUTOFF + 1)
        ]
        if all(0 < d < 1 for d in found):
            return [*found, KEPT]
    return [*((r - 0.5) / r for r in range(1, CUTOFF + 1)), KEPT]


@dataclass(frozen=True)
class Unigrams:
    """Totals and discounts of the word distribution."""

    tokens: int
    distinct: int
    discount: tuple[float, ...]
    scale: float
    unknown: float

    def probability(self, counts: np.ndarray) -> np.ndarray:
        d = np.array(self.discount)[np.clip(counts, 1, CUTOFF + 1) - 1]
        seen = self.scale * d * counts / max(self.tokens, 1)
        return np.where(counts > 0, seen, self.unknown)


def _token_rows(
    batch: pa.RecordBatch,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the rows, and for each token its text's index, itself and its history."""
    hashes, offsets = hashed_words(lower(texts_of(batch.column("text"))))
    keys = batch.column("key").to_numpy()
    closed = offsets + np.arange(len(offsets))
    words = np.full(closed[-1], END, np.uint64)
    keep = np.ones(len(words), bool)
    keep[closed[1:] - 1] = False
    words[keep] = hashes
    history = np.r_[START, words[:-1]][: len(words)]
    history[closed[:-1]] = START
    return keys, owners(closed), words, history


def word_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """(word, n): occurrences of each word, by hash, in the training texts."""
    names = ["word", "n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(names)
        for batch in batches:
            for part in slices(batch, "text"):
                keys, owner, words, _ = _token_rows(part)
                word, n = np.unique(words[training(keys)[owner]], return_counts=True)
                packer.add(bucket_of(word, buckets), word, n.astype(np.uint32))
                if packer.full():
                    yield from packer.rows()
        yield from packer.rows()

    def total(table: pa.Table) -> pa.Table:
        word, at = np.unique(unpack(table, "word", "<u8"), return_inverse=True)
        n = np.bincount(at, weights=unpack(table, "n", "<u4"), minlength=len(word))
        return pa.table({"word": word.view(np.int64), "n": n.astype(np.int64)})

    return by_bucket(
        docs.mapInArrow(work, Packer(names).schema()), total, "word long, n long"
    )


def unigrams(counts: DataFrame) -> Unigrams:
    """Totals and discounts from the table of word counts."""
    small = F.least("n", F.lit(CUTOFF + 2))
    rows = counts.groupBy(small.alias("r")).agg(
        F.count("*").alias("types"), F.sum("n").alias("tokens")
    ).collect()  # one row per small count
    tokens, distinct = sum(r["tokens"] for r in rows), sum(r["types"] for r in rows)
    discount = discounts({r["r"]: r["types"] for r in rows if r["r"] <= CUTOFF + 1})
    seen = sum(discount[min(r["r"], CUTOFF + 1) - 1] * r["tokens"] for r in rows)
    if tokens == 0:
        return Unigrams(0, 0, tuple(discount), 1.0, 1.0)
    # what is left for unknown words, at least the share of one more token
    left = max(1.0 - seen / tokens, 1.0 / (tokens + 1))
    return Unigrams(tokens, distinct, tuple(discount), (1.0 - left) * tokens / seen, left)


PAIRS = (["word", "history", "doc"], ("word", "history"))
# Text whose pairs are packed together: more of them repeat, and fewer bytes are moved.
PACK_BYTES = 20 << 20
# Histories are told apart by 48 bits of their hashes.
HISTORY = np.uint64((1 << 48) - 1)


def _six_bytes(hashes: np.ndarray) -> bytes:
    """The lower 48 bits of each number, little-endian."""
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _pairs(docs: DataFrame, buckets: int, heavy: dict[int, int]) -> DataFrame:
    """Every token with its history, packed by bucket of the token.

    ``docs`` lists the keys of the documents in a packed row, of which ``doc`` is the index.
    """
    heavy_words = np.array(sorted(heavy), np.uint64)
    ways = np.array([heavy[w] for w in sorted(heavy)], np.uint64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PACK_BYTES):
                ids, owner, words, history = _token_rows(part)
                history &= HISTORY
                bucket = bucket_of(words, buckets)
                if len(heavy_words):
                    at = np.minimum(np.searchsorted(heavy_words, words), len(heavy_words) - 1)
                    hot = heavy_words[at] == words
                    part_of = mix(history[hot], 21) % ways[at[hot]]
                    bucket[hot] = bucket_of(mix(words[hot] + part_of, 22), buckets)
                order = np.lexsort((owner, history, words))
                packer = Packer(*PAIRS)
                packer.add(bucket[order], words[order], history[order], owner[order].astype(np.uint32))
                for rows in packer.rows():
                    lists, codes, short = [], [], []
                    for x in rows.column("history"):
                        h = np.frombuffer(x.as_buffer(), "<u8")
                        short.append(_six_bytes(h))
                    at = rows.schema.get_field_index("history")
                    rows = rows.set_column(at, "history", pa.array(short, pa.binary()))
                    for x in rows.column("doc"):
                        own, code = np.unique(np.frombuffer(x.as_buffer(), "<u4"), return_inverse=True)
                        lists.append(ids[own].tobytes())
                        kind = np.uint16 if len(own) <= 1 << 16 else np.uint32
                        codes.append(code.astype(kind).tobytes())
                    at = rows.schema.get_field_index("doc")
                    rows = rows.set_column(at, "doc", pa.array(codes, pa.binary()))
                    yield rows.append_column("docs", pa.array(lists, pa.binary()))

    return docs.mapInArrow(work, Packer(*PAIRS).schema() + ", docs binary")


# What a word's bucket sends on: sums per document (kind 0), masses of histories (kind 1),
# unseen pairs (kind 2) and counts of pair counts (kind 3).
MEETS = "kind byte, bucket int, keys binary, numbers binary"
# Sums of a document: tokens, known tokens, base score, score without what discounts and
# histories add, and pairs seen 1 to CUTOFF times and more often.
SUMS = np.dtype(
    [("n", "<u4"), ("known", "<u4"), ("base", "<f8"), ("score", "<f8"),
     ("seen", "<u4", (CUTOFF + 1,))]
)
MASSES = np.dtype([("r", "<u1"), ("total", "<u4"), ("mass", "<f8")])
# Entries of a bucket looked at together.
CHUNK = 400_000
# Sums of documents that a task holds before it adds up those of one document.
MOST_SUMS = 1_000_000


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word, history and document index of every entry, and the documents' keys."""
    ids, code, done = [], [], 0
    for listed, index in zip(table.column("docs"), table.column("doc"), strict=True):
        own = np.frombuffer(listed.as_buffer(), "<i8")
        kind = "<u2" if len(own) <= 1 << 16 else "<u4"
        code.append(np.frombuffer(index.as_buffer(), kind).astype(np.int32) + np.int32(done))
        ids.append(own)
        done += len(own)
    ids, inverse = np.unique(np.concatenate(ids), return_inverse=True)
    doc = inverse.astype(np.int32)[np.concatenate(code)]
    raw = [np.frombuffer(x.as_buffer(), np.uint8).reshape(-1, 6) for x in table.column("history")]
    history = np.zeros((sum(map(len, raw)), 8), np.uint8)
    history[:, :6] = np.concatenate(raw)
    history = np.repeat(history.view("<u8")[:, 0], unpack(table, "history_n", "<u4"))
    return unpack(table, "word", "<u8"), history, doc, ids


def _meet(
    word: np.ndarray, history: np.ndarray, doc: np.ndarray, train: np.ndarray,
    model: Unigrams, counts: dict[int, int], sums: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of whole words' entries, added to ``sums``; returns the masses of histories,
    and the histories and documents of unseen pairs, and the counts of pair counts."""
    order = np.lexsort((history, word))
    word, history, doc = word[order], history[order], doc[order]
    learnt = train[doc].astype(np.int64)
    new_word = np.r_[True, word[1:] != word[:-1]]
    new_pair = new_word | np.r_[True, history[1:] != history[:-1]]
    starts, word_starts = np.flatnonzero(new_pair), np.flatnonzero(new_word)
    c_pair, c_word = np.add.reduceat(learnt, starts), np.add.reduceat(learnt, word_starts)
    for at, w in enumerate(word[word_starts].tolist()):
        if w in counts:
            c_word[at] = counts[w]
    pair_word = np.cumsum(new_word)[starts] - 1
    p_word = model.probability(c_word)
    per = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(word)]))
    c, w = c_pair[per], c_word[pair_word[per]]
    unseen, known, frequent = c == 0, w > 0, c > CUTOFF
    n = len(sums)

    def summed(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=n)

    base = np.log10((w + ADDED) / (model.tokens + ADDED * (model.distinct + 1)))
    # as histories, known words divide what follows them by their count
    score = np.where(known & (word != END), -np.log10(np.maximum(w, 1)), 0.0)
    score += np.where(unseen, np.log10(p_word[pair_word[per]]), 0.0)
    score += np.where(frequent, np.log10(np.maximum(c, 1)), 0.0)
    sums["n"] += np.bincount(doc, minlength=n).astype(np.uint32)
    sums["known"] += summed(known).astype(np.uint32)
    sums["base"] += summed(base)
    sums["score"] += summed(score)
    place = np.minimum(c, CUTOFF + 1)
    for r in range(1, CUTOFF + 2):
        sums["seen"][:, r - 1] += summed(place == r).astype(np.uint32)
    seen = c_pair > 0
    types = np.bincount(np.minimum(c_pair[seen], CUTOFF + 2), minlength=CUTOFF + 3)
    h, r = history[starts][seen], np.minimum(c_pair[seen], CUTOFF + 1)
    order = np.lexsort((r, h))
    h, r, total = h[order], r[order], c_pair[seen][order]
    mass = p_word[pair_word[seen]][order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])][: len(h)])
    masses = np.zeros(len(first), MASSES)
    if len(first):
        masses["r"], masses["total"] = r[first], np.add.reduceat(total, first)
        masses["mass"] = np.add.reduceat(mass, first)
    return h[first], masses, history[unseen], doc[unseen], types


class Sums:
    """Sums per document, added up until they are many."""

    def __init__(self) -> None:
        self.ids: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.held = 0

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids.append(ids)
        self.rows.append(rows)
        self.held += len(ids)
        if self.held > MOST_SUMS:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        """Each document once, with its sums."""
        ids, at = np.unique(np.concatenate(self.ids), return_inverse=True)
        rows = np.concatenate(self.rows)
        total = np.zeros(len(ids), rows.dtype)
        for name in rows.dtype.names:
            np.add.at(total[name], at, rows[name])
        self.ids, self.rows, self.held = [ids], [total], len(ids)
        return ids, total

    def full(self) -> bool:
        """Whether the sums of different documents take all the room."""
        return self.held > MOST_SUMS // 2 and len(self.ids) == 1

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        found = self.merge()
        self.ids, self.rows, self.held = [], [], 0
        return found


def _words_met(
    model: Unigrams, buckets: int, counts: dict[int, int]
) -> Callable[[Iterator[pa.Table]], Iterator[pa.RecordBatch]]:
    def sent(kind: int, keys: np.ndarray, at: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(at[order]) != 0][: len(at)])
        rows = np.split(order, cuts[1:]) if len(at) else []
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(rows), kind, np.int8)),
                pa.array([int(at[r[0]]) for r in rows], pa.int32()),
                pa.array([keys[r].tobytes() for r in rows], pa.binary()),
                pa.array([numbers[r].tobytes() for r in rows], pa.binary()),
            ],
            names=["kind", "bucket", "keys", "numbers"],
        )

    def of_documents(ids: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return sent(0, ids, bucket_of(mix(ids.view(np.uint64), 23), buckets), sums)

    def work(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        documents, types = Sums(), np.zeros(CUTOFF + 3, np.int64)
        for table in tables:
            word, history, doc, ids = _unpacked(table)
            train, sums = training(ids), np.zeros(len(ids), SUMS)
            ways = -(-len(word) // CHUNK)
            part = (mix(word, 24) % np.uint64(ways)).astype(np.uint16 if ways < 1 << 16 else np.int64)
            met = []
            for way in range(ways):
                at = np.flatnonzero(part == way)
                if len(at):
                    met.append(_meet(word[at], history[at], doc[at], train, model, counts, sums))
            h, masses, wanted, where, kinds = (
                np.concatenate(x) if i < 4 else sum(x) for i, x in enumerate(zip(*met, strict=True))
            )
            types += kinds
            documents.add(ids, sums)
            yield sent(1, h, bucket_of(mix(h, 25), buckets), masses)
            yield sent(2, wanted, bucket_of(mix(wanted, 25), buckets), ids[where])
            if documents.full():
                yield of_documents(*documents.take())
        if documents.held:
            yield of_documents(*documents.take())
        yield sent(3, np.zeros(1, "<i8"), np.zeros(1, np.int32), types.astype("<i8")[None, :])

    return work


SETTLED = np.dtype(
    [("n_tokens", "<i8"), ("n_known", "<i8"), ("base_score", "<f8"), ("score", "<f8")]
)


def _settled(discount: list[float]) -> Callable[[Iterator[pa.Table]], Iterator[pa.RecordBatch]]:
    """Per document, the sums of a task's buckets, with backoff weights put in."""
    d = np.array(discount)
    gains = np.log10(d * np.r_[1 : CUTOFF + 1, 1])

    def packed(table: pa.Table, kind: int, name: str, dtype: object) -> np.ndarray:
        kinds = table.column("kind").to_numpy()
        rows = table.column(name).take(pa.array(np.flatnonzero(kinds == kind)))
        pieces = [np.frombuffer(x.as_buffer(), dtype) for x in rows]
        return np.concatenate(pieces) if pieces else np.zeros(0, dtype)

    def without_backoff(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        parts = packed(table, 0, "numbers", SUMS)
        rows = np.zeros(len(parts), SETTLED)
        rows["n_tokens"], rows["n_known"] = parts["n"], parts["known"]
        rows["base_score"] = parts["base"]
        rows["score"] = parts["score"] + parts["seen"] @ gains
        return packed(table, 0, "keys", "<i8"), rows

    def backoff(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        h, at = np.unique(packed(table, 1, "keys", "<u8"), return_inverse=True)
        parts = packed(table, 1, "numbers", MASSES)
        wanted = packed(table, 2, "keys", "<u8")
        doc = packed(table, 2, "numbers", "<i8")
        if not len(h) or not len(wanted):
            return np.zeros(0, np.int64), np.zeros(0, SETTLED)
        count = np.bincount(at, weights=parts["total"], minlength=len(h))
        kept = np.bincount(at, weights=parts["total"] * d[parts["r"] - 1], minlength=len(h))
        mass = np.bincount(at, weights=parts["mass"], minlength=len(h))
        # alpha(h) * c(h): the count undoes the division that every token went through
        weight = np.log10((count - kept) / np.maximum(1.0 - mass, 1e-300))
        place = np.minimum(np.searchsorted(h, wanted), len(h) - 1)
        met = h[place] == wanted
        back, where = np.unique(doc[met], return_inverse=True)
        rows = np.zeros(len(back), SETTLED)
        rows["score"] = np.bincount(where, weights=weight[place[met]], minlength=len(back))
        return back, rows

    def batch(ids: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64())]
            + [pa.array(np.ascontiguousarray(sums[name])) for name in SETTLED.names],
            names=["id", *SETTLED.names],
        )

    def work(tables: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        documents = Sums()
        for table in tables:
            documents.add(*without_backoff(table))
            documents.add(*backoff(table))
            if documents.full():
                yield batch(*documents.take())
        if documents.held:
            yield batch(*documents.take())

    return work


def katz_scores(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held_out: int = 10
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keyed = rows.select(row_key(held_out).alias("key"), "text")
    buckets = buckets_for(rows, factor=1)
    table = stage(word_counts(keyed, buckets), "words")
    model = unigrams(table)
    # at most 4 * buckets words can be this frequent
    least = max(model.tokens // (4 * buckets), 1)
    frequent = {
        r["word"] & 0xFFFFFFFFFFFFFFFF: r["n"]
        for r in table.where(F.col("n") > least).collect()
    }
    heavy = {w: math.ceil(n / least) for w, n in frequent.items()}
    met = stage(
        along_buckets(
            _pairs(keyed, buckets, heavy),
            _words_met(model, buckets, frequent),
            MEETS,
            buckets,
        ),
        "pairs",
    )
    types = np.zeros(CUTOFF + 3, np.int64)
    # one row of a few numbers per bucket
    for row in met.where("kind = 3").select("numbers").collect():
        types += np.frombuffer(bytes(row["numbers"]), "<i8")
    discount = discounts({r: int(types[r]) for r in range(1, CUTOFF + 2)})
    # the start of a text is a history too, counted once per training document
    documents = rows.where(learnt_from(held_out)).count()
    settled = along_buckets(
        met.where("kind < 3"),
        _settled(discount),
        "id long, n_tokens long, n_known long, base_score double, score double",
        buckets,
    )
    scores = settled.groupBy("id").agg(
        *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score"))
    )
    # equal rows were added up under one key
    copies = rows.select(row_key(held_out).alias("id"), "doc_id").groupBy("id").agg(
        F.count("*").alias("copies"), F.first("doc_id").alias("doc_id")
    )
    start = F.lit(math.log10(max(documents, 1)))
    one = copies.join(scores, "id").select(
        "doc_id",
        (~learnt_from(held_out)).alias("held_out"),
        *(F.expr(f"{c} div copies").alias(c) for c in ("n_tokens", "n_known")),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") / F.col("copies")).alias("base_score"),
        (F.col("score") / F.col("copies") - start).alias("score"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"),
    )
    return one.drop("copy")

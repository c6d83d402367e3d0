"""Ranked lexical search by presence-mask grouping.

Documents are indexed in blocks: for each term that some item asks for, the documents of the
block that hold it and how often.  For an item, every document of a block gets a mask with one
bit for each of the item's terms, set by bitmap operations from the posting lists; documents
with the same mask form a group.  A mask's score cannot exceed the sum over its bits of the
term's weight times the term's largest share in the block.  Groups are scored in falling order
of that limit and a block is finished when no group left can reach the lowest of the best ten.

The terms asked for reach the indexing tasks as a bitmap of 2**24 bits (2 MB whatever the
number of items); terms it lets through by chance are dropped by the join with the items.  Items
visit the index in chunks of ``CHUNK_TERMS`` terms, one job a chunk.

Defined results: a NULL or empty text holds no term, such documents are in no ranking and are not
counted.  Every row of ``documents`` is a document, also where rows share an id or have none; a
NULL id comes last among equal scores.  Rows of ``benchmark`` that share an id (or have none)
are one item that asks for the terms of all of them.  An item without terms, or whose terms
no document holds, has no rows.  Empty tables give an empty table.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from modeloom.llm.flow import running_total, stage
from modeloom.llm.text import bytes_of, coded_words, owners, slices, texts_of
from modeloom.plans.staging import staging_path

TOP = 10
# Fixed values of the score: share of the length in a document's norm, in per cent.
LENGTH_SHARE = 75
# Bits of the filter of asked terms, and of one of Spark's bitmaps.
FILTER_BITS = 1 << 24
BITMAP_BITS = 1 << 15
# A block is closed at so many documents or postings.
BLOCK_DOCS = 8192
BLOCK_POSTINGS = 1 << 21
# Pairs of item and term that visit the index in one job.
CHUNK_TERMS = 1 << 18
NO_ID = np.iinfo(np.int64).max

# Bytes of terms: 0-9, a-z, all bytes of characters beyond ASCII; A-Z become a-z.
FOLD = np.full(256, 32, np.uint8)
FOLD[48:58] = np.arange(48, 58)
FOLD[65:91] = np.arange(97, 123)
FOLD[97:123] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)

BLOCK_SCHEMA = (
    "ids binary, no_id binary, sizes binary, terms array<string>, counts array<long>,"
    " places binary, times binary, n_docs long, n_terms long"
)
RESULT = "item_id long, doc_id long, score long"


def folded(texts: pa.Array) -> pa.Array:
    """Texts with terms in lower case and a space in place of every other character."""
    raw, offsets = bytes_of(texts)
    data = FOLD[raw[offsets[0] : offsets[-1]]]
    return pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(data)
    )


def filter_places(terms: list[str]) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))
    return (hashes % np.uint64(FILTER_BITS)).astype(np.int64)


def term_counts(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms; (text, term, times) of every pair; and each text's number of terms."""
    words, codes, offsets = coded_words(folded(texts))
    pairs, times = np.unique(owners(offsets) * len(words) + codes, return_counts=True)
    return words, pairs // max(1, len(words)), pairs % max(1, len(words)), times, np.diff(offsets)


def asked_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term, place, times) of every term an item asks for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, text, term, times, _ = term_counts(texts_of(part.column("text")))
                ids = part.column("item_id").take(pa.array(text))
                names = pa.array(words, pa.string()).take(pa.array(term))
                places = filter_places(words)[term] if len(words) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids, names, pa.array(places), pa.array(times)],
                    names=["item_id", "term", "place", "times"],
                )

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    rows = rows.mapInArrow(work, "item_id long, term string, place long, times long")
    return rows.groupBy("item_id", "term", "place").agg(F.sum("times").alias("times"))


def term_filter(asked: DataFrame) -> np.ndarray:
    """The asked terms as one array of flags, from at most 512 bitmaps of 4 KB."""
    place = F.col("place") + 1
    maps = asked.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    flags = np.zeros(FILTER_BITS, bool)
    for row in maps.collect():
        start = (row["bucket"] - 1) * BITMAP_BITS
        bits = np.frombuffer(bytes(row["bits"]), np.uint8)
        flags[start : start + BITMAP_BITS] = np.unpackbits(bits, bitorder="little")[:BITMAP_BITS]
    return flags


class BlockWriter:
    """Gathers postings of documents until a block is full."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.no_id: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.terms: dict[str, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.docs = self.postings = self.n_docs = self.n_terms = 0

    def add(self, ids, no_id, sizes, words, text, term, times) -> None:
        """Documents and their (text, term, times); only those with a posting are kept."""
        self.n_docs += int((sizes > 0).sum())
        self.n_terms += int(sizes.sum())
        if not len(text):
            return
        held, text = np.unique(text, return_inverse=True)
        used, term = np.unique(term, return_inverse=True)
        code = np.array([self.terms.setdefault(words[i], len(self.terms)) for i in used], np.int64)
        self.parts.append((code[term], text + self.docs, times))
        self.ids.append(ids[held])
        self.no_id.append(no_id[held])
        self.sizes.append(sizes[held])
        self.docs += len(held)
        self.postings += len(text)

    def full(self) -> bool:
        return self.docs >= BLOCK_DOCS or self.postings >= BLOCK_POSTINGS

    def block(self) -> pa.RecordBatch:
        code, place, times = (
            (np.concatenate(a) for a in zip(*self.parts, strict=True))
            if self.parts
            else (np.zeros(0, np.int64),) * 3
        )
        order = np.lexsort((place, code))
        counts = np.bincount(code, minlength=len(self.terms)).astype(np.int64)

        def packed(parts, kind):
            return np.concatenate([*parts, np.zeros(0, kind)]).astype(kind).tobytes()

        row = {
            "ids": packed(self.ids, "<i8"), "no_id": packed(self.no_id, "?"),
            "sizes": packed(self.sizes, "<i8"), "terms": list(self.terms),
            "counts": counts.tolist(), "places": packed([place[order]], "<u4"),
            "times": packed([times[order]], "<i8"), "n_docs": self.n_docs, "n_terms": self.n_terms,
        }
        kinds = [pa.binary()] * 3 + [pa.list_(pa.string()), pa.list_(pa.int64())]
        kinds += [pa.binary()] * 2 + [pa.int64()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in zip(row.values(), kinds, strict=True)],
            names=list(row),
        )


def index_blocks(docs: DataFrame, flags: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """Blocks of postings of the flagged terms; their counts cover all documents and terms."""
    filter_bits = np.packbits(flags).tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(np.frombuffer(filter_bits, np.uint8)).astype(bool)
        known: dict[str, bool] = {}
        out = BlockWriter()
        for batch in batches:
            for part in slices(batch, "text"):
                words, codes, offsets = coded_words(folded(texts_of(part.column("text"))))
                fresh = [w for w in words if w not in known]
                if len(known) > 1 << 20:
                    known, fresh = {}, words
                known.update(zip(fresh, flags[filter_places(fresh)].tolist(), strict=True))
                kept = np.fromiter((known[w] for w in words), bool, len(words))
                keep = kept[codes] if len(words) else np.zeros(0, bool)
                pairs, times = np.unique(
                    owners(offsets)[keep] * len(words) + codes[keep], return_counts=True
                )
                ids = part.column("doc_id")
                no_id = ids.is_null().to_numpy(zero_copy_only=False)
                numbers = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)
                sizes = np.diff(offsets)
                text, term = np.divmod(pairs, max(1, len(words)))
                # documents enter in runs that fit the block
                for low in range(0, len(sizes), BLOCK_DOCS):
                    high = min(low + BLOCK_DOCS, len(sizes))
                    a, b = np.searchsorted(text, [low, high])
                    at = slice(low, high)
                    out.add(
                        numbers[at], no_id[at], sizes[at], words,
                        text[a:b] - low, term[a:b], times[a:b],
                    )
                    if out.full():
                        yield out.block()
                        out = BlockWriter()
        if out.n_docs:
            yield out.block()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(work, BLOCK_SCHEMA)


class Block:
    """One block as read back, with every posting's share of the score."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.no_id = np.frombuffer(row["no_id"], "?")
        sizes = np.frombuffer(row["sizes"], "<i8")
        self.place = {term: i for i, term in enumerate(row["terms"])}
        self.ends = np.r_[0, np.cumsum(row["counts"], dtype=np.int64)]
        self.places = np.frombuffer(row["places"], "<u4")
        times = np.frombuffer(row["times"], "<i8")
        norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * sizes * n_docs) // n_terms
        self.shares = (1_000_000_000 * times) // (1000 * times + 8 * norm[self.places])
        self.largest = np.maximum.reduceat(self.shares, self.ends[:-1]) if len(times) else times

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.ends[term], self.ends[term + 1])
        return self.places[at], self.shares[at]


def masks(block: Block, terms: list[int]) -> np.ndarray:
    """For every document of the block, a bit for each of the terms it holds."""
    out = np.zeros((len(block.ids), -(-len(terms) // 64)), np.uint64)
    for bit, term in enumerate(terms):
        places, _ = block.postings(term)
        out[places, bit >> 6] |= np.uint64(1 << (bit & 63))
    return out


def groups(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct masks that are not empty; documents in the order of their masks; and where
    each mask's documents start and end among them."""
    docs = np.flatnonzero(bits.any(axis=1))
    if bits.shape[1] == 1:
        docs = docs[np.argsort(bits[docs, 0], kind="stable")]
    else:
        docs = docs[np.lexsort(bits[docs].T)]
    held = bits[docs]
    first = np.flatnonzero(np.r_[True, (held[1:] != held[:-1]).any(axis=1)]) if len(docs) else docs
    return held[first], docs, np.r_[first, len(docs)].astype(np.int64)


def best_of_block(
    block: Block, terms: list[int], weights: np.ndarray, top: int, floor: int
) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores of the block that may be among the ``top``, of those that score
    ``floor`` or more."""
    bits, docs, ends = groups(masks(block, terms))
    limit = np.zeros(len(bits), np.int64)
    for bit, term in enumerate(terms):
        held = (bits[:, bit >> 6] >> np.uint64(bit & 63)) & np.uint64(1)
        limit += held.astype(np.int64) * (weights[bit] * block.largest[term])
    order = np.argsort(-limit, kind="stable")
    reach = int(np.searchsorted(-limit[order], -floor, side="right"))
    found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, wanted = 0, top
    while at < reach:
        # the next groups that together hold as many documents as are wanted
        sizes = ends[order[at:reach] + 1] - ends[order[at:reach]]
        upto = at + 1 + int(np.searchsorted(np.cumsum(sizes), wanted))
        upto = min(upto, reach)
        some = np.sort(np.concatenate([docs[ends[g] : ends[g + 1]] for g in order[at:upto]]))
        total = np.zeros(len(some), np.int64)
        for bit, term in enumerate(terms):
            places, shares = block.postings(term)
            spot = np.searchsorted(places, some)
            spot[spot == len(places)] = 0
            hit = places[spot] == some
            total += np.where(hit, weights[bit] * shares[spot], 0)
        found, scores = np.r_[found, some], np.r_[scores, total]
        if len(scores) >= top:
            floor = max(floor, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
            keep = scores >= floor
            found, scores = found[keep], scores[keep]
            reach = min(reach, int(np.searchsorted(-limit[order], -floor, side="right")))
        at, wanted = upto, wanted * 4
    return found, scores


class Best:
    """The best documents so far of one item."""

    def __init__(self):
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.no_id = np.zeros(0, bool)

    def floor(self, top: int) -> int:
        return max(1, int(self.scores[-1])) if len(self.scores) == top else 1

    def merge(self, scores, ids, no_id, top: int) -> None:
        scores, ids = np.r_[self.scores, scores], np.r_[self.ids, ids]
        no_id = np.r_[self.no_id, no_id]
        order = np.lexsort((ids, no_id, -scores))[:top]
        self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]


def search_chunk(
    blocks: DataFrame, asked: list[tuple], n_docs: int, n_terms: int, top: int
) -> DataFrame:
    """The best ``top`` of every task for each item (id, terms, weights)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best() for _ in asked]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1).to_pylist()[0], n_docs, n_terms)
                for (_, terms, weights), found in zip(asked, best, strict=True):
                    held = [
                        (block.place[t], w)
                        for t, w in zip(terms, weights, strict=True)
                        if t in block.place
                    ]
                    if not held:
                        continue
                    # heavy terms first, so that masks are told apart by them
                    held.sort(key=lambda x: (-x[1], x[0]))
                    floor = found.floor(top)
                    docs, scores = best_of_block(
                        block, [t for t, _ in held], np.array([w for _, w in held], np.int64),
                        top, floor,
                    )
                    keep = scores >= floor
                    docs = docs[keep]
                    found.merge(scores[keep], block.ids[docs], block.no_id[docs], top)
        for low in range(0, len(asked), 1024):
            part = range(low, min(low + 1024, len(asked)))
            items = [asked[i][0] for i in part for _ in best[i].scores]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(items, pa.int64()),
                    pa.array(
                        np.concatenate([best[i].ids for i in part]), pa.int64(),
                        mask=np.concatenate([best[i].no_id for i in part]),
                    ),
                    pa.array(np.concatenate([best[i].scores for i in part]), pa.int64()),
                ],
                names=["item_id", "doc_id", "score"],
            )

    return blocks.mapInArrow(work, RESULT)


def weighted_items(asked: DataFrame, blocks: DataFrame, n_docs: int) -> DataFrame:
    """(item_id, terms, weights): each term that counts, with weight times repeats."""
    found = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    df = found.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("df"))
    odds = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(F.lit(1000.0) * F.log(odds)) * F.col("times")
    rows = asked.join(df, "term").withColumn("weight", weight).where("weight > 0")
    return rows.groupBy("item_id").agg(
        F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("asked"),
        F.count("*").alias("n"),
    )


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of every item."""
    spark: SparkSession = docs.sparkSession
    asked = stage(asked_terms(items, item_id, item_text), "asked")
    blocks = stage(index_blocks(docs, term_filter(asked), doc_id, text), "blocks")
    total = blocks.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    n_docs, n_terms = total["docs"] or 0, total["terms"] or 0
    queries, size = running_total(weighted_items(asked, blocks, n_docs), ["item_id"], "n")
    queries = stage(queries, "items")
    path = staging_path(spark, "ranked")
    # an empty first write gives the table its columns where nothing is found
    spark.createDataFrame([], RESULT + ", rank int").write.parquet(path)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for low in range(0, size, CHUNK_TERMS):
        rows = queries.where(F.col("before").between(low, low + CHUNK_TERMS - 1)).collect()
        chunk = [
            (r["item_id"], [x["term"] for x in r["asked"]], [x["weight"] for x in r["asked"]])
            for r in rows
        ]
        found = search_chunk(blocks, chunk, n_docs, n_terms, top)
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        found.write.mode("append").parquet(path)
    results = spark.read.schema(RESULT + ", rank int").parquet(path)
    return results.select("item_id", "rank", "doc_id", "score")

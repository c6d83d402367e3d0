"""Fuzzy line dedup by MinHash.

A line is compared in a plain form: A-Z in lower case, runs of white space as one space.
Lines of at least ``LEAST`` characters are given the set of their character 5-shingles and
a MinHash signature of ``BANDS`` bands of ``ROWS`` minima; lines that agree in a band are
candidates (a pair of similarity 0.8 is found with probability 0.996).  Candidates are
compared by their exact Jaccard similarity, links of 0.8 and more are joined by
distributed union-find, and of each component one line stays: the first by document id
and line number.  Equal plain lines are one node, so common lines are compared once.
A shorter line has the whole line as its only shingle, so it links with equal lines only;
these are its node already, and it needs no signature.

Defined results: lines end at "\\n"; blank lines always stay.  NULL text has no
lines and stays NULL; an empty text stays empty.  Rows that repeat an id are told apart by
their text; equal rows stay or lose lines alike.  A NULL id counts as the smallest.  An empty
table gives an empty table.  Other columns pass through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modeloom.llm.closure import FOUND, candidates, closed_components, groups_of, sketches
from modeloom.llm.flow import (
    Packer,
    bucket_of,
    buckets_for,
    by_bucket,
    lean,
    stage,
    unpack,
    unused,
)
from modeloom.llm.text import (
    LOWER,
    MULTIPLIER,
    lower,
    mix,
    owners,
    ragged,
    slices,
    texts_of,
)

WIDTH = 5
BANDS = 14
ROWS = 5
# Characters of the shortest line that has shingles besides itself.
LEAST = WIDTH
SKETCH_BITS = 256
FACTORS = 2 * np.random.default_rng(1997).integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) + 1
# Characters shingled at once: their hashes stay in a processor's cache.
CHUNK = 1 << 17
# Bytes of signatures that a task gathers before it sends them on.
PACKED = 16 << 20
LINE_SHIFT, HASH_SHIFT = np.uint64(40), np.uint64(24)
HASH_MASK = np.uint64((1 << 40) - 1)
# A-Z in lower case, and white space inside a line as spaces.
FORM = LOWER.copy()
FORM[[9, 11, 12, 13]] = 32
SPACES = re.compile("  +")
# Bits of a character of a shingle that is held as one number, and pairs compared at once.
POINT_BITS = 12
PAIRS = 64


def plain_lines(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Plain form of every line that is not blank, its text's index and its number there."""
    lines, owner, number = [], [], []
    for at, text in enumerate(lower(texts, FORM).to_pylist()):
        if "  " in text:
            text = SPACES.sub(" ", text)
        for n, line in enumerate(text.split("\n")):
            form = line.strip(" ")
            if form:
                lines.append(form)
                owner.append(at)
                number.append(n)
    return lines, np.array(owner, np.int64), np.array(number, np.int64)


def shingled_lines(texts: pa.Array) -> list[str]:
    """Distinct plain lines that have shingles."""
    return list(dict.fromkeys(x for x in plain_lines(texts)[0] if len(x) >= LEAST))


def numbered_lines(texts: pa.Array, number: list[int], ends: list[int]) -> list[str]:
    """Plain forms of some lines; those of text k are ``number[ends[k - 1] : ends[k]]``."""
    out, start = [], 0
    for text, end in zip(lower(texts, FORM).to_pylist(), ends, strict=True):
        lines = text.split("\n")
        out += [SPACES.sub(" ", lines[n]).strip(" ") for n in number[start:end]]
        start = end
    return out


def chunks(lines: list[str], size: int = CHUNK) -> Iterator[list[str]]:
    """The lines in order, some at a time; longer lines are still taken whole."""
    held, total = [], 0
    for line in lines:
        held.append(line)
        total += len(line)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def line_nodes(lines: list[str]) -> np.ndarray:
    """64-bit hashes of plain lines."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))


def shingles(lines: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` characters of each line (none is shorter), and offsets."""
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.cumsum(sizes) - sizes
    counts = sizes - (width - 1)
    rolled = np.zeros(max(len(points) - width + 1, 0), np.uint64)
    for step in range(width):
        rolled = rolled * MULTIPLIER + points[step : step + len(rolled)]
    return mix(rolled[ragged(starts, counts)], 6), np.r_[0, np.cumsum(counts)]


def band_keys(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(line, band) keys from minima under multiplicative permutations of 32-bit hashes."""
    base = (hashes >> np.uint64(32)).astype(np.uint32)
    keys = np.zeros((len(offsets) - 1, BANDS), np.uint64)
    product = np.empty_like(base)
    for band in range(BANDS):
        key = np.full(len(offsets) - 1, band + 1, np.uint64)
        for row in range(ROWS):
            np.multiply(base, FACTORS[band * ROWS + row], out=product)
            key = key * MULTIPLIER + np.minimum.reduceat(product, offsets[:-1])
        keys[:, band] = mix(key, 12)
    return keys


def _occurrences(docs: DataFrame) -> DataFrame:
    """(doc, node, line) of every line compared."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                lines, owner, number = plain_lines(texts_of(part.column("text")))
                take = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(take),
                        part.column("body").take(take),
                        pa.array(line_nodes(lines).view(np.int64), pa.int64()),
                        pa.array(number, pa.int64()),
                    ],
                    names=["doc_id", "body", "node", "line"],
                )

    return docs.mapInArrow(lean(work), "doc_id long, body long, node long, line long")


SIGNED = ["node", "low", "high"]


def _signed(docs: DataFrame, buckets: int) -> DataFrame:
    """Band keys of distinct lines, packed by bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(SIGNED, limit=PACKED)
        for batch in batches:
            for part in slices(batch, "text"):
                for lines in chunks(shingled_lines(texts_of(part.column("text")))):
                    keys = band_keys(*shingles(lines)).reshape(-1)
                    packer.add(
                        bucket_of(keys, buckets),
                        np.repeat(line_nodes(lines), BANDS),
                        (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                        (keys >> np.uint64(32)).astype(np.uint16),
                    )
                    if packer.full():
                        yield from packer.rows()
        yield from packer.rows()

    return docs.select("text").mapInArrow(lean(work), Packer(SIGNED).schema())


def _groups(table: pa.Table) -> pa.Table:
    sign = unpack(table, "low", "<u4") + (
        unpack(table, "high", "<u2").astype(np.uint64) << np.uint64(32)
    )
    return groups_of(unpack(table, "node", "<u8"), sign)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task, one for each carrier: equal rows give equal lines.

    Rows of one carrier are in one task, unless they are so many that the join splits them; a
    line that a few tasks give again is compared again, which changes no component.
    """
    seen = np.zeros(0, np.int64)
    for batch in batches:
        # a node has one carrier, so its first tells carriers apart
        wanted = batch.column("wanted")
        first = wanted.flatten().field("node").to_numpy()
        sizes = pc.list_value_length(wanted).to_numpy().astype(np.int64)
        node, at = np.unique(first[np.cumsum(sizes) - sizes], return_index=True)
        at = np.sort(at[~np.isin(node, seen)])
        seen = np.concatenate([seen, node])
        yield batch.take(pa.array(at, pa.int64()))


def _known(docs: DataFrame, once: bool = False) -> DataFrame:
    """node, n (distinct shingles), sketch and plain form of some lines of ``docs``: text, and
    ``wanted``, the node and number of each such line.  ``once``: equal rows of a task count as
    one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _once(batches) if once else batches:
            for part in slices(batch, "text"):
                wanted = part.column("wanted").flatten()
                node = wanted.field("node")
                number = wanted.field("line").to_pylist()
                ends = np.cumsum(pc.list_value_length(part.column("wanted")).to_numpy()).tolist()
                texts = texts_of(part.column("text"))
                start = 0
                for lines in chunks(numbered_lines(texts, number, ends)):
                    hashes, offsets = shingles(lines)
                    # line and 40 bits of the hash in one number sort much faster than two keys
                    owner = owners(offsets).astype(np.uint64) << LINE_SHIFT
                    both = np.sort(owner | (hashes >> HASH_SHIFT))
                    both = both[np.r_[True, both[1:] != both[:-1]]]
                    sizes = np.bincount((both >> LINE_SHIFT).astype(np.int64), minlength=len(lines))
                    values = both & HASH_MASK
                    yield pa.RecordBatch.from_arrays(
                        [
                            node.slice(start, len(lines)),
                            pa.array(sizes, pa.int64()),
                            sketches(values, np.r_[0, np.cumsum(sizes)], SKETCH_BITS),
                            pa.array(lines, pa.string()),
                        ],
                        names=["node", "n", "sketch", "body"],
                    )
                    start += len(lines)

    return docs.mapInArrow(lean(work), "node long, n long, sketch binary, body string")


def similar_lines(ones: pa.Array, others: pa.Array) -> list[bool]:
    """Whether the character shingles of two lines reach Jaccard 0.8, for each two."""
    out = []
    for low in range(0, len(ones), PAIRS):
        x, y = (side.slice(low, PAIRS).to_pylist() for side in (ones, others))
        out += _similar(x, y)
    return out


def _similar(ones: list[str], others: list[str]) -> list[bool]:
    lines = [line for two in zip(ones, others, strict=True) for line in two]
    points = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4")
    if points.max() >> POINT_BITS:
        names, points = np.unique(points, return_inverse=True)
        if len(names) >> POINT_BITS:
            return [_similar_texts(x, y) for x, y in zip(ones, others, strict=True)]
    # a shingle's characters side by side in one number; the last ones of a line reach into
    # the next line and are left out
    points = points.astype(np.int64)
    packed = np.zeros(len(points) - WIDTH + 1, np.int64)
    for step in range(WIDTH):
        packed = packed << POINT_BITS | points[step : step + len(packed)]
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines))).tolist()
    out, start = [], 0
    for middle, end in zip(ends[::2], ends[1::2], strict=True):
        x, y = packed[start : middle - WIDTH + 1], packed[middle : end - WIDTH + 1]
        n, m, union = _distinct(x), _distinct(y), _distinct(np.concatenate([x, y]))
        out.append(100 * (n + m - union) >= 80 * union)
        start = end
    return out


def _distinct(values: np.ndarray) -> int:
    values = np.sort(values)
    return 1 + int(np.count_nonzero(values[1:] != values[:-1]))


def _similar_texts(one: str, other: str) -> bool:
    x, y = ({s[i : i + WIDTH] for i in range(len(s) - WIDTH + 1)} for s in (one, other))
    common = len(x & y)
    return 100 * common >= 80 * (len(x) + len(y) - common)


def line_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, body, node, line) of every line compared, and (node, component) of links.

    ``docs`` has doc_id, body (a hash that tells rows of one id apart) and text.
    """
    places = stage(_occurrences(docs), "lines")
    buckets = buckets_for(docs)
    found = stage(by_bucket(_signed(docs, buckets), _groups, FOUND), "groups")
    # one carrier document for each candidate; only its candidates are sketched
    # here and below the smaller side is hashed, so the larger one is not sorted
    carriers = (
        places.join(candidates(found).hint("shuffle_hash"), "node", "left_semi")
        .dropDuplicates(["node"])
        .groupBy("doc_id", "body")
        .agg(F.collect_list(F.struct("node", "line")).alias("wanted"))
    )
    carriers = carriers.hint("shuffle_hash")
    same = [docs[c].eqNullSafe(carriers[c]) for c in ("doc_id", "body")]
    carried = docs.join(carriers, same).select(docs["text"], "wanted")
    lines = stage(_known(carried, once=True), "candidates")

    def bodies(nodes: DataFrame) -> DataFrame:
        nodes = nodes.hint("shuffle_hash")
        wanted = lines.select("node", "body").join(nodes, "node", "left_semi")
        return wanted.dropDuplicates(["node"])

    return places, closed_components(found, lines.drop("body"), bodies, similar_lines)


def removals(docs: DataFrame) -> DataFrame:
    """(doc_id, body, gone): the numbers of the lines that go, for documents losing any."""
    places, parts = line_components(docs)
    placed = places.join(parts.hint("shuffle_hash"), "node", "left").select(
        "doc_id", "body", "line", F.coalesce("component", "node").alias("component")
    )
    first = placed.groupBy("component").agg(
        F.min(F.struct("doc_id", "line", "body")).alias("stays"), F.count("*").alias("n")
    ).where("n > 1")
    gone = placed.join(first.hint("shuffle_hash"), "component").where(
        ~(F.col("doc_id").eqNullSafe(F.col("stays.doc_id"))
          & (F.col("line") == F.col("stays.line")) & (F.col("body") == F.col("stays.body")))
    )
    return gone.groupBy("doc_id", "body").agg(F.collect_set("line").alias("gone"))


def _without(text: str, gone: set[int]) -> str:
    return "\n".join(line for n, line in enumerate(text.split("\n")) if n not in gone)


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and two more columns: the lines of
    the input and those taken out.  They are ``_lines`` and ``_gone``, with more underscores in
    front where ``docs`` has such columns."""
    names = docs.columns
    lines, gone = unused(names, "_lines", "_gone")
    d, b, other_d, other_b, numbers = unused([*names, lines, gone], "d", "b", "e", "c", "n")
    keyed = docs.withColumn(d, F.col(doc_id).cast("long")).withColumn(b, F.xxhash64(F.col(text)))
    rows = keyed.select(
        F.col(d).alias("doc_id"), F.col(b).alias("body"), F.col(text).alias("text")
    )
    found = stage(removals(rows), "gone").select(
        F.col("doc_id").alias(other_d), F.col("body").alias(other_b), F.col("gone").alias(numbers)
    )
    # only the smaller side is held; texts are not sorted
    joined = keyed.join(
        found.hint("shuffle_hash"), F.col(d).eqNullSafe(F.col(other_d)) & (F.col(b) == F.col(other_b)), "left"
    )
    parts = F.split(F.col(text), "\n")
    kept = F.filter(
        F.transform(parts, lambda x, n: F.struct(x.alias("x"), n.cast("long").alias("n"))),
        lambda s: ~F.array_contains(F.col(numbers), s["n"]),
    )
    shorter = F.array_join(F.transform(kept, lambda s: s["x"]), "\n")
    lean = F.when(F.col(numbers).isNull(), F.col(text)).otherwise(shorter).alias(text)
    return joined.select(
        *(lean if c == text else F.col(f"`{c}`") for c in names),
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias(lines),
        F.coalesce(F.size(numbers), F.lit(0)).cast("long").alias(gone),
    )

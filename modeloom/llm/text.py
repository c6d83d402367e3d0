"""Words, hashes and ragged arrays of whole texts, vectorised per Arrow batch.

A word is a run of characters other than space and the controls 9 to 13.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Text handled at once inside a task; longer texts are still taken whole.
SLICE_BYTES = 8 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
# Bytes whose words are hashed at once: their sums stay in a processor's cache.
ROLLED_BYTES = 1 << 16
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
SCRAMBLED = np.random.default_rng(2654).integers(0, 1 << 64, 256, np.uint64, endpoint=False)


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one large-string array of its own offsets; NULL becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = (
                column.chunk(0) if column.num_chunks else pa.array([], type=pa.large_string())
            )
    column = pc.fill_null(column.cast(pa.large_string()), "")
    raw, offsets = bytes_of(column)
    return _texts(raw[offsets[0] : offsets[-1]], offsets - offsets[0])


def _texts(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1,
        pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
        pa.py_buffer(np.ascontiguousarray(raw)),
    )


def lower(texts: pa.Array, table: np.ndarray = LOWER) -> pa.Array:
    """Texts with A-Z in lower case and all other characters as they are, or as ``table``, which
    takes ASCII to ASCII, says."""
    raw, offsets = bytes_of(texts)
    return _texts(table[raw[offsets[0] : offsets[-1]]], offsets - offsets[0])


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large-string array, and the offsets of each text in them."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data or b"", np.uint8), offsets


def slices(
    batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Parts of a batch holding about ``size`` bytes of text each, at least one row."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - sizes) // size
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for start, end in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
        yield batch.slice(start, end - start)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words in order, and offsets of each text's words (one more than texts)."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.values
    offsets = lists.offsets.to_numpy().astype(np.int64)
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))]
    return flat.filter(real), before[offsets]


def coded_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the index of each word in order, and each text's offsets."""
    flat, offsets = words_of(texts)
    coded = flat.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), offsets


def hash_words(words: list[str]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word in order, and each text's offsets."""
    words, codes, offsets = coded_words(texts)
    return hash_words(words)[codes], offsets


def rolled_words(texts: pa.Array, size: int = ROLLED_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`hashed_words`, by polynomial hashes of the bytes, ``size`` bytes at a time.

    Sums of scrambled bytes times powers of an odd number run over all bytes; a word's hash is
    the difference of two sums, divided by the power at its start.  Much faster than coding the
    words where most are rare, but these are other hashes.
    """
    raw, offsets = bytes_of(texts)
    raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
    inside = ~SPACE[raw]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    # words end with their text
    cuts = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(raw))]
    begins[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    out = np.zeros(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + size, side="right")))
        first, last = int(starts[low]), int(ends[high - 1])
        length = last - first
        powers, inverse = _powers(max(length, size))
        sums = np.zeros(length + 1, np.uint64)
        np.cumsum(SCRAMBLED[raw[first:last]] * powers[:length], out=sums[1:])
        s, e = starts[low:high] - first, ends[low:high] - first
        out[low:high] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64), 13)
        low = high
    return out, np.searchsorted(starts, offsets)


@functools.lru_cache(maxsize=1)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``MULTIPLIER`` and of its inverse."""
    inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
    out = []
    for base in (MULTIPLIER, inverse):
        factors = np.full(count, base, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    offset = np.uint64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = values + offset
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words inside one text, and offsets per text."""
    counts = np.maximum(np.diff(offsets) - (width - 1), 0)
    ends = np.r_[0, np.cumsum(counts)]
    if ends[-1] == 0:
        return np.zeros(0, np.uint64), ends
    rolled = np.zeros(len(hashes) - width + 1, np.uint64)
    for step in range(width):
        rolled = rolled * MULTIPLIER + hashes[step : step + len(rolled)]
    return mix(rolled[ragged(offsets[:-1], counts)]), ends


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``range(start, start + count)`` over all pairs."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def owners(offsets: np.ndarray) -> np.ndarray:
    """Index of the owning text for every element of a ragged array."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def distinct_per_owner(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, value) pairs, ordered by owner and then value.

    Each owner's values are sorted on their own, several times faster than by two keys.
    """
    if len(owner) == 0:
        return owner, values
    if (owner[1:] < owner[:-1]).any():
        order = np.argsort(owner, kind="stable")
        owner, values = owner[order], values[order]
    else:
        values = values.copy()
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    for start, end in zip(starts, np.r_[starts[1:], len(owner)], strict=True):
        values[start:end].sort()
    first = np.ones(len(values), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    return owner[first], values[first]


def sums_per_owner(offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of each text's values."""
    running = np.r_[np.zeros(1, values.dtype), np.cumsum(values)]
    return running[offsets[1:]] - running[offsets[:-1]]

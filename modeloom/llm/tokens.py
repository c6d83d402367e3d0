"""Token ids of whole texts by a public tokenizer, each distinct word tokenised once.

The tokenizer never joins characters across white space, so a text's ids are those of its
words.  Words of common letters, digits and signs are split the way the tokenizer's own
pattern splits them, and only distinct letter runs reach its model; every other word is
given to the whole tokenizer.  Words seen by a task are remembered up to a bound.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from modeloom.llm.flow import lean
from modeloom.llm.text import coded_words, ragged, slices, texts_of

TOKENIZER = "word_bpe_49k.json"
# Letter runs remembered by one task before it starts anew.
REMEMBERED = 1_000_000
# Printable ASCII without ' and <, and composed Latin letters: for these, lower case and
# normal form act letter by letter.
PLAIN = re.compile("[!-&(-;=-~À-ÖØ-öø-ÿ]+")
PIECES = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n]+|\n")


class WordTokens:
    """Ids of words; results of letter runs are kept between calls."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        self.runs = Tokenizer(self.whole.model)
        self.runs.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.ending = np.zeros(self.size, bool)
        for token, number in vocabulary.items():
            self.ending[number] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    def learn(self, runs: list[str]) -> None:
        """Tokenise runs that are new, many in one call."""
        fresh = [r for r in dict.fromkeys(runs) if r not in self.known]
        for low in range(0, len(fresh), 50_000):
            group = fresh[low : low + 50_000]
            joined = [" ".join(group[i : i + 100]) for i in range(0, len(group), 100)]
            found = self.runs.encode_batch_fast(joined, add_special_tokens=False)
            ids = np.fromiter((t for e in found for t in e.ids), np.int32)
            ends = np.flatnonzero(self.ending[ids]) + 1
            if len(ends) != len(group):
                raise ValueError("a run of characters has not exactly one closing token")
            for at, run in enumerate(group, len(self.starts) - 1):
                self.known[run] = at
            self.starts = np.r_[self.starts, ends + len(self.ids)]
            self.ids = np.r_[self.ids, ids]

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in order, and each word's offsets."""
        if len(self.known) > REMEMBERED:
            self.clear()
        plain = [w if PLAIN.fullmatch(w) else "" for w in words]
        pieces = PIECES.findall("\n".join(plain).lower() + "\n") if words else []
        self.learn([p for p in pieces if p != "\n"])
        known = self.known
        codes = np.fromiter((-1 if p == "\n" else known[p] for p in pieces), np.int64, len(pieces))
        breaks = np.flatnonzero(codes < 0)
        real = codes >= 0
        counts = np.zeros(len(codes), np.int64)
        counts[real] = np.diff(self.starts)[codes[real]]
        running = np.r_[0, np.cumsum(counts)]
        offsets = np.r_[0, running[breaks]] if len(breaks) else np.zeros(1, np.int64)
        ids = self.ids[ragged(self.starts[codes[real]], counts[real])]
        odd = [at for at, (w, p) in enumerate(zip(words, plain, strict=True)) if w and not p]
        if not odd:
            return ids, offsets
        found = self.whole.encode_batch_fast([words[at] for at in odd], add_special_tokens=False)
        extra = [np.array(e.ids, np.int32) for e in found]
        sizes = np.diff(offsets)
        sizes[odd] = [len(e) for e in extra]
        new = np.r_[0, np.cumsum(sizes)]
        out = np.empty(new[-1], np.int32)
        filled = np.ones(len(words), bool)
        filled[odd] = False
        out[ragged(new[:-1][filled], sizes[filled])] = ids
        if extra:
            out[ragged(new[:-1][odd], sizes[odd])] = np.concatenate(extra)
        return out, new


_held: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The worker's tokenizer, made once per process."""
    if path not in _held:
        _held[path] = WordTokens(path)
    return _held[path]


def token_arrays(texts: pa.Array, tokens: WordTokens) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in order, and each text's offsets."""
    words, codes, offsets = coded_words(texts)
    ids, starts = tokens.of(words)
    counts = np.diff(starts)[codes]
    running = np.r_[0, np.cumsum(counts)]
    return ids[ragged(starts[:-1][codes], counts)], running[offsets]


def tokenised(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    end: int = 2,
    tokenizer: str = TOKENIZER,
    extra: tuple[list[str], object] | None = None,
) -> DataFrame:
    """doc_id, n_tokens and ids (unsigned, little-endian; two bytes each where they fit).

    Every text is closed by the id ``end``; NULL counts as empty.  ``extra`` adds columns:
    their declarations, and a function (ids, offsets) -> arrays.
    """
    path = public_tokenizers.path(tokenizer)
    names = extra[0] if extra else []

    def of_batches(
        batches: Iterator[pa.RecordBatch], tokens: WordTokens
    ) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = token_arrays(texts_of(part.column("text")), tokens)
                closed = offsets + np.arange(len(offsets))
                out = np.full(closed[-1], end, id_type(tokens.size))
                keep = np.ones(len(out), bool)
                keep[closed[1:] - 1] = False
                out[keep] = ids
                more = extra[1](out, closed) if extra else []
                data = [out[s:e].tobytes() for s, e in zip(closed[:-1], closed[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(closed), pa.int64()),
                        *more,
                        pa.array(data, pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", *(n.split()[0] for n in names), "ids"],
                )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        try:
            yield from of_batches(batches, tokens)
        finally:
            # the worker outlives the task, and its words are of no use to other operators
            tokens.clear()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = ", ".join(["doc_id long, n_tokens long", *names, "ids binary"])
    return rows.mapInArrow(lean(work), schema)


def id_type(size: int) -> str:
    """Bytes per stored id: two where the vocabulary fits."""
    return "<u2" if size <= 1 << 16 else "<u4"

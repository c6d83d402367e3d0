"""Small corpora with awkward rows, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, body string"


def lowered(text: str | None) -> str:
    return (text or "").translate(LOWER)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def corpus(seed: int = 0, n: int = 60) -> list[tuple]:
    """Rows with NULLs, empty and long texts, ties, copies, near copies and odd characters.

    The columns ``node`` and ``body`` clash with names used inside the operators.
    """
    rng = random.Random(seed)
    vocabulary = [
        "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 8))) for _ in range(400)
    ]
    texts: list[str | None] = []
    for _ in range(n):
        body = rng.choices(vocabulary, k=rng.randint(1, 120))
        texts.append(" ".join(w + rng.choice(["", "", ",", ".\n"]) for w in body))
    passage = " ".join(rng.choices(vocabulary, k=60))
    for i in range(6):
        texts.append(" ".join(rng.choices(vocabulary, k=30)) + "\n" + passage + "\n" + vocabulary[i])
    long = rng.choices(vocabulary, k=20_000)
    texts.append(" ".join(long))
    for i in range(8):
        copy = texts[2 * i].split(" ")
        if len(copy) > 20:
            copy[rng.randrange(len(copy))] = "edited"
        texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper(), texts[1], None, "", "  \t\n ", "one", "One two\x0bthree\x0cfour"]
    texts += ["the " * 300, "the " * 301, "É é x y \U0001f600 ß don't <|endoftext|>", None, ""]
    rows = []
    for i, text in enumerate(texts):
        source = None if i % 11 == 0 else f"src{i % 3}"
        rows.append((3 * i, text, None if i % 7 else "en", source, len(text or ""), 1, "x"))
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(corpus() if rows is None else rows, SCHEMA)

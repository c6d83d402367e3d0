"""Ranked lexical search and exact top-k search against brute force."""

import math
import random
import re

import numpy as np
import pytest

from modeloom.llm import lexical, queries, topk_search
from tests.conftest import SF_DIR
from tests.llm.small import frame, lowered

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def last(value):
    """NULL after every number."""
    return (value is None, value or 0)


def brute_ranking(docs, items, top=10):
    held = [(i, TERM.findall(lowered(t))) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(TERM.findall(lowered(text)))
    counts = [{} for _ in held]
    df = {}
    for (_, w), found in zip(held, counts, strict=True):
        for x in w:
            found[x] = found.get(x, 0) + 1
        for x in found:
            df[x] = df.get(x, 0) + 1
    out = []
    for item, terms in asked.items():
        scored = []
        for (doc, w), found in zip(held, counts, strict=True):
            m = 25 + (75 * len(w) * n_docs) // n_terms
            score = 0
            for x in terms:
                if x in found:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    score += weight * (1_000_000_000 * found[x] // (1000 * found[x] + 8 * m))
            if score > 0:
                scored.append((doc, score))
        scored.sort(key=lambda r: (-r[1], last(r[0])))
        out += [(item, k + 1, d, s) for k, (d, s) in enumerate(scored[:top])]
    return sorted(out, key=lambda r: (last(r[0]), r[1]))


def ranking(df):
    rows = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()]
    return sorted(rows, key=lambda r: (last(r[0]), r[1]))


def corpus():
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta", "x1", "the", "THE", "été"]
    words += [f"w{i}" for i in range(60)]
    rows = [
        (i, " ".join(rng.choices(words, k=rng.randint(0, 40))).replace(" w1", " -w1"))
        for i in range(120)
    ]
    rows += [(7, rows[3][1]), (None, rows[3][1]), (None, "alpha"), (900, None), (901, "")]
    rows += [(902, "!?. \x7f"), (903, "the " * 5000), (904, " ".join(words * 200))]
    # one text a third of all rows
    return rows + [(2000 - i, "alpha beta common text") for i in range(60)]


def items():
    rng = random.Random(6)
    words = ["alpha", "beta", "gamma", "delta", "the", "w1", "w2", "nothing", "été", "x1"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(12)]
    rows += [(3, "w5 w6"), (None, "alpha zeta"), (None, "beta"), (50, None), (51, ""), (52, "-- ")]
    # more terms than one mask word holds
    return rows + [(53, " ".join(f"w{i}" for i in range(60)) + " alpha beta delta gamma the x1 zeta")]


def item_frame(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "item_id long, text string, place int, terms string"
    )


def doc_frame(spark, rows):
    return frame(spark, [(i, t, "en", "s", 0, 1, "x") for i, t in rows])


@pytest.mark.parametrize("docs_per_block", [7, 8192])
def test_ranking_equals_brute_force(spark, monkeypatch, docs_per_block):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", docs_per_block)
    docs, asked = corpus(), items()
    got = lexical.ranked_documents(doc_frame(spark, docs), item_frame(spark, asked))
    assert ranking(got) == brute_ranking(docs, asked)


def test_items_visit_the_index_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK_TERMS", 15)
    docs, asked = corpus()[:60], items()
    got = lexical.ranked_documents(doc_frame(spark, docs).repartition(3), item_frame(spark, asked))
    assert ranking(got) == brute_ranking(docs, asked)


def test_no_documents_or_no_items(spark):
    docs, asked = doc_frame(spark, corpus()[:5]), item_frame(spark, items())
    for found in (
        lexical.ranked_documents(docs.limit(0), asked),
        lexical.ranked_documents(docs, asked.limit(0)),
        lexical.ranked_documents(doc_frame(spark, [(1, None)]), asked),
    ):
        assert found.collect() == []
        assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_ranked_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    asked = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
    got = queries.op12_ranked_search(spark, SF_DIR)
    assert ranking(got) == brute_ranking([tuple(r) for r in docs], [tuple(r) for r in asked])


def test_a_limit_is_never_below_a_score():
    rng = np.random.default_rng(2)
    for _ in range(50):
        out = lexical.BlockWriter()
        n, words = int(rng.integers(1, 40)), [f"t{i}" for i in range(70)]
        held = rng.random((n, 70)) < 0.2
        text, term = np.nonzero(held)
        times = rng.integers(1, 9, len(text))
        sizes = np.bincount(text, times, n).astype(np.int64)
        out.add(np.arange(n), np.zeros(n, bool), sizes, words, text, term, times)
        block = lexical.Block(out.block().to_pylist()[0], 50, 1000)
        terms = list(range(len(block.place)))
        if not terms:
            continue
        weights = rng.integers(1, 3000, len(terms))
        whole, score = lexical.best_of_block(block, terms, weights, 10**9, 1)
        docs, top = lexical.best_of_block(block, terms, weights, 3, 1)
        assert sorted(score)[::-1][:3] == sorted(top)[::-1][:3]
        assert set(docs) <= set(whole) and len(whole) == held.any(axis=1).sum()


def brute_products(rows, each=20, top=20):
    sound = []
    for i, (vec, v) in enumerate(rows):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(64 * x) for x in v]
        if max(map(abs, w), default=0) ** 2 * len(w) < 2**62:
            sound.append((i, vec, w))
    out = []
    for i, query, q in sound:
        if query is None or query % each:
            continue
        scored = [
            (vec, sum(a * b for a, b in zip(q, w, strict=False)))
            for j, vec, w in sound if j != i
        ]
        scored.sort(key=lambda r: (-r[1], last(r[0])))
        out += [(query, k + 1, vec, s) for k, (vec, s) in enumerate(scored[:top])]
    return sorted(out, key=lambda r: (r[0], r[1], -r[3], last(r[2])))


def products(df):
    rows = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0], r[1], -r[3], last(r[2])))


def vectors():
    rng = np.random.default_rng(4)
    rows = [(int(i), rng.normal(0, 0.3, 16).tolist()) for i in range(200)]
    # hot copies, sparse vectors, repeated ids, none, odd values and lengths
    rows += [(1000 + i, rows[0][1]) for i in range(120)]
    rows += [(300 + i, [0.0] * 14 + [1.5, float(i % 3)]) for i in range(30)]
    rows += [(40, rows[40][1]), (40, rows[7][1]), (None, rows[0][1]), (None, rows[20][1])]
    rows += [(2000, None), (2020, []), (2040, [1.0, None]), (2060, [math.nan, 1.0])]
    rows += [(2080, [math.inf]), (2100, [0.0] * 16), (2120, [2.0] * 5), (2140, [1e30] * 16)]
    return rows + [(-20, [-0.01] * 16), (2160, [3e7] * 16)]


def vector_frame(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, 2) for r in rows],
        "vec_id long, embedding array<double>, row int, weights int",
    ).repartition(4)


@pytest.mark.parametrize("chunk", [3, 16384])
def test_products_equal_brute_force(spark, chunk):
    rows = vectors()
    got = topk_search.top_products(vector_frame(spark, rows), chunk=chunk)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert products(got) == brute_products(rows)


def test_blocks_of_a_few_vectors(spark):
    rows = vectors()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        got = products(topk_search.top_products(vector_frame(spark, rows), top=5))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_products(rows, top=5)


def test_no_vectors_no_products(spark):
    df = vector_frame(spark, vectors())
    assert topk_search.top_products(df.limit(0)).collect() == []
    assert topk_search.top_products(df.where("vec_id = 20")).collect() == []
    assert topk_search.top_products(df.where("vec_id = 21")).collect() == []


def test_product_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r[0], r[1]) for r in rows.collect()]
    assert products(queries.op13_topk_search(spark, SF_DIR)) == brute_products(rows)

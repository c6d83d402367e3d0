"""Quality scores, Katz scores, phrase dedup and the pipeline."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from modeloom.llm import flow, katz, phrases, quality, queries
from tests.conftest import SF_DIR
from tests.llm.small import corpus, frame, lowered, words


def held(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n == 0


def test_quality_separates_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.1')}/labels.parquet")
    scored = queries.op7_compression_quality(spark, SF_DIR.replace("0.001", "0.1"))
    rows = scored.join(labels.select("doc_id", "quality"), "doc_id").where("held_out").collect()
    score = np.array([r["score"] for r in rows])
    good = np.array([r["quality"] == 1 for r in rows])
    above = (score[good][:, None] > score[~good][None]).mean()
    assert above > 0.98 and ((score >= 0) & (score <= 1)).all()
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert np.mean([r["predicted"] for r in rows if r["quality"] == 1]) > 0.97


def test_quality_of_odd_rows_and_labels(spark):
    df = frame(spark)
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(df, none)
    assert {r["score"] for r in quality.score(df, model).collect()} == {0.5}
    one = spark.createDataFrame([(0, 1), (3, 1), (None, 0), (6, None)], "doc_id long, quality int")
    assert min(r["score"] for r in quality.score(df, quality.fit(df, one)).collect()) == 1.0
    both = spark.createDataFrame([(3 * i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality.fit(df, both)
    scored = quality.score(df, model).collect()
    assert len(scored) == len(corpus()) and all(0 <= r["score"] <= 1 for r in scored)
    empty = {r["score"] for r in scored if not corpus()[r["doc_id"] // 3][1]}
    assert len(empty) == 1
    kept = quality.keep_good(df, model)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored if r["predicted"]}
    assert quality.score(df.limit(0), model).count() == 0


def brute_katz(rows, n):
    texts = {r[0]: [*words(lowered(r[1])), None] for r in rows}
    train = [d for d in texts if not held(d, n)]
    count = Counter(w for d in train for w in texts[d])
    pairs = Counter((h, w) for d in train for h, w in zip(["<start>", *texts[d]], texts[d]))
    total, distinct = sum(count.values()), len(count)
    d1 = katz.discounts(Counter(min(c, 7) for c in count.values()))
    d2 = katz.discounts(Counter(min(c, 7) for c in pairs.values()))
    seen = sum(d1[min(c, 6) - 1] * c for c in count.values())
    left = max(1 - seen / total, 1 / (total + 1))
    history, kept, mass = Counter(), Counter(), Counter()

    def p1(w):
        c = count[w]
        return (1 - left) * total / seen * d1[min(c, 6) - 1] * c / total if c else left

    for (h, w), c in pairs.items():
        history[h] += c
        kept[h] += d2[min(c, 6) - 1] * c
        mass[h] += p1(w)

    def p(h, w):
        c = pairs.get((h, w), 0)
        if c:
            return d2[min(c, 6) - 1] * c / history[h]
        return p1(w) * (1 - kept[h] / history[h]) / (1 - mass[h]) if h in history else p1(w)

    out = {}
    for d, tokens in texts.items():
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        score = sum(math.log10(p(h, w)) for h, w in zip(["<start>", *tokens], tokens))
        known = sum(count[w] > 0 for w in tokens)
        out[d] = (held(d, n), len(tokens), known, total, base, score)
    everything = [*count, "never seen"]
    return out, [sum(p(h, w) for w in everything) for h in list(history)[:40]]


def test_katz_equals_brute_force_and_sums_to_one(spark):
    want, sums = brute_katz(corpus(), 3)
    assert sums == pytest.approx([1.0] * len(sums))
    got = katz.katz_scores(frame(spark), held_out=3).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:5] == want[r["doc_id"]][:4]
        assert tuple(r)[5:] == pytest.approx(want[r["doc_id"]][4:], rel=1e-9)


def test_katz_query_and_edges(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want, _ = brute_katz(docs, 10)
    for r in queries.op8_katz_backoff(spark, SF_DIR).collect():
        assert tuple(r)[1:5] == want[r["doc_id"]][:4]
        assert tuple(r)[5:] == pytest.approx(want[r["doc_id"]][4:], rel=1e-9)
    assert katz.katz_scores(frame(spark).limit(0)).count() == 0
    untaught = katz.katz_scores(frame(spark), held_out=1).collect()
    assert {(r["train_tokens"], r["n_known"], r["score"]) for r in untaught} == {(0, 0, 0.0)}
    twice = katz.katz_scores(frame(spark, corpus()[:5] + corpus()[:1])).collect()
    assert len(twice) == 6 and len({r["score"] for r in twice if r["doc_id"] == 0}) == 1


def test_katz_with_many_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(flow, "BUCKET_TEXT", 1 << 12)
    monkeypatch.setattr(katz, "MOST_SUMS", 50)
    want, _ = brute_katz(corpus(), 3)
    got = katz.katz_scores(frame(spark), held_out=3).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:5] == want[r["doc_id"]][:4]
        assert tuple(r)[5:] == pytest.approx(want[r["doc_id"]][4:], rel=1e-9)


def test_katz_tells_rows_of_one_id_apart(spark):
    # all rows are training rows, so the brute force may know them by other ids
    texts = ["a b", "c d e", "c d e", None, "", "a b a b c"]
    ids = [1, 1, 1, 1, None, None]
    rows = [(i, t, None, None, 0, 1, "x") for i, t in zip(ids, texts, strict=True)]
    apart = [(n, t) for n, t in enumerate(texts)]
    never = 1 << 40
    want, _ = brute_katz(apart, never)
    got = katz.katz_scores(frame(spark, rows), held_out=never).collect()
    assert len(got) == len(rows)

    def line(i, values):
        return (str(i), *values[:3], *(round(x, 9) for x in values[3:]))

    assert sorted(line(r["doc_id"], tuple(r)[2:]) for r in got) == sorted(
        line(i, want[n][1:]) for n, i in enumerate(ids)
    )


def test_good_turing_discounts():
    n = {1: 1000, 2: 300, 3: 140, 4: 80, 5: 50, 6: 35}
    d = katz.discounts(n)
    excess = 6 * n[6] / n[1]
    assert d[0] == pytest.approx((2 * n[2] / n[1] - excess) / (1 - excess))
    assert all(0 < x < 1 for x in d)
    assert katz.discounts({})[:2] == [0.5, 0.75]


def brute_phrases(rows):
    first, out = {}, {}
    for r in sorted(rows):
        w = words(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if first.setdefault(tuple(w[i : i + 13]), r[0]) < r[0]:
                gone[i : i + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[r[0]] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_phrases_equal_brute_force(spark):
    results, passages = phrases.repeated_phrases(frame(spark))
    assert {r[0]: tuple(r)[1:] for r in results.collect()} == brute_phrases(corpus())
    text = {r[0]: words(r[1]) for r in corpus()}
    for p in passages.collect():
        w = text[p["doc_id"]][p["start"] : p["start"] + p["n_runs"] + 12]
        assert p["origin"] < p["doc_id"] and " ".join(w) == p["body"]
    assert phrases.repeated_phrases(frame(spark).limit(0))[0].count() == 0
    lone = frame(spark, [(None, corpus()[0][1], None, None, 0, 0, ""), *corpus()[:1]])
    assert {r["n_removed"] for r in phrases.repeated_phrases(lone)[0].collect()} == {0}


def test_runs_that_only_share_a_hash_stay(spark, monkeypatch):
    """With every passage unconfirmed but for its first run, only that run goes."""
    real = phrases._confirm

    def doubtful(width):
        def work(key, passages, stretches):
            import pyarrow as pa

            bodies = passages.column("body").to_pylist()
            sound = [[i == 0 for i in range(len(b.split(" ")) - width + 1)] for b in bodies]
            return pa.table(
                {"origin": passages.column("origin"), "body": passages.column("body"),
                 "sound": pa.array(sound, pa.list_(pa.bool_()))}
            )

        return work

    monkeypatch.setattr(phrases, "_confirm", doubtful)
    base = " ".join(f"w{i}" for i in range(30))
    rows = [(1, base, None, None, 0, 0, ""), (2, "x " + base + " y", None, None, 0, 0, "")]
    got = {r[0]: r["n_removed"] for r in phrases.repeated_phrases(frame(spark, rows))[0].collect()}
    assert got == {1: 0, 2: 13} and real is not None


def test_automaton_finds_passages_at_word_bounds():
    found = phrases.locate(["b c", "c d e", "ab c"], ["a b c d", "ab c d e b", "x"])
    assert found == [{0}, {1, 2}, set()]


def test_pipeline_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "ngrams", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stage(function(spark, docs, SF_DIR), name)
        if name == "packing":
            tokens = docs.agg(F.sum("length"), F.max("sequence_id")).first()
            assert tokens[1] == (tokens[0] - 1) // 4096
            assert docs.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
        else:
            assert docs.columns == before.columns
        if name in ("quality", "ngrams"):
            assert docs.exceptAll(before).count() == 0
        if name == "lines":
            assert docs.count() == before.count()
            assert docs.where("n_chars <> length(text)").count() == 0
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()

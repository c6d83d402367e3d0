"""Rows that share an id or have none, and columns named like internal ones."""

import random

import corpus_pipeline
from modeloom.llm import exact_dedup, line_dedup, mixing, ngram_join
from modeloom.llm.flow import unused
from tests.llm.small import WORD

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS
    ).repartition(3)


def sentence(seed, n=60):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def edited(words, *places):
    return " ".join("other" + w if i in places else w for i, w in enumerate(words))


def test_exact_dedup_keeps_rows_not_ids(spark):
    rows = [(5, "a", "s"), (5, "b", "s"), (9, "B", "s"), (None, "only", "s"), (None, None, "s"), (7, "", "s")]
    left = exact_dedup.dedup(docs(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in left) == [(-1, "only"), (5, "a"), (7, ""), (9, "B")]


def chain():
    """Texts a, b, c with a like b and b like c, but a not like c."""
    words = sentence(1, 200)
    return edited(words, 0, 6), edited(words), edited(words, 190, 197)


def test_a_row_without_id_links_its_neighbours(spark):
    a, b, c = chain()
    near, far = sentence(2), sentence(3)
    rows = [(1, a, "s"), (None, b, "s"), (7, c, "s"), (4, " ".join(near), "s"), (5, " ".join(far), "s")]
    got = ngram_join.ngram_components(docs(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in got) == [
        (-1, 1), (1, 1), (4, 4), (5, 5), (7, 1)
    ]


def test_similar_documents_leave_one_row(spark):
    a, b, c = chain()
    clean, other = " ".join(sentence(5)), " ".join(sentence(6))
    rows = [
        (1, a, "s"), (3, b, "s"), (3, clean, "s"), (2, c, "s"), (8, other, "x"), (8, other, "x"),
        (None, other, "s"), (None, None, "s"), (10, None, "s"), (10, None, "s"), (11, "", "s"),
        (12, " \t", "s"),
    ]
    left = corpus_pipeline.distinct_documents(spark, docs(spark, rows), "")
    assert left.columns == [f.split(" ")[0] for f in DOCS.split(", ")]
    got = sorted((r["doc_id"] or -1, r["text"] or "") for r in left.collect())
    assert got == sorted(
        [(1, a), (3, clean), (8, other), (-1, ""), (10, ""), (10, ""), (11, ""), (12, " \t")]
    )
    nothing = corpus_pipeline.distinct_documents(spark, docs(spark, rows).limit(0), "")
    assert nothing.collect() == []


def test_pipeline_lines_against_plain_rows(spark):
    rows = [(1, "one line here\nand two lines", "s"), (2, "One  line here\nthree", "s"), (3, None, "s")]
    lean = corpus_pipeline.distinct_lines(spark, docs(spark, rows), "").collect()
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in lean) == [
        (1, "one line here\nand two lines", 27), (2, "three", 5), (3, None, 0)
    ]


def test_copies_stay_with_their_source(spark):
    text = " ".join(sentence(9, 40))
    rows = [(1, text, "x"), (1, text, "y"), (1, text, None), (2, " ".join(sentence(10, 500)), "x")]
    rows += [(3, " ".join(sentence(11, 400)), "y"), (4, " ".join(sentence(12, 300)), None)]
    df = docs(spark, rows)
    want = {}
    for r in mixing.mix(df).collect():
        want[r["source"]] = want.get(r["source"], 0) + r["taken"]
    got = {}
    for r in mixing.take_copies(df).collect():
        got[r["source"]] = got.get(r["source"], 0) + len(WORD.findall(r["text"]))
    assert got == {s: n for s, n in want.items() if n}


def test_columns_named_like_internal_ones_pass_through(spark):
    names = [
        "_doc", "_body", "_d", "_b", "_numbers", "_lines", "_gone", "_turn", "_id", "_order", "d",
        "b", "n", "size", "taken", "turn", "number", "digest", "other", "same", "body", "id", "from",
    ]
    rows = [(1, "first line\nsecond line", "x"), (2, "first line\nthird", "y"), (2, "Third", "y")]
    schema = DOCS + "".join(f", `{n}` string" for n in names)
    df = spark.createDataFrame(
        [(i, t, "en", s, 1, *[f"{n}{i}" for n in names]) for i, t, s in rows], schema
    )
    lean = line_dedup.dedup_lines(df)
    assert lean.columns == [*df.columns, "__lines", "__gone"]
    copies, kept = mixing.take_copies(df), exact_dedup.dedup(df)
    distinct = corpus_pipeline.distinct_documents(spark, df, "")
    for found in (lean, copies, kept, distinct):
        assert found.columns[: len(df.columns)] == df.columns
        lines = found.collect()
        assert lines
        for r in lines:
            assert [r[n] for n in names] == [f"{n}{r['doc_id']}" for n in names]
    assert [r["text"] for r in lean.orderBy("doc_id", "text").collect()][0] == "first line\nsecond line"


def test_unused_names():
    assert unused(["A", "_a"], "a", "b", "b") == ["__a", "b", "_b"]

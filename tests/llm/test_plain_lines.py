"""Plain forms of lines, made over whole texts."""

import random

import pyarrow as pa

from modeloom.llm import line_dedup
from modeloom.llm.text import LOWER, texts_of


def test_plain_lines_by_their_bytes():
    texts = pa.array(["  A\t\v b \r\n\n \f\nÀ  É  x", None, "one", "\n"], pa.large_string())
    lines, owner, number = line_dedup.plain_lines(texts_of(texts))
    assert lines == ["a b", "À É  x", "one"]
    assert owner.tolist() == [0, 0, 2] and number.tolist() == [0, 3, 0]
    assert line_dedup.FORM[65] == LOWER[65] and line_dedup.FORM[9] == 32


def test_similar_lines_equal_sets_of_texts():
    """Packed shingles, by numbers of the characters or of a batch's own, or plain texts."""
    rng = random.Random(3)
    many = [chr(0x4E00 + i) for i in range(5000)]
    for letters in ("ab", "abc déб ", "ab漢字\U0001f600", many):
        ones, others = [], []
        for _ in range(150):
            one = [rng.choice(letters) for _ in range(rng.randint(5, 200))]
            other = [rng.choice(letters) if rng.random() < 0.01 else c for c in one]
            ones.append("".join(one))
            others.append("".join(other) + rng.choice(["", "x"]))
        want = [line_dedup._similar_texts(x, y) for x, y in zip(ones, others, strict=True)]
        got = line_dedup.similar_lines(pa.array(ones), pa.array(others))
        assert got == want and True in want and False in want


def test_only_wanted_lines_are_sketched(spark):
    """Known lines are those of a document's own list, in plain form, whatever stands beside them."""
    texts = ["first line here\n  SECOND \t line  here \nabc", "second line here\nthird line here"]
    nodes = line_dedup.line_nodes(["second line here", "third line here"]).view("int64").tolist()
    wanted = [[(nodes[0], 1)], [(nodes[1], 1)]]
    df = spark.createDataFrame(
        list(zip(texts, wanted, strict=True)) * 2,
        "text string, wanted array<struct<node: long, line: long>>",
    )
    got = line_dedup._known(df.coalesce(1)).collect()
    assert sorted((r["body"], r["node"], r["n"], len(r["sketch"])) for r in got) == [
        ("second line here", nodes[0], 12, 32)] * 2 + [("third line here", nodes[1], 11, 32)] * 2


def test_equal_carriers_are_sketched_once(spark):
    """Rows that repeat a carrier document give its lines once."""
    nodes = line_dedup.line_nodes(["first line here", "second line here"]).view("int64").tolist()
    rows = [("first line here\nabc", [(nodes[0], 0)]), ("second line here", [(nodes[1], 0)])]
    df = spark.createDataFrame(rows * 40, "text string, wanted array<struct<node: long, line: long>>")
    got = line_dedup._known(df.coalesce(1), once=True).collect()
    assert sorted((r["body"], r["node"]) for r in got) == [
        ("first line here", nodes[0]), ("second line here", nodes[1])]

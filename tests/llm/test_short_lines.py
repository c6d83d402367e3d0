"""Line dedup of lines of any length, against all pairs."""

from modeloom.llm import line_dedup
from tests.llm.small import corpus, frame
from tests.llm.test_pairs import brute_lines


def test_lines_of_any_length_equal_all_pairs(spark):
    texts = [
        "one\n}\nA short line\n\n  \nabcd\nabcde", "ONE\n\n}\na  short line\nkeep me\nabcd",
        "aaaaa\naaaaaaa\nabc\nabcdef\na\nb", "a\nb\na\nb\nabc\nanother short line!", "é\né \né",
        "the nineteen chars.\nTHE NINETEEN CHARS.", "another short line?",
    ]
    rows = corpus() + [(5000 + i, t, "en", "s", len(t), 1, "x") for i, t in enumerate(texts)]
    want = brute_lines(rows)
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert got == want
    assert want[5001] == "\nkeep me" and got[5005] == "the nineteen chars."

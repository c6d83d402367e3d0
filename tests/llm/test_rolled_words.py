"""Word hashes from running sums of bytes."""

import pyarrow as pa

from modeloom.llm.text import hashed_words, rolled_words, texts_of


def test_rolled_hashes_tell_words_apart():
    texts = ["", " ", None, "a", "a b", "b", "a ", "é x\ty\n\nab ba", "a", "", "x" * 300 + " y " + "x" * 301, "x" * 300, "last"]
    column = texts_of(pa.array(texts))
    (coded, ends), (rolled, offsets) = hashed_words(column), rolled_words(column, size=16)
    assert ends.tolist() == offsets.tolist()
    same = set(zip(coded.tolist(), rolled.tolist(), strict=True))
    assert len(same) == len(set(coded.tolist())) == len(set(rolled.tolist()))

"""What a Python worker still holds when a task is over."""

import pyarrow as pa

from modeloom.llm import flow, tokens


def _held(batches):
    for _ in batches:
        words = sum(len(held.known) for held in tokens._held.values())
        yield pa.RecordBatch.from_arrays([pa.array([words], pa.int64())], names=["words"])


def test_words_are_forgotten_with_their_task(spark):
    rows = [(i, f"word{i} other{i} third") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert tokens.tokenised(docs).count() == 80
    left = spark.range(0, 4, 1, 4).mapInArrow(_held, "words long").collect()
    assert {r["words"] for r in left} == {0}


def test_memory_is_given_back_after_the_last_batch(monkeypatch):
    calls = []
    monkeypatch.setattr(flow, "give_back", lambda: calls.append(len(seen)))
    seen = []
    for value in flow.lean(lambda batches: (2 * b for b in batches))(iter([1, 2, 3])):
        seen.append(value)
        assert not calls
    assert seen == [2, 4, 6] and calls == [3]

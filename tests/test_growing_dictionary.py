"""Dictionaries that grow without moving an index."""

from pyspark.sql import functions as F

from modeloom.operators.dictionary import (
    as_of,
    category_dictionary,
    grown_dictionary,
    index_labels,
    labels_of,
)


def frame(spark, labels):
    return spark.createDataFrame([(x, i % 2) for i, x in enumerate(labels)], "kind string, other int")


def entries(dictionary, column="kind"):
    return {r["label"]: (r["idx"], r["cnt"], r["since"]) for r in dictionary.of(column).collect()}


def test_old_indices_stay_and_new_labels_follow(spark):
    first = category_dictionary(frame(spark, ["b", "b", "a", None]), ["kind", "other"])
    more = frame(spark, ["a", "z", "c", "z", None, "a", "a", ""])
    second = grown_dictionary(first, more)
    assert entries(second) == {
        "b": (0, 2, 1), "a": (1, 4, 1), "z": (2, 2, 2), "": (3, 1, 2), "c": (4, 1, 2)
    }
    assert dict(second.sizes) == {"kind": 5, "other": 2}
    third = grown_dictionary(second, frame(spark, ["q", "b"]))
    assert entries(third)["q"] == (5, 1, 3) and entries(third)["b"] == (0, 3, 1)
    assert dict(as_of(third, 2).sizes)["kind"] == 5 and dict(as_of(third, 1).sizes)["kind"] == 2
    # what version 1 encoded, version 3 decodes
    rows = frame(spark, ["a", "b", "a"])
    coded = index_labels(rows, "kind", first)
    back = labels_of(coded, "idx", third, "kind").where(F.col("label") != F.col("kind"))
    assert coded.count() == 3 and back.count() == 0


def test_nothing_new_and_nothing_old(spark):
    first = category_dictionary(frame(spark, ["b", "a"]), ["kind"])
    same = grown_dictionary(first, frame(spark, ["b"]).limit(0))
    assert entries(same) == {"a": (0, 1, 1), "b": (1, 1, 1)}
    empty = category_dictionary(frame(spark, [None]), ["kind"])
    assert entries(grown_dictionary(empty, frame(spark, ["x"]))) == {"x": (0, 1, 2)}
    assert as_of(first, 1) is first

"""Token ids, curve packing and training order."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from modeloom.llm import order, packing
from modeloom.llm.tokens import TOKENIZER, WordTokens, token_arrays
from tests.llm.small import corpus, frame

WHOLE = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
FAST = WordTokens(public_tokenizers.path(TOKENIZER))


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_ids_equal_the_whole_tokenizer(texts):
    ids, offsets = token_arrays(pa.array(texts, pa.large_string()), FAST)
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == ids_of(text)


def test_hilbert_visits_every_cell_in_steps_of_one():
    axes = [np.arange(8)] * 3
    cells = np.stack(np.meshgrid(*axes), axis=-1).reshape(-1, 3)
    index = packing.hilbert(cells, 3)
    assert sorted(index.tolist()) == list(range(512))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("length", [4096, 100])
def test_pieces_cover_every_document_once(spark, length):
    rows = corpus() + [corpus()[0], (None, "no id", None, None, 0, 0, "")]
    got = packing.pack(frame(spark, rows), length=length).collect()
    want = sorted(
        ((r[0] if r[0] is not None else -1), tuple([*ids_of(r[1]), 2])) for r in rows
    )
    pieces = sorted(got, key=lambda r: (r["sequence_id"], r["offset"]))
    docs, at, open_piece = [], 0, []
    for p in pieces:
        assert p["sequence_id"] * length + p["offset"] == at
        assert p["offset"] + p["length"] <= length
        at += p["length"]
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] and p["start"] == len(open_piece)
        open_piece += ids
        if len(open_piece) == p["doc_tokens"]:
            docs.append((p["doc_id"] if p["doc_id"] is not None else -1, tuple(open_piece)))
            open_piece = []
    assert open_piece == [] and sorted(docs) == want
    assert packing.pack(frame(spark).limit(0)).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 5, 64, 1000, 4097])
def test_slots_are_a_permutation(count):
    one = order.slots(np.arange(count), count, 1)
    assert sorted(one.tolist()) == list(range(count))
    assert (one == np.concatenate([order.slots(np.arange(a, min(a + 7, count)), count, 1)
                                   for a in range(0, count, 7)])).all()
    if count > 60:
        assert (one != order.slots(np.arange(count), count, 2)).any()


def test_shards_read_back(spark, tmp_path):
    rows = corpus() + [corpus()[0], (None, "no id", None, None, 0, 0, "")]
    made = order.sequences(frame(spark, rows), length=64, per_shard=16)
    got = {r["slot"]: r for r in made.collect()}
    assert sorted(got) == list(range(len(got)))
    whole = {}
    for r in got.values():
        assert (r["shard"], r["offset"]) == (r["slot"] // 16, r["slot"] % 16 * 256)
        whole.setdefault(r["doc_id"], {}).setdefault(r["block"], []).append(
            np.frombuffer(r["ids"], "<u4")[: r["n_tokens"]].tolist()
        )
    for row in corpus()[1:]:
        ids = [t for b in sorted(whole[row[0]]) for t in whole[row[0]][b][0]]
        assert ids == [*ids_of(row[1]), 2]
    assert len(whole[0][0]) == 2
    path = str(tmp_path / "shards")
    total = order.write_order(frame(spark, rows), path, length=64, per_shard=16)
    assert total == len(got)
    part = {r["slot"]: r for r in order.read_slots(spark, path, 10, 41, 64, 16).collect()}
    assert part == {s: got[s] for s in range(10, 41)}
    written = spark.read.parquet(path).orderBy("shard").collect()
    assert [r["shard"] for r in written] == list(range(-(-total // 16)))
    assert all(len(r["body"]) == 256 * r["n"] for r in written)
    assert sum(r["n"] for r in written) == total
    empty = str(tmp_path / "empty")
    assert order.write_order(frame(spark).limit(0), empty) == 0
    assert order.read_slots(spark, empty, 0, 5).count() == 0
    assert order.sequences(frame(spark).limit(0)).count() == 0


def test_crc_of_pieces(spark):
    from modeloom.llm import queries
    from tests.conftest import SF_DIR

    docs = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    pieces = {}
    for r in queries.op1_curve_packing(spark, SF_DIR).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    assert set(pieces) == set(docs)
    for doc, found in pieces.items():
        ids = np.array([*ids_of(docs[doc]), 2], "<u4")
        found.sort(key=lambda r: r["start"])
        assert sum(r["length"] for r in found) == len(ids) == found[0]["doc_tokens"]
        for r in found:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]

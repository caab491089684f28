from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from grovelift.llm.cutting_stock import plan
from grovelift.llm.packing import (
    CAPACITY,
    RANKS,
    TOKENIZER,
    pack_documents,
    pack_pieces,
    packed_sequences,
    piece_digests,
)
from grovelift.llm.tokens import ByteBpe

ENCODER = ByteBpe(TOKENIZER, RANKS, public_tokenizers.PATTERN)
WHOLE = Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return [*WHOLE.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_tokenizer(text):
    assert ENCODER.encode(text).tolist() == ids_of(text)[:-1]


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|> b", "  a  b\n\n c ", "é́🎉 日本", "I'll it's 12 3"])
def test_ids_of_odd_texts(text):
    assert ENCODER.encode(text).tolist() == ids_of(text)[:-1]
    assert ByteBpe(TOKENIZER, None, None).encode(text).tolist() == ids_of(text)[:-1]


def checked(rows: list, out: pd.DataFrame) -> None:
    """Every id lies in one piece, and sequences have no gaps and are not too long."""
    texts = dict(rows)
    for doc_id, own in out.groupby("doc_id"):
        ids = ids_of(texts[doc_id])
        own = own.sort_values("start")
        assert own.start.tolist() == np.cumsum([0, *own.length])[:-1].tolist()
        assert own.length.sum() == len(ids) == own.doc_tokens.iloc[0]
        for r in own.itertuples():
            piece = np.array(ids[r.start : r.start + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(piece.tobytes())
    assert set(out.doc_id) == set(texts)
    for _, own in out.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == np.cumsum([0, *own.length])[:-1].tolist()
        assert own.length.sum() <= CAPACITY
    assert sorted(set(out.sequence_id)) == list(range(out.sequence_id.nunique()))


def test_sample_table(table):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    out = pack_documents(table("documents")).toPandas()
    checked(rows, out)
    least = -(-out.length.sum() // CAPACITY)
    assert out.sequence_id.nunique() <= 1.03 * least + 1


def test_odd_documents(documents):
    rows = [(1, None), (2, ""), (3, "word " * 5000), (4, "<|endoftext|>"), (5, "\n")]
    checked(rows, pack_documents(documents(rows)).toPandas())


def test_sequences_hold_the_ids(documents):
    rows = [(1, None), (2, ""), (3, "word " * 5000), (4, "<|endoftext|>"), (5, "some more words")]
    sequences = packed_sequences(documents(rows))
    checked(rows, piece_digests(sequences).toPandas())
    found = {}
    for s in sequences.collect():
        ids = np.frombuffer(s.ids, "<u4")
        assert len(ids) == CAPACITY and not ids[s.n_tokens :].any()
        for p in s.pieces:
            found[p.doc_id, p.start] = ids[p.offset : p.offset + p.length].tolist()
    for doc_id, text in rows:
        own = [ids for (d, _), ids in sorted(found.items()) if d == doc_id]
        assert sum(own, []) == ids_of(text)
    assert packed_sequences(documents([])).collect() == []


def test_repeated_rows_and_missing_ids(documents):
    out = pack_documents(documents([(1, "a"), (1, "a"), (None, "a")])).toPandas()
    assert out.length.tolist() == [2, 2, 2] and out.doc_id.isna().sum() == 1
    assert sorted(out.offset) == [0, 2, 4]


def test_empty(documents):
    assert pack_documents(documents([])).collect() == []


def test_other_columns_stay(spark):
    rows = spark.createDataFrame([(1, 5, "x"), (2, 3, "y")], "doc_id long, length long, n string")
    out = pack_pieces(rows, 8, 1).toPandas().sort_values("doc_id")
    assert out.n.tolist() == ["x", "y"] and out.sequence_id.tolist() == [0, 0]


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(0, 60), max_size=10))
def test_plan_holds_every_piece_once(demand):
    patterns = plan(demand, 24)
    for k, n in demand.items():
        assert sum(times * held.get(k, 0) for times, held in patterns) == n
    assert all(sum(k * a for k, a in held.items()) <= 24 for _, held in patterns)
    pieces = sorted((k for k, n in demand.items() for _ in range(n)), reverse=True)
    used = sum(times for times, _ in patterns)
    assert used >= -(-sum(pieces) // 24)
    assert used <= first_fit(pieces, 24) + 2


def first_fit(pieces, capacity):
    room = []
    for p in pieces:
        i = next((i for i, r in enumerate(room) if r >= p), None)
        if i is None:
            room.append(capacity - p)
        else:
            room[i] -= p
    return len(room)

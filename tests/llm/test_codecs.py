"""The SentencePiece codec and the licence scan."""

from __future__ import annotations

import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from grovelift.llm.licenses import HEADERS, KNOWN, LICENSES, oracle_sql, scan_licenses
from grovelift.llm.sentencepiece_codec import (
    MODEL,
    SPACE,
    PieceCodec,
    decode_texts,
    encode_texts,
    encoded_digests,
)

CODEC = PieceCodec(MODEL)


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """A model of the same pieces that the library itself segments by best score.

    Scores of -1e9 leave single floats no room for the others, so they are raised.
    """
    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40_000.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return PieceCodec(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))


def slow(codec, text):
    """Best segmentation by trying every piece at every place; the longest last piece wins ties."""
    held = {p: i for i, p in enumerate(codec.pieces)}
    marked = SPACE + text.replace(" ", SPACE)
    scores = {p: v[1] for p, v in codec.automaton.items()}
    best, back = [0.0], [None]
    for end in range(1, len(marked) + 1):
        top, how = float("-inf"), None
        for start in range(max(0, end - 16), end):
            piece = marked[start:end]
            score = scores.get(piece)
            if score is None and end - start == 1:
                score = codec.unknown_score
            if score is not None and best[start] + score > top:
                top, how = best[start] + score, start
        best.append(top)
        back.append(how)
    ids, end = [], len(marked)
    while end:
        piece = marked[back[end] : end]
        own = [held[piece]] if piece in scores else [codec.bytes[b] for b in piece.encode()]
        ids[:0] = own
        end = back[end]
    return ids


def test_words_of_the_sample_as_the_library(table, unigram):
    codec, library = unigram
    words = {w for r in table("documents").limit(60).collect() for w in r.text.split()}
    for word in sorted(words):
        assert codec.encode(word).tolist() == library.encode(word), word


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab theing.\n  éß日🎉\t\x00")), max_size=30))
def test_round_trip_and_best_score(text):
    ids = CODEC.encode(text).tolist()
    assert CODEC.decode(ids) == text
    if text:
        assert ids == slow(CODEC, text)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_round_trip_of_any_text(text):
    assert CODEC.decode(CODEC.encode(text).tolist()) == text.replace(SPACE, " ")


def test_decodes_as_the_library(unigram):
    _, library = unigram
    ids = CODEC.encode("The café – 日本 🎉\nline  two").tolist()
    assert CODEC.decode(ids) == library.decode(ids)
    assert CODEC.decode([CODEC.bytes[0xFF]]) == "�"


def test_frames(documents):
    texts = [(1, "hello world"), (2, None), (3, ""), (4, "x" * 100_000), (None, "a  b\n"), (1, "hello world")]
    encoded = encode_texts(documents(texts))
    decoded = decode_texts(encoded.select("doc_id", "ids")).collect()
    assert [r.decoded for r in decoded] == [t or "" for _, t in texts]
    rows = encoded_digests(documents(texts)).collect()
    assert all(r.round_trip for r in rows)
    for row, (_, text) in zip(rows, texts, strict=True):
        ids = CODEC.encode(text or "")
        assert (row.n_ids, row.ids_crc32) == (len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
    assert encoded_digests(documents([])).collect() == []


def test_sample_table_comes_back(table):
    assert encoded_digests(table("documents")).where("NOT round_trip").collect() == []


def scan(documents, texts):
    rows = scan_licenses(documents(list(enumerate(texts)))).collect()
    return [tuple(r)[1:] for r in sorted(rows)]


def test_known_texts_in_other_forms(documents):
    mit = dict(KNOWN)["MIT"]
    changed = "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace("LICENSE", "LICENCE").replace("\n", "\n\n")
    assert scan(documents, [mit, changed, mit + " more", "\tlicensed under the APACHE licence -- version 2.0"]) == [
        ("MIT", "", 0),
        ("MIT", "", 0),
        (None, "", 0),
        ("Apache-2.0", "Apache-2.0", 1),
    ]


def test_every_known_text_is_found(documents):
    found = scan(documents, [text for _, text in KNOWN])
    assert [f[0] for f in found] == [name for name, _ in KNOWN]


def test_lines_and_odd_texts(documents):
    gpl, cc = KNOWN[3][1], KNOWN[5][1]
    texts = [f"words\n{cc}\n{gpl}\n{cc}", None, "", "\n\n", "© 2019 Someone", "words " * 20_000, gpl]
    assert scan(documents, texts) == [
        (None, "CC-BY-NC-4.0,GPL-3.0", 3),
        *[(None, "", 0)] * 5,
        ("GPL-3.0", "GPL-3.0", 1),
    ]


def test_repeated_rows_and_missing_ids(documents):
    gpl = KNOWN[3][1]
    rows = scan_licenses(documents([(1, gpl), (1, gpl), (None, gpl), (1, "other")])).collect()
    assert sorted(map(str, map(tuple, rows))) == [
        "(1, 'GPL-3.0', 'GPL-3.0', 1)",
        "(1, 'GPL-3.0', 'GPL-3.0', 1)",
        "(1, None, '', 0)",
        "(None, 'GPL-3.0', 'GPL-3.0', 1)",
    ]
    assert scan_licenses(documents([])).collect() == []


def test_licenses_inside_documents(documents):
    """A whole licence between other paragraphs, a notice over two lines, a holder without a year."""
    mit, bsd = dict(LICENSES)["MIT"], dict(HEADERS)["BSD-3-Clause"]
    apache = dict(HEADERS)["Apache-2.0"]
    assert scan(
        documents,
        [
            f"Some program\n\n{mit}\n\nMore text.",
            "Copyright Jane Doe\n\n" + mit,
            "Some words.\n\nThis work is licensed under the GNU General\nPublic License, version 3.\n\nMore.",
            f"Copyright 2001 A. Body\nAll rights reserved.\n\n{bsd}",
            f"Title\n\n{apache}\n\n\n{mit.split(chr(10), 2)[2]}\n\nEnd",
            mit.replace("MIT License\n\n", "Program\nby somebody\n\n"),
            "copyright notice and this permission\n\nwords",
        ],
    ) == [
        (None, "MIT", 1),
        ("MIT", "", 0),
        (None, "GPL-3.0", 1),
        ("BSD-3-Clause", "", 0),
        (None, "Apache-2.0,MIT", 2),
        (None, "MIT", 1),
        (None, "", 0),
    ]


LICENSE_FILES = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "BSD": "BSD-3-Clause",
    "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0",
    "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1",
    "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}


def test_long_licenses_as_whole_documents(spark, documents):
    """As published, and wrapped and cased in another way; one word more is no licence.

    The scan is held against its SQL, too.
    """
    folder = Path("/usr/share/common-licenses")
    if not all((folder / name).exists() for name in LICENSE_FILES):
        pytest.skip("the texts are not here")
    texts = {name: (folder / name).read_text() for name in LICENSE_FILES}
    whole = []
    for name, text in texts.items():
        paragraphs = [" ".join(p.split("\n")).upper() for p in text.split("\n\n")]
        # a copyright line stays a line of its own
        loose = "\n\n".join(paragraphs) if "opyright" not in text else text.upper()
        whole += [text, loose, text + "\nword"]
    rows = documents(list(enumerate(whole)))
    found = {r["doc_id"]: r["license"] for r in scan_licenses(rows).collect()}
    for i, license_ in enumerate(LICENSE_FILES.values()):
        assert [found[3 * i + k] for k in range(3)] == [license_, license_, None]
    db = duckdb.connect()
    db.register("documents", rows.toPandas())
    expected = {r[0]: r[1:] for r in db.execute(oracle_sql()).fetchall()}
    assert {r["doc_id"]: tuple(r)[1:] for r in scan_licenses(rows).collect()} == expected

"""Encoding and decoding by the pieces of a SentencePiece model.

The pieces are the words of an Aho-Corasick automaton. One pass over a text
gives, at each position, all pieces that end there, as the output links of the
automaton name them, longest first. Each relaxes the best score of a prefix of
the text (Viterbi), so the pass ends with the segmentation of highest total
score. Characters that no piece holds become byte pieces.

No piece crosses the start of a word or a line break, so these parts are
encoded on their own and parts that come again are looked up.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
_CACHED_PARTS = 150_000


class PieceCodec:
    """Encodes to and decodes from piece ids, by the highest sum of piece scores.

    Text is taken as it is but for spaces, which become U+2581, and one such
    mark in front. Of segmentations with equal scores the one with the longest
    last piece is taken, then likewise before it.
    """

    def __init__(self, model: str):
        held = sentencepiece.SentencePieceProcessor(model_file=model)
        n = held.get_piece_size()
        self.pieces = [held.id_to_piece(i) for i in range(n)]
        self.unknown = held.unk_id()
        self.bytes = {}
        self.automaton = ahocorasick.Automaton()
        lowest, self.single, crossing = 0.0, set(), False
        for i, piece in enumerate(self.pieces):
            if held.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (held.is_control(i) or held.is_unknown(i) or held.is_unused(i)):
                score = held.get_score(i)
                self.automaton.add_word(piece, (len(piece), score, i))
                lowest = min(lowest, score)
                if len(piece) == 1:
                    self.single.add(piece)
                crossing |= "\n" in piece or re.search(f"[^{SPACE}]{SPACE}", piece) is not None
        self.automaton.make_automaton()
        self.unknown_score = lowest - UNKNOWN_PENALTY
        # Parts that no piece can cross; a run of marks stays with its word.
        self.parts = re.compile(r"(?s).+" if crossing else f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        self.fast = not crossing
        self.byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        self.inner: dict[str, bytes] = {}
        self.other: dict[str, bytes] = {}

    def _fallback(self, char: str) -> list[int]:
        raw = char.encode("utf-8", "replace")
        if any(b not in self.bytes for b in raw):
            return [self.unknown]
        return [self.bytes[b] for b in raw]

    def segment(self, part: str) -> list[int]:
        """Piece ids of one part, by a single pass over the automaton's matches."""
        n, low = len(part), float("-inf")
        best, back = [0.0] + [low] * n, [None] * (n + 1)
        strange = [i for i, c in enumerate(part) if c not in self.single]
        at = 0
        for end, (length, score, piece) in self.automaton.iter(part):
            while at < len(strange) and strange[at] < end:
                self._relax_unknown(strange[at], best, back)
                at += 1
            end += 1
            total = best[end - length] + score
            if total > best[end]:
                best[end], back[end] = total, (length, piece)
        for i in strange[at:]:
            self._relax_unknown(i, best, back)
        ids, end = [], n
        while end:
            length, piece = back[end]
            if piece < 0:
                ids += reversed(self._fallback(part[end - 1]))
            else:
                ids.append(piece)
            end -= length
        ids.reverse()
        return ids

    def _relax_unknown(self, i: int, best: list, back: list) -> None:
        total = best[i] + self.unknown_score
        if total > best[i + 1]:
            best[i + 1], back[i + 1] = total, (1, -1)

    def _known(self, part: str, cache: dict[str, bytes], key: str) -> bytes:
        if len(cache) >= _CACHED_PARTS:
            cache.clear()
        found = cache[key] = np.array(self.segment(part), "<u4").tobytes()
        return found

    def _line(self, line: str, first: bool) -> list[bytes]:
        words = line.split(" ")
        if "" in words:  # runs of spaces, or spaces at an end
            marked = (SPACE if first else "") + line.replace(" ", SPACE)
            parts = self.parts.findall(marked)
            return [self.other.get(p) or self._known(p, self.other, p) for p in parts]
        get, out = self.inner.get, []
        if not first:
            head = words.pop(0)
            out.append(self.other.get(head) or self._known(head, self.other, head))
        found = list(map(get, words))
        if None in found:
            for i, known in enumerate(found):
                if known is None:
                    found[i] = get(words[i]) or self._known(SPACE + words[i], self.inner, words[i])
        return out + found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, as little-endian unsigned 32-bit numbers."""
        if not text:
            return np.zeros(0, "<u4")
        if not self.fast or SPACE in text:
            marked = SPACE + text.replace(" ", SPACE)
            ids = [i for p in self.parts.findall(marked) for i in self.segment(p)]
            return np.array(ids, "<u4")
        lines = text.split("\n")
        out = self._line(lines[0], True) if lines[0] else [self._mark()]
        if len(lines) > 1:
            end = self.other.get("\n") or self._known("\n", self.other, "\n")
            for line in lines[1:]:
                out.append(end)
                if line:
                    out += self._line(line, False)
        return np.frombuffer(b"".join(out), "<u4")

    def _mark(self) -> bytes:
        return self.other.get(SPACE) or self._known(SPACE, self.other, SPACE)

    def decode(self, ids) -> str:
        """The text of these ids; bytes that are not UTF-8 become U+FFFD."""
        pieces, byte_of = self.pieces, self.byte_of
        found = [pieces[i] for i in ids]
        if not byte_of.keys().isdisjoint(ids):
            out, run = [], b""
            for i, piece in zip(ids, found, strict=True):
                if i in byte_of:
                    run += byte_of[i]
                    continue
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run = b""
                out.append(piece)
            out.append(run.decode("utf-8", "replace"))
            found = out
        text = "".join(found).replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def _encode_batches(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model)
        for batch in batches:
            ids = [codec.encode(t.as_py() or "") for t in batch.column("text")]
            edges = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            flat = np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int32)
            columns = [batch.column(c) for c in batch.schema.names]
            lists = pa.ListArray.from_arrays(edges, pa.array(flat))
            yield pa.RecordBatch.from_arrays([*columns, lists], [*batch.schema.names, "ids"])

    return run


def _decode_batches(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model)
        for batch in batches:
            texts = [codec.decode(i.as_py() or []) for i in batch.column("ids")]
            columns = [batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
            )

    return run


def encode_texts(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text and ids of every row; a null or empty text has no ids."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_encode_batches(model), "doc_id long, text string, ids array<int>")


def decode_texts(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and the text of the ids of every row; null ids give an empty text."""
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(_decode_batches(model), "doc_id long, ids array<int>, decoded string").drop("ids")


def _round_trip_batches(model: str):
    names = ["doc_id", "n_ids", "n_byte_ids", "ids_crc32", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model)
        byte_ids = np.zeros(len(codec.pieces), bool)
        byte_ids[list(codec.bytes.values())] = True
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = text.as_py() or ""
                ids = codec.encode(text)
                same = codec.decode(ids.tolist()) == text
                rows.append((doc_id.as_py(), len(ids), int(byte_ids[ids].sum()), zlib.crc32(ids.tobytes()), same))
            kinds = [pa.int64()] * 4 + [pa.bool_()]
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return run


def encoded_digests(documents: DataFrame, model: str = MODEL) -> DataFrame:
    """Of every row the number of its ids, how many are bytes, their crc32, and
    whether decoding gives the text back.

    `ids_crc32` is over little-endian unsigned 32-bit ids. A null text counts
    as empty: no ids, crc32 0, and it comes back as empty. Texts that hold
    U+2581 themselves come back with spaces instead. Rows are independent, so
    repeated rows and null ids need no care, and an empty table gives no rows.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, round_trip boolean"
    return rows.mapInArrow(_round_trip_batches(model), schema)

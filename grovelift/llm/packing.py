"""Packing of documents into sequences of one length, as a cutting-stock problem.

1. Texts become ids, cut at multiples of the capacity. What is left of each
   document is shorter than a sequence.
2. A histogram of these lengths, in units of a few tokens, is all the driver
   gets. Column generation over it gives patterns of lengths and how often
   each is used (`cutting_stock`).
3. Documents are ranked within their length. A pattern used so often takes a
   run of ranks of each of its lengths, so where a piece goes follows from
   its length and rank in closed form. Places within a sequence are running
   sums over its few pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grovelift.llm.common import checkpointed
from grovelift.llm.cutting_stock import plan
from grovelift.llm.tokens import ByteBpe

CAPACITY = 1024
UNIT = 8
END_ID = 0
# Rows of 32 bytes, one per partition and length class, that are broadcast.
BROADCAST_RUNS = 500_000
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
_PIECES_PER_BATCH = 50_000
_IDS_PER_BATCH = 1_000_000
_BYTES_PER_ID = 4
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _id_bytes(tokenizer: str) -> int:
    """Bytes that each id takes on its way: 2 if all ids of the vocabulary fit."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else _BYTES_PER_ID


def _piece_batches(capacity: int, tokenizer: str, ranks: str | None, pattern: str | None, width: int):
    schema = pa.schema([(f.split()[0], pa.int64()) for f in _PIECES.split(", ")])
    if width:
        schema = schema.append(pa.field("ids", pa.binary()))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, rows, held = ByteBpe(tokenizer, ranks, pattern), [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                found = np.append(encoder.encode(text.as_py() or ""), np.uint32(END_ID))
                found = found.astype("<u4")
                for start in range(0, len(found), capacity):
                    piece = found[start : start + capacity]
                    crc = zlib.crc32(piece.tobytes())
                    row = (doc_id.as_py(), start, len(piece), crc, len(found))
                    rows.append((*row, piece.astype(f"<u{width}").tobytes()) if width else row)
                    held += len(piece)
                    if len(rows) >= _PIECES_PER_BATCH or width and held >= _IDS_PER_BATCH:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return run


def token_pieces(
    documents: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    ranks: str | None = RANKS,
    pattern: str | None = public_tokenizers.PATTERN,
    id_bytes: int = 0,
) -> DataFrame:
    """The ids of each document and an end id, cut at multiples of `capacity`.

    With `id_bytes` a column `ids` holds them, as little-endian values of so many bytes.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = _PIECES + ", ids binary" if id_bytes else _PIECES
    return rows.mapInArrow(_piece_batches(capacity, tokenizer, ranks, pattern, id_bytes), schema)


def _runs(patterns: list[tuple[int, dict[int, int]]]) -> dict[int, list[tuple[int, int, int]]]:
    """Per length class the runs of ranks: (first rank, pieces a sequence, first sequence)."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for times, held in patterns:
        for k, a in held.items():
            runs.setdefault(k, []).append((taken.get(k, 0), a, sequence))
            taken[k] = taken.get(k, 0) + times * a
        sequence += times
    return runs


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """Adds sequence_id and offset to pieces with a `length` from 1 to `capacity`.

    Sequence ids are gapless from 0. Pieces of one length are interchangeable
    and ranked by where they lie: each partition is sorted by length once, so a
    rank follows from the place in the partition and the counts of the partitions
    before it, and only the way into sequences moves pieces. An empty frame stays
    empty.
    """
    spark, columns = pieces.sparkSession, pieces.columns
    kind, part, rank, row, shift = "__kind", "__part", "__rank", "__row", "__shift"
    kept = checkpointed(
        pieces.withColumn(kind, F.ceil(F.col("length") / unit).cast("int"))
        .sortWithinPartitions(kind)
        .withColumn(row, F.monotonically_increasing_id())
    )
    # The upper bits of these ids number the partitions.
    kept = kept.withColumn(part, F.shiftright(row, 33).cast("int"))
    counts = kept.groupBy(part, kind).agg(F.min(row).alias(shift), F.count(F.lit(1)).alias("n"))
    counts = checkpointed(counts)
    demand = {r[0]: r[1] for r in counts.groupBy(kind).agg(F.sum("n")).collect()}
    runs = _runs(plan(demand, -(-capacity // unit)))
    table = [(k, *map(list, zip(*r, strict=True))) for k, r in runs.items()]
    schema = f"{kind} int, firsts array<long>, shares array<long>, sequences array<long>"
    runs = spark.createDataFrame(table, schema)

    earlier = Window.partitionBy(kind).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    shifts = counts.select(part, kind, (before - F.col(shift)).alias(shift))
    if counts.count() <= BROADCAST_RUNS:
        shifts = F.broadcast(shifts)
    ranked = kept.join(shifts, [part, kind]).withColumn(rank, F.col(row) + F.col(shift))
    # One row per length class, at most capacity / unit of them.
    placed = ranked.join(F.broadcast(runs), kind)
    run = F.size(F.filter("firsts", lambda f: f <= F.col(rank)))
    at = {c: F.element_at(c, run) for c in ("firsts", "shares", "sequences")}
    sequence = at["sequences"] + F.floor((F.col(rank) - at["firsts"]) / at["shares"])
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), row)
    offset = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        placed.withColumn("sequence_id", sequence)
        .withColumn("offset", offset)
        .select(*columns, "sequence_id", "offset")
    )


def pack_documents(documents: DataFrame) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    A null text counts as empty; every document has at least its end id. A row
    without doc_id is packed with a null id, and repeated rows are packed each.
    Very long texts are cut into many pieces. Without documents there are no rows.
    """
    return pack_pieces(token_pieces(documents))


def _filled_up(capacity: int, width: int):
    """Ids of `width` bytes as 32-bit values, with zeros up to `capacity`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            filled = []
            for ids in batch.column(at):
                held = np.frombuffer(ids.as_py(), f"<u{width}").astype("<u4")
                filled.append(np.pad(held, (0, capacity - len(held))).tobytes())
            yield batch.set_column(at, "ids", pa.array(filled, pa.binary()))

    return run


def packed_sequences(documents: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, pieces and ids.

    `ids` are the ids of all pieces, one after another, as little-endian unsigned
    32-bit values, filled up with zeros to `capacity`; `n_tokens` of them are not
    filling. `pieces` tells, in order, what lies where: (offset, doc_id, start,
    length, doc_tokens). Odd rows are treated as in `pack_documents`. On their way
    ids are as short as the vocabulary allows.
    """
    width = _id_bytes(TOKENIZER)
    pieces = token_pieces(documents, capacity, id_bytes=width).drop("ids_crc32")
    placed = pack_pieces(pieces, capacity, unit)
    piece = F.struct("offset", "doc_id", "start", "length", "doc_tokens", "ids")
    # A sequence has at most `capacity` pieces.
    sequences = placed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(piece)).alias("pieces")
    )
    ids = F.aggregate("pieces", F.lit(b""), lambda held, p: F.concat(held, p["ids"]))
    fields = ("offset", "doc_id", "start", "length", "doc_tokens")
    whole = sequences.select(
        "sequence_id",
        "n_tokens",
        F.transform("pieces", lambda p: F.struct(*[p[f].alias(f) for f in fields])).alias("pieces"),
        ids.alias("ids"),
    )
    return whole.mapInArrow(_filled_up(capacity, width), whole.schema)


def piece_digests(sequences: DataFrame) -> DataFrame:
    """The rows of `pack_documents`, read back from whole sequences."""
    rows = sequences.select("sequence_id", "ids", F.explode("pieces").alias("piece"))
    own = F.substring(
        "ids",
        (F.col("piece.offset") * _BYTES_PER_ID + 1).cast("int"),
        (F.col("piece.length") * _BYTES_PER_ID).cast("int"),
    )
    return rows.select(
        "piece.doc_id",
        "piece.start",
        "piece.length",
        F.crc32(own).alias("ids_crc32"),
        "piece.doc_tokens",
        "sequence_id",
        "piece.offset",
    )

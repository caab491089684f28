"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in blocks by a hash. How many rows each block sends to each shard is
drawn exactly, from the block sizes alone: row by row of the matrix, each entry
is hypergeometric given what the shards can still take. Each block permutes its
rows and deals them out by these counts, and each shard permutes what it got.
Together that gives every assignment of rows to places the same chance, while
shard sizes are exact.

Only built-in functions touch rows. Block counts and the matrix, whose size
follows from the number of blocks and shards, are handled on the driver.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grovelift.llm.common import checkpointed

N_SHARDS = 40
MIN_BLOCKS = 256
ROWS_PER_BLOCK = 1_000_000
# Places further than this from the mode have a chance below 1e-30.
_REACH = 12
# Digests of repeated rows up to this number are broadcast: 8 bytes each.
BROADCAST_KEYS = 1_000_000


def draw_hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of `n` draws without replacement hit one of `good` among `good + bad`.

    By inversion over a window around the mode, in which the log-probabilities
    follow from the ratios of neighbours. Populations may be of any size.
    """
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    total = good + bad
    mean = n * good / total
    spread = math.sqrt(mean * (bad / total) * (total - n) / max(1, total - 1)) + 1
    low = max(low, math.floor(mean - _REACH * spread))
    high = min(high, math.ceil(mean + _REACH * spread))
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    chances = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(chances, rng.random() * chances[-1], side="right"))


def communication_matrix(sizes: list[int], capacities: list[int], seed: int) -> list[list[int]]:
    """Counts from each block to each shard, with these exact row and column sums."""
    rng = np.random.default_rng(seed)
    left = list(capacities)
    matrix = []
    for size in sizes:
        row, to_place, room = [], size, sum(left)
        for capacity in left:
            room -= capacity
            taken = draw_hypergeometric(rng, capacity, room, to_place)
            row.append(taken)
            to_place -= taken
        left = [c - r for c, r in zip(left, row, strict=True)]
        matrix.append(row)
    return matrix


def shard_rows(
    rows: DataFrame,
    n_shards: int = N_SHARDS,
    seed: int = 0,
    min_blocks: int = MIN_BLOCKS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """All rows, whole, with `shard` (0 to n_shards - 1) and `slot` (gapless from 0 in a shard).

    Shard sizes differ by one at most. The result depends on the rows, the seed
    and the number of blocks alone, not on how the input is split into files.
    Blocks and orders come from a digest of the row. Counts are taken on digests;
    rows themselves move twice, into their block and into their shard.

    Rows that are there several times are counted before they move and told apart
    by a copy number, so a row repeated very often lies in all blocks. Nulls are
    values like others. An empty table gives no rows. Columns named `shard` or
    `slot` are replaced.
    """
    keep = [c for c in rows.columns if c not in ("shard", "slot")]
    # Private names, so that columns of the caller are safe.
    copies, copy, key, first, second = "__copies", "__copy", "__key", "__first", "__second"
    block, bucket, cuts, place = "__block", "__bucket", "__cuts", "__place"
    named = [F.col(f"`{c}`") for c in keep]
    spark = rows.sparkSession
    total = rows.count()
    n_blocks = max(min_blocks, -(-total // rows_per_block))

    # A hash passes over nulls, so each value comes with whether it is one.
    digest = F.xxhash64(F.lit(seed), *[x for c in named for x in (c, c.isNull())])
    hashed = rows.select(*named, digest.alias(key))
    repeated = hashed.groupBy(key).agg(F.count(F.lit(1)).alias(copies))
    repeated = checkpointed(repeated.where(F.col(copies) > 1).select(key))
    n_repeated = repeated.count()
    one = F.lit(1).cast("long")
    keyed = hashed.withColumn(copy, one)
    if n_repeated:
        if n_repeated <= BROADCAST_KEYS:
            repeated = F.broadcast(repeated)
        again = hashed.join(repeated, key, "left_semi").groupBy(*named, key)
        again = again.agg(F.count(F.lit(1)).alias(copies))
        again = again.select(*named, key, F.explode(F.sequence(one, F.col(copies))).alias(copy))
        once = hashed.join(repeated, key, "left_anti").select(*named, key, one.alias(copy))
        keyed = once.unionByName(again)
    # The order within a block takes the whole hash, the block another one of it.
    keyed = keyed.withColumn(first, F.xxhash64(F.lit(seed), copy, key)).withColumn(
        block, F.pmod(F.xxhash64(first, F.lit(1)), F.lit(n_blocks)).cast("int")
    )
    narrow = checkpointed(keyed.select(block, first, copy))

    held = {r[0]: r[1] for r in narrow.groupBy(block).count().collect()}
    blocks = sorted(held)
    capacities = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix([held[b] for b in blocks], capacities, seed)
    table = [(b, np.cumsum(row).tolist()) for b, row in zip(blocks, matrix, strict=True)]
    starts = spark.createDataFrame(table, f"{block} int, {cuts} array<bigint>")
    n_buckets = max(8, -(-total // (n_shards * rows_per_block // 8)))
    share = F.shiftrightunsigned(second, 11) / F.lit(float(1 << 53))

    def dealt(frame: DataFrame, others: list) -> DataFrame:
        """Each block permuted and dealt out by its row of the matrix."""
        within = Window.partitionBy(block).orderBy(first, copy, *others)
        return (
            frame.withColumn(place, F.row_number().over(within))
            .join(starts, block)
            .withColumn("shard", F.size(F.filter(cuts, lambda c: c < F.col(place))).cast("int"))
            .withColumn(second, F.xxhash64(F.lit(seed), F.lit(2), first))
            .withColumn(bucket, F.floor(share * n_buckets).cast("int"))
            .select(*others, copy, second, "shard", bucket)
        )

    sums = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt(narrow, [])
        .groupBy("shard", bucket)
        .agg(F.count(F.lit(1)).alias(copies))
        .select("shard", bucket, F.coalesce(F.sum(copies).over(sums), F.lit(0)).alias(cuts))
    )
    inside = Window.partitionBy("shard", bucket).orderBy(second, copy, *named)
    return (
        dealt(keyed, named)
        .withColumn(place, F.row_number().over(inside))
        .join(before, ["shard", bucket])
        .select(*named, "shard", (F.col(cuts) + F.col(place) - 1).alias("slot"))
    )


def document_digests(documents: DataFrame) -> DataFrame:
    """Rows with the id, the size in bytes plus 16, and the crc32 of the text besides.

    A null text has no bytes: size 16 and crc32 0.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return documents.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *[c for c in ("shard", "slot") if c in documents.columns],
    )


def sharded_documents(documents: DataFrame, n_shards: int = N_SHARDS, seed: int = 0) -> DataFrame:
    """Where each document went, under the law of equal row counts.

    Whole documents are sharded; sizes and digests are taken from them afterwards.
    """
    return document_digests(shard_rows(documents, n_shards, seed)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""A Bloom filter as a small table, for key sets that are too large to broadcast.

The filter is a row of 64-bit words. A key sets `BITS_PER_KEY` bits in one word, so that
building it is a grouped `bit_or`, combined map-side, and probing it reads one word. Words
are kept in blocks, one row with an array each, so that the broadcast has little besides
the words. Its size is chosen from the number of keys and never passes `FILTER_LIMIT_BYTES`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Of the words; a broadcast of them takes little more.
FILTER_LIMIT_BYTES = 64 * 1024 * 1024
# Room for a key, as long as the limit allows; about one in a hundred others passes then.
BYTES_PER_KEY = 2
# With less room than this the filter would hold back too few rows to be worth its join.
LEAST_BITS_PER_KEY = 6
BITS_PER_KEY = 4
_WORD_BYTES = 8
_BLOCK_SHIFT = 9
_BLOCK_WORDS = 1 << _BLOCK_SHIFT
_WORD_SEED, _BIT_SEED = 1, 2


def filter_words(keys: int) -> int:
    """Words of a filter for so many keys, in whole blocks; 0 if they are too many."""
    if keys * LEAST_BITS_PER_KEY > 8 * FILTER_LIMIT_BYTES:
        return 0
    wanted = min(keys * BYTES_PER_KEY, FILTER_LIMIT_BYTES)
    return max(1, -(-wanted // (_WORD_BYTES * _BLOCK_WORDS))) * _BLOCK_WORDS


def _word(key: Column, words: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(_WORD_SEED)), F.lit(words))


def _mask(key: Column) -> Column:
    """The bits of a key in its word, from four parts of another hash."""
    hashed = F.xxhash64(key, F.lit(_BIT_SEED))
    places = [F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)) for i in range(BITS_PER_KEY)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), p.cast("int")) for p in places]
    return reduce(Column.bitwiseOR, bits)


def bloom_blocks(keys: DataFrame, column: str, words: int) -> DataFrame:
    """(_block, _words) of the keys: every block, with all of its words in order."""
    key = F.col(column)
    set_words = keys.where(key.isNotNull()).select(
        _word(key, words).alias("word"), _mask(key).alias("mask")
    )
    empty = keys.sparkSession.range(words).select(
        F.col("id").alias("word"), F.lit(0).cast("long").alias("mask")
    )
    merged = set_words.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    place = F.struct((F.col("word") % _BLOCK_WORDS).alias("place"), "mask")
    block = F.shiftright("word", _BLOCK_SHIFT).alias("_block")
    # A block has as many words as every other one.
    return merged.groupBy(block).agg(
        F.array_sort(F.collect_list(place))["mask"].alias("_words")
    )


def maybe_in(rows: DataFrame, keys: DataFrame, column: str, n_keys: int) -> DataFrame:
    """Rows whose key may be among `keys`: all that are, and few others.

    `n_keys` is the measured number of keys. Rows without a key go. Rows stay where they
    are; if the keys are too many for a filter, all rows stay.
    """
    words = filter_words(n_keys)
    if not words:
        return rows
    key = rows[column]
    word = _word(key, words)
    blocks = F.broadcast(bloom_blocks(keys, column, words))
    mask = _mask(key)
    held = F.get("_words", (word % _BLOCK_WORDS).cast("int"))
    in_block = F.shiftright(word, _BLOCK_SHIFT) == F.col("_block")
    return rows.where(key.isNotNull()).join(blocks, in_block & (held.bitwiseAND(mask) == mask), "left_semi")

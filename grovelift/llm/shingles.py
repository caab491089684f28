"""Sets of word shingles as 64-bit hashes, computed for whole Arrow batches at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Text handled at once; a longer text is handled alone.
_SLICE_BYTES = 2_000_000

_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# Random odd multipliers: one per byte value, one per place in a shingle.
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = np.where(_SEPARATORS, np.uint64(0), _BYTE[_LOWER])
_PLACE = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the place of each; a null text has no bytes."""
    raw = texts.cast(pa.large_binary())
    _, offsets, data = raw.buffers()
    offsets = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + len(raw) + 1]
    return np.frombuffer(data if data is not None else b"", np.uint8), offsets


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its shingles of so many words.

    Words are runs of bytes other than space and the five controls after it;
    only A-Z are lower-cased. A text of fewer words has their whole sequence as
    its one shingle, a text without words or a null has none.
    """
    data, offsets = text_buffers(texts)
    up, down = _powers(_BASE, 0), _powers(_BASE_INVERSE, 0)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + _SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        part = data[offsets[first] : offsets[last]]
        if len(part) > len(up):
            up, down = _powers(_BASE, len(part)), _powers(_BASE_INVERSE, len(part))
        yield from _sets(part, offsets[first : last + 1] - offsets[first], words, up, down)
        first = last


def _sets(part, offsets, words, up, down) -> Iterator[np.ndarray]:
    n_docs = len(offsets) - 1
    none = np.zeros(0, np.int64)
    separator = _SEPARATORS[part]
    begins = ~separator
    begins[1:] &= separator[:-1]
    heads = offsets[:-1][offsets[:-1] < len(part)]
    begins[heads] = ~separator[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        yield from [none] * n_docs
        return
    # A polynomial in the bytes of the word, whatever its place in the slice.
    word = np.add.reduceat(_BYTE[part] * up[: len(part)], starts) * down[starts]
    word = mix(word)
    doc = np.searchsorted(offsets, starts, side="right") - 1
    n = max(0, len(word) - words + 1)
    shingle = np.zeros(n, np.uint64)
    for j in range(words):
        shingle += word[j : j + n] * _PLACE[j]
    within = doc[:n] == doc[words - 1 : words - 1 + n]
    shingle = mix(shingle[within]).view(np.int64)
    owner = doc[:n][within]
    edges = np.searchsorted(owner, np.arange(n_docs + 1))
    word_edges = np.searchsorted(doc, np.arange(n_docs + 1))
    for i in range(n_docs):
        if edges[i] < edges[i + 1]:
            yield np.unique(shingle[edges[i] : edges[i + 1]])
        elif word_edges[i] < word_edges[i + 1]:
            few = word[word_edges[i] : word_edges[i + 1]]
            whole = np.append(few * _PLACE[words : words + len(few)], _PLACE[-1 - len(few)])
            yield mix(whole.sum(dtype=np.uint64, keepdims=True)).view(np.int64)
        else:
            yield none


def digest(values: np.ndarray) -> bytes:
    """128 bits that tell a set of hashes from others, whatever their order."""
    values = values.view(np.uint64)
    sums = [mix(values ^ c).sum(dtype=np.uint64) for c in _PLACE[40:42]]
    return np.array(sums, np.uint64).tobytes()

"""Words of a column of texts as 64-bit hashes, many texts at a time; and fixed-size filters of keys.

A word is a run of bytes of a class. Hashing works on the UTF-8 bytes of a whole slice of rows at once. Texts are never cut: a text of any
length goes through in pieces that end between two words, so the working memory is some 40 bytes for each byte of a piece plus 8 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bytes of text hashed at a time, and of rows handed on as one slice
PIECE, SLICE = 1 << 20, 1 << 21
_BASE = np.uint64(0x100000001B3)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: tells the words of a run apart by their place
_PLACE = np.cumsum(np.full(64, _M1, np.uint64))

_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
#: not blank: everything but U+0020 and U+0009 to U+000D
SOLID = np.ones(256, bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False
#: ASCII letters and digits, and every byte of a character outside ASCII
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``limit`` bytes of text, or one row."""
    lengths = batch.column(column).cast(pa.large_binary())
    sizes = np.diff(np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset : lengths.offset + len(lengths) + 1]) if len(lengths) else []
    start = total = 0
    for row, size in enumerate(sizes):
        if row > start and total + size > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if len(sizes) > start:
        yield batch.slice(start)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offset at which each begins, with the end; a null is empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def hashed_words(texts: pa.Array, letters: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order (A-Z as a-z), and for each text the number of words before it, with the total at the end."""
    data, offsets = text_bytes(texts)
    solid = letters[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    first[inner] |= solid[inner]
    starts = np.flatnonzero(first)
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        upto = max(done + 1, np.searchsorted(starts, starts[done] + PIECE))
        lo, hi = starts[done], starts[upto] if upto < len(starts) else len(data)
        held = solid[lo:hi]
        begins = np.flatnonzero(first[lo:hi][held])
        sizes = np.diff(np.append(begins, np.count_nonzero(held)))
        place = np.arange(sizes.sum()) - np.repeat(begins, sizes)
        powers = np.cumprod(np.append(np.uint64(1), np.full(sizes.max() - 1, _BASE, np.uint64)))
        value = np.add.reduceat(_LOWER[data[lo:hi][held]] * powers[place], begins)
        out[done:upto] = mix(value + sizes.astype(np.uint64) * _M2)
        done = upto
    return out, np.searchsorted(starts, offsets)


def grams(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of n words inside one text, and the place of its first word among all words."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        value += mix(words[k : len(words) - n + 1 + k] + _PLACE[k])
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(text[: len(value)] == text[n - 1 :])
    return mix(value[at]), at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# --- fixed-size filters of keys --------------------------------------------------------------------------------------------

#: bits of a filter: 4 MB whatever the number of keys. A key that is in passes always; others pass as often as bits are set.
FILTER_BITS = 25


def key_filter(keys: DataFrame, key: str) -> np.ndarray:
    """Bits set by the keys of a DataFrame, which are hashes. What reaches the driver is at most FILTER_BITS bits, however many keys there are."""
    # bitmap_bucket_number counts from 1, and its place 0 belongs to the number 1
    spread: Column = F.shiftrightunsigned(key, 64 - FILTER_BITS) + 1
    blocks = (
        keys.where(F.col(key).isNotNull()).select(spread.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    )
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    width = 4096
    for row in blocks:
        at = (row["block"] - 1) * width
        bits[at : at + width] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bits


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys may be in the filter."""
    bit = (keys.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1

"""Texts of an Arrow batch as flat arrays: bytes, words, polynomial hashes, sliding minima.

All of it is numpy inside one task, over a bounded block of rows at a time. Words
are maximal runs of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
BLOCK = 1 << 20

_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
WORD = LETTER.copy()
WORD[48:58] = True

_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the table grows to the longest block seen."""
    table = _tables.get(base)
    if table is None or len(table) < n:
        steps = np.full(max(n, BLOCK), base, U64)
        steps[0] = 1
        table = _tables[base] = np.cumprod(steps)
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of a 64-bit value over all its bits."""
    h = h ^ (h >> U64(33))
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i``: n + 1 numbers modulo 2**64."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * _powers(_BASE, len(values)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]``, the same wherever the values stand."""
    return (prefix[end] - prefix[start]) * _powers(_INVERSE, len(prefix))[start]


def fixed_hash(prefix: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``values[i:i + length]`` for every i, without gathers."""
    n = max(0, len(prefix) - length)
    return (prefix[length:] - prefix[:n]) * _powers(_INVERSE, len(prefix))[:n]


def shift_factor(distance: np.ndarray, most: int) -> np.ndarray:
    """base**distance, to compare raw prefix differences that stand ``distance`` apart."""
    return _powers(_BASE, most + 1)[distance]


def byte_prefix(data: np.ndarray) -> np.ndarray:
    return prefix_hash(_LETTERS[data])


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of each text's first word (one more than texts)."""
    space = IS_SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = True, space
    before[offsets] = True  # a text starts or ends here
    starts = np.flatnonzero(~space & before[:-1])
    after = np.empty(len(data) + 1, bool)
    after[-1], after[:-1] = True, space
    after[offsets] = True
    ends = np.flatnonzero(~space & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; works through blocks of about a megabyte."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + BLOCK, "right")))
        prefix = byte_prefix(data[low : int(ends[to - 1])])
        out[at:to] = span_hash(prefix, starts[at:to] - low, ends[at:to] - low)
        at = to
    return mix(out)


@dataclass
class Words:
    """Folded words of a block: the bytes in lower case (zero between words) and the words' places."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # a text's first word; one more than texts


def folded_words(data: np.ndarray, offsets: np.ndarray, letter: np.ndarray = WORD) -> Words:
    """Maximal runs of ``letter`` bytes in lower case (ASCII, and capitals from U+00C0 to U+00DE)."""
    inside = letter[data]
    low = _LOWER[data]
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    low[upper] += 0x20
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return Words(np.where(inside, low, 0).astype(np.uint8), starts, ends, np.searchsorted(starts, offsets))


def gram_hashes(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, word) of every run of ``n`` words that stays within its text."""
    if len(hashes) < n:
        none = np.zeros(0, np.int64)
        return none.astype(U64), none, none
    grams = mix(fixed_hash(prefix_hash(hashes), n))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(grams)]
    good = np.flatnonzero(np.arange(len(grams)) + n <= first[text + 1])
    return grams[good], text[good], good


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``values[i:i + width]`` for every i, by doubling."""
    if len(values) < width:
        return values[:0]
    low, size = values, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = width - size
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each length, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(first, lengths)


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without a copy; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    marks = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    marks = marks.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[marks[0] : marks[-1]], marks - marks[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = BLOCK):
    """(rows, bytes, offsets) for consecutive rows of about ``most`` bytes; a longer text stands alone."""
    for batch in batches:
        data, offsets = text_arrays(batch.column(column))
        row = 0
        while row < batch.num_rows:
            to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
            yield batch.slice(row, to - row), data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
            row = to


def give_back() -> None:
    """Return the memory of freed arrays to the machine; allocators keep it else, and a worker outlives its task."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # elsewhere than with glibc
        ctypes.CDLL(None).malloc_trim(0)


def lean(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A step over batches whose worker gives its memory back at the end of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()

    return run


def lean_group(step: Callable[[pa.Table], pa.Table]):
    """A step over a group whose worker gives its memory back after each."""

    def run(table: pa.Table) -> pa.Table:
        out = step(table)
        give_back()
        return out

    return run


def text_key() -> list[Column]:
    """Two columns that tell texts apart: the id and a hash of the text (and of the id's absence).

    Rows that agree in both are the same text under the same id, and share every result.
    """
    return [
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0).cast("bigint")).alias("_k1"),
        F.xxhash64(F.col("doc_id").isNull(), F.coalesce(F.col("text"), F.lit(""))).alias("_k2"),
    ]


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct ``row``, so that no name of theirs meets a name used on the way."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (never null) and the two key columns; other columns are left out."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *text_key(),
    )


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one number for the whole table."""
    return docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0

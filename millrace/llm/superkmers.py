"""Windows of a text cut into super-k-mers, packed and sent to the bucket of their minimiser.

A window of ``span`` units (words or bytes) belongs to the bucket of its minimiser:
the least hash among its ``seed``-unit grams. Equal windows have equal minimisers,
so they meet in one bucket. Consecutive windows with the same minimiser value travel
as one string. A task packs all strings of one flush (``FLUSH`` bytes of text) that
go to the same bucket into one compressed blob.

A string that occurs twice within a flush is settled there: all its windows repeat.
Its places are reported at once and one copy, marked as known, goes to the bucket, so a
passage that fills a third of a table sends one string per flush, not one per place.

A footer shorter than a window stands in many different windows, and its least gram would gather
them all in one bucket. So grams are counted first, by hashed cells on a seeded sample of the texts, and
the grams of cells with more than a bucket should hold come last in the order that picks the
minimiser (``common_cells``): such a window goes by one of its other grams. The order is the same for all
windows, so equal ones still meet, whatever the sample says.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import U64, blocks, keyed, mix, ranges, sliding_min, span_hash, text_bytes

FLUSH = 16 << 20
CELL_BITS = 22
SAMPLE = 64  # one text in so many is counted
SAMPLE_LEAST, SAMPLE_MOST = 16 << 20, 4 << 30  # bytes of text, about
_SLICES = 64

PACKED = "bucket int, kind int, blob binary"
SPANS = "_k1 bigint, _k2 bigint, spans binary"
STRINGS, PLACES = 0, 1


@dataclass
class Units:
    """The units of a block of texts: a hash prefix over them and the units and bytes of each text."""

    prefix: np.ndarray  # polynomial hash prefix over the units
    first: np.ndarray  # index of the first unit of each text, and the number of units
    starts: np.ndarray  # first byte of a unit
    ends: np.ndarray  # byte after a unit


def common_cells(docs: DataFrame, seed: int, span_bytes: int, bucket_bytes: int, total: int, units: Callable[[np.ndarray, np.ndarray], Units]) -> np.ndarray | None:
    """Flags of the hashed cells whose grams could fill a bucket as minimisers; None where there is none.

    ``docs`` has ``text`` and its hash ``_k2``. The cells are 2^``CELL_BITS`` numbers whatever the corpus, added up by the
    executors in slices; only flags come back. A rare gram in the cell of a common one is set back with it, at no harm.
    """
    share = min(1.0, max(min(1 / SAMPLE, SAMPLE_MOST / max(total, 1)), SAMPLE_LEAST / max(total, 1)))
    if total <= bucket_bytes:
        return None
    least = bucket_bytes * share / (2 * span_bytes)
    schema = "slice bigint, cells binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.int32)
        for _, data, offsets in blocks(batches, "text"):
            own = units(data, offsets)
            at = np.arange(max(0, len(own.prefix) - seed))
            np.add.at(cells, (mix(span_hash(own.prefix, at, at + seed)) >> U64(64 - CELL_BITS)).astype(np.int64), 1)
        press = zstandard.ZstdCompressor(level=3)
        parts = [press.compress(x.tobytes()) for x in np.split(cells, _SLICES)]
        yield pa.record_batch([pa.array(np.arange(_SLICES)), pa.array(parts, pa.binary())], ["slice", "cells"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros((1 << CELL_BITS) // _SLICES, np.int64)
        for part in table.column("cells"):
            total += np.frombuffer(zstandard.ZstdDecompressor().decompress(part.as_buffer()), np.int32)
        flags = np.packbits(total > max(least, 8 * total.mean()))
        return pa.table({"slice": table.column("slice")[:1], "cells": pa.array([flags.tobytes()], pa.binary())})

    chosen = docs.filter(F.pmod(F.xxhash64(F.lit(3), "_k2"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text")
    found = {r.slice: r.cells for r in chosen.mapInArrow(count, schema).groupBy("slice").applyInArrow(add, schema).collect()}
    if not any(any(raw) for raw in found.values()):
        return None
    return np.unpackbits(np.frombuffer(b"".join(found[i] for i in range(_SLICES)), np.uint8)).astype(bool)


def cut(units: Units, seed: int, span: int, common: np.ndarray | None = None):
    """Super-k-mers of a block: (text, first window, windows, minimiser, whether it may repeat within).

    Grams of ``common`` cells come last in the order of minimisers.

    A string may hold a window twice only if its minimiser occurs twice in it, which
    shows where the minimiser is the first gram of a window that is not its last.
    """
    grams = len(units.prefix) - seed
    windows = len(units.prefix) - span
    if windows <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, U64), np.zeros(0, bool)
    at = np.arange(grams)
    hashes = mix(span_hash(units.prefix, at, at + seed))
    if common is not None:
        hashes = (hashes >> U64(1)) | (common[(hashes >> U64(64 - CELL_BITS)).astype(np.int64)].astype(U64) << U64(63))
    least = sliding_min(hashes, span - seed + 1)
    counts = np.diff(units.first)
    inside = np.zeros(len(units.prefix), bool)  # a window that starts here stays in its text
    inside[np.repeat(units.first[:-1], np.maximum(counts - span + 1, 0)) + ranges(np.maximum(counts - span + 1, 0))] = True
    inside = inside[:windows]
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
    last = inside.copy()
    last[:-1] &= ~inside[1:] | new[1:]
    a, b = np.flatnonzero(new), np.flatnonzero(last)
    leaves = (hashes[:windows] == least) & inside & ~last
    segment = np.cumsum(new) - 1
    multi = np.zeros(len(a), bool)
    multi[segment[leaves]] = True
    text = np.searchsorted(units.first, a, "right") - 1
    return text, a, b - a + 1, least[a], multi


class Flush:
    """Strings of up to ``FLUSH`` bytes of text, on their way to the buckets."""

    def __init__(self, buckets: int, span: int, common: np.ndarray | None = None):
        self.buckets, self.span, self.common, self.parts, self.strings, self.bytes = buckets, span, common, [], [], 0

    def add(self, data: np.ndarray, units: Units, seed: int, k1: np.ndarray, k2: np.ndarray) -> None:
        text, a, windows, least, multi = cut(units, seed, self.span, self.common)
        to = a + windows + self.span - 1  # unit after the last
        raw = data.tobytes()
        low, high = units.starts[a], units.ends[to - 1]
        self.strings += [raw[i:j] for i, j in zip(low.tolist(), high.tolist())]
        self.parts.append((
            least, span_hash(units.prefix, a, to), k1[text], k2[text],
            (a - units.first[text]).astype(np.int64), windows.astype(np.int64), multi,
        ))
        self.bytes += len(data)

    def rows(self) -> Iterator[tuple[int, int, bytes]]:
        if not self.strings:
            return
        least, whole, k1, k2, start, windows, multi = (np.concatenate(x) for x in zip(*self.parts))
        n = len(least)
        known = np.zeros(n, bool)
        drop = np.zeros(n, bool)
        order = np.argsort(whole, kind="stable")
        same = whole[order[1:]] == whole[order[:-1]]
        pairs = np.zeros(n, bool)
        pairs[order[1:][same]] = True
        pairs[order[:-1][same]] = True
        seen: dict[bytes, int] = {}
        for i in np.flatnonzero(pairs).tolist():  # the bytes decide, not the hash
            head = seen.setdefault(self.strings[i], i)
            if head != i:
                known[head] = known[i] = drop[i] = True
        if known.any():
            yield from self._places(k1[known], k2[known], start[known], windows[known])
        keep = np.flatnonzero(~drop)
        bucket = (least[keep] % U64(self.buckets)).astype(np.int64)
        by = keep[np.argsort(bucket, kind="stable")]
        marks = np.searchsorted(np.sort(bucket), np.arange(self.buckets + 1))
        press = zstandard.ZstdCompressor(level=6)
        for b in np.flatnonzero(np.diff(marks)).tolist():
            rows = by[marks[b] : marks[b + 1]]
            strings = [self.strings[i] for i in rows.tolist()]
            head = [
                np.array([len(rows)], np.int64), least[rows], k1[rows], k2[rows], start[rows].astype(np.int32),
                np.fromiter(map(len, strings), np.int32, len(rows)), (known[rows] | (multi[rows] * 2)).astype(np.uint8),
            ]
            yield b, STRINGS, press.compress(b"".join([x.tobytes() for x in head] + strings))

    def _places(self, k1, k2, start, windows) -> Iterator[tuple[int, int, bytes]]:
        """Settled places, spread over buckets that only pass them on."""
        bucket = (k2.astype(U64) % U64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        marks = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        press = zstandard.ZstdCompressor(level=3)
        for b in np.flatnonzero(np.diff(marks)).tolist():
            rows = order[marks[b] : marks[b + 1]]
            body = [np.array([len(rows)], np.int64), k1[rows], k2[rows], start[rows].astype(np.int32), windows[rows].astype(np.int32)]
            yield b, PLACES, press.compress(b"".join(x.tobytes() for x in body))


@dataclass
class Strings:
    """The strings of one bucket, laid end to end."""

    least: np.ndarray
    k1: np.ndarray
    k2: np.ndarray
    start: np.ndarray  # first window, in units of its text
    known: np.ndarray
    multi: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def take(self, keep: np.ndarray) -> Strings:
        lengths = np.diff(self.offsets)[keep]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        raw = self.data.tobytes()
        data = b"".join([raw[i:j] for i, j in zip(self.offsets[:-1][keep].tolist(), self.offsets[1:][keep].tolist())])
        return Strings(self.least[keep], self.k1[keep], self.k2[keep], self.start[keep], self.known[keep],
                       self.multi[keep], np.frombuffer(data, np.uint8), offsets)


def _unpack(blobs: list[bytes]) -> Strings:
    parts, body = [], []
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        at, got = 8, []
        for kind in (U64, np.int64, np.int64, np.int32, np.int32, np.uint8):
            got.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
        parts.append(got)
        body.append(raw[at:])
    least, k1, k2, start, lengths, flags = (np.concatenate(x) for x in zip(*parts))
    offsets = np.concatenate([[0], np.cumsum(lengths.astype(np.int64))])
    return Strings(least, k1, k2, start, (flags & 1) > 0, (flags & 2) > 0, np.frombuffer(b"".join(body), np.uint8), offsets)


def _span_batch(k1: np.ndarray, k2: np.ndarray, start: np.ndarray, windows: np.ndarray) -> pa.RecordBatch:
    """One row a text: its runs of repeated windows as (first, number) pairs."""
    order = np.lexsort((k1, k2))
    k1, k2 = k1[order], k2[order]
    pairs = np.stack([start[order], windows[order]], 1).astype(np.int32)
    new = np.ones(len(k1), bool)
    new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
    heads = np.flatnonzero(new)
    raw = pairs.tobytes()
    marks = np.append(heads, len(k1)) * 8
    blobs = [raw[i:j] for i, j in zip(marks[:-1].tolist(), marks[1:].tolist())]
    return pa.record_batch([pa.array(k1[heads]), pa.array(k2[heads]), pa.array(blobs, pa.binary())], ["_k1", "_k2", "spans"])


def repeated_windows(
    docs: DataFrame, seed: int, span: int, bucket_bytes: int, span_bytes: int,
    units: Callable[[np.ndarray, np.ndarray], Units],
    count: Callable[[Strings], np.ndarray],
    unit_flags: Callable[[Strings], np.ndarray],
) -> DataFrame:
    """(_k1, _k2, spans): the runs of windows of each text that start anywhere else too.

    ``units(bytes, offsets)`` finds the units of a block. ``count(strings)`` flags, for
    the windows of all strings of a bucket in order, those that repeat, and
    ``unit_flags(strings)`` tells how many windows each string has. The number of buckets
    follows the bytes of all texts, so that one bucket's strings hold about ``bucket_bytes``; ``span_bytes``
    are those of a window, about.
    """
    copies = 1 + 2 * (span - 1) / (span - seed + 2)  # packed bytes for each byte of text, where minimisers are random
    total = text_bytes(docs)
    buckets = max(1, math.ceil(total * copies / bucket_bytes))
    texts = keyed(docs).select("_k1", "_k2", "text")
    shared = docs.sparkSession.sparkContext.broadcast(common_cells(texts, seed, span_bytes, bucket_bytes, total, units))  # 4 MB at most

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(flush: Flush) -> Iterator[pa.RecordBatch]:
            for b, kind, blob in flush.rows():
                yield pa.record_batch([pa.array([b], pa.int32()), pa.array([kind], pa.int32()), pa.array([blob], pa.binary())],
                                      ["bucket", "kind", "blob"])

        flush = Flush(buckets, span, shared.value)
        for rows, data, offsets in blocks(batches, "text"):
            if flush.bytes and flush.bytes + len(data) > FLUSH:
                yield from out(flush)
                flush = Flush(buckets, span, shared.value)
            flush.add(data, units(data, offsets), seed, rows.column("_k1").to_numpy(), rows.column("_k2").to_numpy())
        yield from out(flush)

    def settle(table: pa.Table) -> pa.Table:
        found = []
        kinds = table.column("kind").to_numpy()
        blobs = table.column("blob").to_pylist()
        for blob in (x for x, kind in zip(blobs, kinds) if kind == PLACES):
            raw = zstandard.ZstdDecompressor().decompress(blob)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            found.append((np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, np.int64, n, 8 + 8 * n),
                          np.frombuffer(raw, np.int32, n, 8 + 16 * n), np.frombuffer(raw, np.int32, n, 8 + 20 * n)))
        packed = [x for x, kind in zip(blobs, kinds) if kind == STRINGS]
        del blobs, table
        if packed:
            strings = _unpack(packed)
            del packed
            _, group, size = np.unique(strings.least, return_inverse=True, return_counts=True)
            keep = np.flatnonzero((size[group] > 1) | strings.multi)  # else its windows cannot repeat
            if len(keep):
                strings = strings.take(keep)
                windows = unit_flags(strings)
                flags = count(strings)
                owner = np.repeat(np.arange(len(windows)), windows)
                edge = np.ones(len(flags) + 1, bool)
                edge[1:-1] = (flags[1:] != flags[:-1]) | (owner[1:] != owner[:-1])
                marks = np.flatnonzero(edge)
                a, n = marks[:-1], np.diff(marks)
                good = flags[a] & ~strings.known[owner[a]] if len(a) else np.zeros(0, bool)
                a, n = a[good], n[good]
                own = owner[a]
                local = a - (np.cumsum(windows) - windows)[own]
                found.append((strings.k1[own], strings.k2[own], strings.start[own] + local, n))
        if not found:
            return pa.table({"_k1": pa.array([], pa.int64()), "_k2": pa.array([], pa.int64()), "spans": pa.array([], pa.binary())})
        return pa.Table.from_batches([_span_batch(*(np.concatenate(x).astype(np.int64) for x in zip(*found)))])

    packed = texts.mapInArrow(pack, PACKED)
    spans = packed.groupBy("bucket").applyInArrow(settle, SPANS)
    return spans.groupBy("_k1", "_k2").agg(F.collect_list("spans").alias("spans"))


def covered(spans: list[bytes] | None, units: int, span: int) -> np.ndarray | None:
    """Flags of the units that a repeated window covers; None where there is none."""
    if not spans:
        return None
    pairs = np.frombuffer(b"".join(spans), np.int32).reshape(-1, 2)
    steps = np.zeros(units + 1, np.int32)
    np.add.at(steps, pairs[:, 0], 1)
    np.add.at(steps, pairs[:, 0] + pairs[:, 1] + span - 1, -1)
    return np.cumsum(steps[:-1]) > 0
